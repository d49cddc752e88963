"""Removal of byte strings that repeat anywhere in the corpus, by suffix order over many shards.

Every string of ``length`` bytes (a "start") belongs to one anchor: the leftmost smallest hash of
the ``GRAM``-byte strings in it.  Equal strings have equal anchors, so starts can only match inside one
anchor's group.  Neighbouring starts with one anchor form a window, the text that holds them all.

1. Anchor hashes are counted (8 bytes each are shuffled).  Those that occur more than once fill a bit
   filter of fixed size; a false hit only sends a window along that matches nothing.
2. The windows of such anchors are written with the hash of their text.  Windows that occur as a
   whole more than once are repeated in every start.
3. Groups with different windows are dealt to shards by anchor.  A shard takes whole groups up to
   ``SHARD`` bytes at a time and sorts all their suffixes by external induced sorting
   (``induced_sort``); a start is repeated where the common prefix with a neighbour reaches ``length``.
   Groups above ``HOT`` windows would grow with the corpus: their starts are counted one by one by a
   128-bit hash instead, pre-aggregated and spread over all tasks.
4. The spans go to their documents, joined by the digest of the text.

Texts that occur in more than one row repeat as a whole, and one task reads each text but once.

Defined cases: null or empty text -> no bytes; null doc_id and repeated rows are kept (a repeated
row's bytes are all removed if it has ``length`` of them); text that isn't UTF-8 is taken as bytes; an
empty table gives no rows; other columns are ignored or kept as they are.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerforge.llm.common import free_names, row_base, small, stage
from layerforge.llm.induced_sort import suffix_order

LENGTH, GRAM = 400, 128  # GRAM: at most this many bytes name an anchor
SHARD = 1 << 20
HOT = 8192
FILTER_BITS = 1 << 27  # 16 MB, whatever the input
SEGMENT = 1 << 19
WINDOWS = "t long, key binary, s array<int>, m int, h long, w binary, body binary"
RANGES = "w binary, a array<int>, z array<int>"

_BYTE = np.random.default_rng(31).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """Rolling polynomial hash of every ``gram`` bytes, mixed."""
    up, down = _powers(SEGMENT + (1 << 12))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[:len(b)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[:len(b) - gram + 1] * _MIX
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h


def windows_of(raw: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first start, number of starts, anchor hash) of the windows of a text, by segments."""
    total = len(raw) - length + 1
    gram = min(GRAM, length)
    wide = length - gram + 1
    for at in range(0, total, SEGMENT):
        h = gram_hashes(np.frombuffer(raw, np.uint8, min(SEGMENT, total - at) + length - 1, at), gram)
        place = np.arange(len(h), dtype=np.uint64)
        key = (h & ~np.uint64((1 << 20) - 1)) | place  # smallest hash, then leftmost
        n = len(key) - wide + 1
        blocks = np.append(key, np.full(-len(key) % wide, np.uint64(0xFFFFFFFFFFFFFFFF))).reshape(-1, wide)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[:n], ahead[wide - 1:wide - 1 + n])
        anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.append(0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
        many = np.diff(np.append(first, n))
        yield first + at, many, h[anchor[first]]


class _Seen:
    """Keys met by this task; forgets when it holds too many (which only costs work)."""

    def __init__(self, most: int = 250_000):
        self.keys, self.most = set(), most

    def new(self, key: bytes) -> bool:
        if key in self.keys:
            return False
        if len(self.keys) >= self.most:
            self.keys.clear()
        self.keys.add(key)
        return True


def _anchor_step(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for b in small(batches):
            found = [h for key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if seen.new(key)
                     for _, _, h in windows_of(raw, length)]
            if found:
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return run


def anchor_filter(texts: DataFrame, length: int) -> np.ndarray:
    """Bit filter (two probes) of the anchors that occur more than once."""
    counts = texts.select("key", "text").mapInArrow(_anchor_step(length), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    bit = F.explode(F.array(F.pmod("h", F.lit(FILTER_BITS)), F.pmod(F.shiftright("h", 32), F.lit(FILTER_BITS))))
    words = (counts.where("n > 1").select(bit.alias("bit"))
             .groupBy(F.shiftright("bit", 5).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("bits")))
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    rows = words.toArrow()  # at most FILTER_BITS / 32 rows
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return table


def _in_filter(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    h = h.view(np.int64)
    out = np.ones(len(h), bool)
    for probe in (h, h >> 32):
        bit = np.mod(probe, FILTER_BITS)
        out &= (table[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1)).astype(bool)
    return out


def _window_step(length: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        table, press = shared.value, zstandard.ZstdCompressor(level=1)
        seen, sent = _Seen(), _Seen()
        names = ["t", "key", "s", "m", "h", "w", "body"]
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        t = row_base()
        for b in small(batches):
            rows = []
            for key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not seen.new(key):
                    continue
                t, own = t + 1, {}
                for first, many, h in windows_of(raw, length):
                    hit = _in_filter(table, h)
                    for s, m, x in zip(first[hit].tolist(), many[hit].tolist(), h[hit].view(np.int64).tolist()):
                        body = raw[s:s + m + length - 1]
                        w = xxhash.xxh3_128_digest(body)
                        if w in own:  # a text that repeats itself: one row with all the places
                            own[w][2].append(s)
                        else:
                            # the digest of the text stands in its first row; the others have its number
                            own[w] = (t, None if own else key, [s], m, x, w, press.compress(body) if sent.new(w) else None)
                rows += own.values()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return run


def repeated_starts(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which of its starts also start elsewhere in these texts."""
    text = np.frombuffer(b"".join(b + b"\0" for b in bodies), np.uint8).astype(np.uint16) + 2
    ends = np.cumsum([len(b) + 1 for b in bodies]) - 1
    text[ends] = 1
    order, common = suffix_order(text, length)
    hit = np.zeros(len(text), bool)
    near = np.flatnonzero(common >= length)
    hit[order[near]] = True
    hit[order[near - 1]] = True
    out, at = [], 0
    for end in ends.tolist():
        out.append(hit[at:max(at, end - length + 1)])
        at = end + 1
    return out


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def _range_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["w", "a", "z"])


def _shard_step(length: int):
    """mapInArrow over windows ordered by anchor: ranges of the starts that repeat between windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        plain, held, size = zstandard.ZstdDecompressor(), [], 0

        def done():
            found = []
            for (_, w, _), flags in zip(held, repeated_starts([r[2] for r in held], length)):
                if flags.any():
                    found.append((w, *_runs(flags)))
            return _range_batch(found)

        for b in small(batches):
            for h, w, body in zip(*(b.column(c).to_pylist() for c in ("h", "w", "body"))):
                if size > SHARD and h != held[-1][0]:
                    yield done()
                    held, size = [], 0
                body = plain.decompress(body)
                held.append((h, w, body))
                size += len(body)
        if held:
            yield done()

    return run


def _start_step(length: int):
    """mapInArrow: windows of hot anchors -> (hash of each start, w, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        plain = zstandard.ZstdDecompressor()
        kinds = [pa.binary(), pa.binary(), pa.int32()]
        for b in small(batches):
            rows = []
            for w, body in zip(*(b.column(c).to_pylist() for c in ("w", "body"))):
                body = plain.decompress(body)
                rows += [(xxhash.xxh3_128_digest(body[i:i + length]), w, i) for i in range(len(body) - length + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["g", "w", "i"])

    return run


def _gather_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        rows = []
        for w, places in zip(*(b.column(c).to_pylist() for c in ("w", "places"))):
            flags = np.zeros(max(places) + 1, bool)
            flags[places] = True
            rows.append((w, *_runs(flags)))
        yield _range_batch(rows)


def repeated_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(key, r): per text digest, its marks (see ``merged``).

    ``texts``: key (digest), text (binary).  A text of several rows is one span.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(anchor_filter(texts, length))  # FILTER_BITS, whatever the input
    windows = stage(texts.where(F.length("text") >= length).select("key", "text")
                    .mapInArrow(_window_step(length, shared), WINDOWS), "windows")
    counts = stage(windows.groupBy("w").agg(F.sum(F.size("s")).alias("n"), F.first("m").alias("m"), F.first("h").alias("h")), "window-counts")
    hot_groups = stage(counts.groupBy("h").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > hot).select("h"), "hot-groups")
    whole = counts.where("n > 1").select("w", F.array(F.lit(0)).alias("a"), F.array("m").alias("z"))
    bodies = windows.where("body IS NOT NULL").select("h", "w", "body")
    some_hot = not hot_groups.isEmpty()
    # The window makes the planner keep each anchor's rows in one place, whatever it does before;
    # as the rows come dealt out by anchor, that takes no second shuffle of the texts.
    own = bodies.join(hot_groups, "h", "left_anti") if some_hot else bodies.repartition("h")
    own = (own.dropDuplicates(["h", "w"]).withColumn("d", F.count(F.lit(1)).over(Window.partitionBy("h").orderBy("h")))
           .where("d > 1"))
    found = whole.unionByName(own.select("h", "w", "body").mapInArrow(_shard_step(length), RANGES))
    if some_hot:
        starts = stage(bodies.join(hot_groups, "h", "left_semi").dropDuplicates(["h", "w"]).select("w", "body")
                       .mapInArrow(_start_step(length), "g binary, w binary, i int"), "hot-starts")
        again = starts.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g")
        found = found.unionByName(starts.join(again, "g").groupBy("w").agg(F.collect_list("i").alias("places"))
                                  .mapInArrow(_gather_step, RANGES))
    found = stage(found, "window-ranges")
    marks = windows.select("t", "s", "w").join(found, "w").select("t", F.struct("s", "a", "z").alias("r"))
    spans = marks.join(windows.where("key IS NOT NULL").select("t", "key"), "t").select("key", "r")
    nought = F.array(F.lit(0))
    copies = (texts.where(F.length("text") >= length).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("text")).alias("z"))
              .where("n > 1").select("key", F.struct(nought.alias("s"), nought.alias("a"),
                                                     F.array((F.col("z") - (length - 1)).cast("int")).alias("z")).alias("r")))
    return spans.unionByName(copies).groupBy("key").agg(F.collect_set("r").alias("r"))


def merged(marks: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes covered by a text's repeated starts.

    A mark has places ``s`` of one window and its ranges [a, z) of repeated starts.
    """
    spans = sorted((s + a, s + z - 1 + length) for m in marks or () for s in m["s"] for a, z in zip(m["a"], m["z"]))
    out: list[tuple[int, int]] = []
    for s, z in spans:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((s, z))
    return out


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for s, z in runs:
        parts.append(raw[at:s])
        at = z
    parts.append(raw[at:])
    return b"".join(parts)


def _with_spans(docs: DataFrame, length: int, hot: int) -> tuple[DataFrame, list[str]]:
    """All columns of ``docs``, with the text as bytes and the marks of its repeats; their names."""
    raw, key, r = free_names(docs, "raw", "key", "r")
    keyed = docs.withColumn(raw, F.coalesce(F.col("text").cast("binary"), F.lit(b""))).withColumn(key, F.unhex(F.md5(raw)))
    texts = keyed.select(F.col(key).alias("key"), F.col(raw).alias("text"))
    spans = stage(repeated_spans(texts, length, hot).select(F.col("key").alias(key), F.col("r").alias(r)), "spans")
    return keyed.join(spans.hint("shuffle_hash"), key, "left").drop(key), [raw, r]


def repeats_report(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            out = []
            for doc, raw, marks in zip(*(c.to_pylist() for c in b.columns)):
                runs = merged(marks, length)
                out.append((doc, len(raw), sum(q - p for p, q in runs), len(runs), hashlib.sha256(kept_bytes(raw, runs)).hexdigest()))
            kinds = [*[pa.int64()] * 4, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows, found = _with_spans(docs.select(F.col("doc_id").cast("long"), "text"), length, hot)
    return rows.select("doc_id", *found).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """``docs`` with the repeated bytes taken out of text (null stays null); n_chars follows.

    Parts of a character that a span cuts through are dropped.
    """
    names = docs.columns
    rows, found = _with_spans(docs, length, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            had, columns = b.column("text"), [b.column(c) for c in names]
            texts = []
            for none, raw, marks in zip(had.is_null().to_pylist(), *(b.column(c).to_pylist() for c in found)):
                runs = merged(marks, length)
                texts.append(None if none else (kept_bytes(raw, runs) if runs else raw).decode("utf-8", "ignore"))
            columns[names.index("text")] = pa.array(texts, had.type)
            if "n_chars" in names:
                n = b.column("n_chars")
                new = [x if t is None else len(t) for x, t in zip(n.to_pylist(), texts)]
                columns[names.index("n_chars")] = pa.array(new, n.type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, docs.schema)
