"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash cuts every text into chunks at places that depend on nearby content only, so shared
passages give equal chunks wherever they stand.  Three steps:

1. Chunk hashes are counted over all documents (pre-aggregated; 16 bytes a chunk are shuffled).
   The hashes that occur more than once go into a bit filter of fixed size.
2. Each text is cut again where it lies.  A text without a chunk in the filter is encoded on the
   spot.  Any other becomes pieces: references to shared chunks, and ids of what is between them.
   The texts of the shared chunks are gathered by hash and each is encoded once for all documents.
   (A false hit of the filter only sends a chunk along that nobody else has.)
3. References are joined with the encoded chunks and the pieces of a document put in order.

Chunk joins are repaired in step 2: a unit of text (see ``units``) before and after the join is
encoded as one and compared with the two encoded apart.  Where they differ, or a side has but one
unit, both units are encoded in one with the text between the references, and the references
lose the ids of their part.  As ids cannot change beyond the units that touch a join, and a
reference ends at a unit's end then, that is exact.

No text moves but that of shared chunks, and every group is one document or one chunk hash.

Defined cases: null or empty text -> no ids and empty text; null doc_id and repeated rows are kept
as they are; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import row_base, small, stage, texts_of
from layerforge.llm.units import _LOADED, _UNIT, byte_letters, load_tokenizer, unit_encoder

LEAST, MOST = 512, 8192   # bytes of a chunk
CUT_BITS = 7              # one place in 2**7 that may be a cut is one
FILTER_BITS = 1 << 26     # 8 MB, whatever the input
PROBES = 4
PIECES = ("kind int, doc_id long, row long, seq int, h binary, head int, tail int, ids binary, chunk binary")

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
_BLANK = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))


def cut_places(raw: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text.  A cut depends on the 32 bytes before it, the next byte,
    and the cut before; it is before white space, or at a character's start where none comes."""
    n = len(raw)
    if n <= LEAST:
        return [n]
    b = np.frombuffer(raw, np.uint8)
    h = _GEAR[b]
    for k in (1, 2, 4, 8, 16):  # sum of gear values shifted by their distance: the last 32 bytes
        moved = h.copy()
        moved[k:] += h[:-k] << np.uint32(k)
        h = moved
    hit = ((h[:-1] >> np.uint32(32 - CUT_BITS)) == 0) & _BLANK[b[1:]] & ~_BLANK[b[:-1]]
    places = np.flatnonzero(hit) + 1
    out, at = [], 0
    while n - at > LEAST:
        k = int(np.searchsorted(places, at + LEAST))
        end = int(places[k]) if k < len(places) else n
        if end - at > MOST:
            end = at + MOST
            while raw[end] & 0xC0 == 0x80:
                end -= 1
        out.append(end)
        at = end
    if at < n or not out:
        out.append(n)
    return out


def chunks_of(text: str) -> list[bytes]:
    raw = text.encode("utf-8")
    out, at = [], 0
    for end in cut_places(raw):
        out.append(raw[at:end])
        at = end
    return out


def chunk_hash(chunk: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(chunk)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        found = [chunk_hash(c) for t in b.column(0).to_pylist() if t for c in chunks_of(t)]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["h"])


def shared_filter(texts: DataFrame) -> bytes:
    """Bit filter of the chunk hashes that occur more than once in ``texts``."""
    counts = texts.select("text").mapInArrow(_hashes, "h binary").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    word = lambda k: F.conv(F.hex(F.substring("h", 1 + 4 * k, 4)), 16, 10).cast("long")
    bit = F.explode(F.array(*[F.pmod(word(k), F.lit(FILTER_BITS)) for k in range(PROBES)]))
    words = (counts.where("n > 1").select(bit.alias("bit"))
             .groupBy(F.shiftright("bit", 5).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("bits")))
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    rows = words.toArrow()  # at most FILTER_BITS / 32 rows
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return table.tobytes()


def in_filter(h: bytes, table: np.ndarray) -> bool:
    for k in range(PROBES):
        bit = int.from_bytes(h[4 * k:4 * k + 4], "big") % FILTER_BITS
        if not int(table[bit >> 5]) >> (bit & 31) & 1:
            return False
    return True


def _last_unit(text: str) -> str:
    """The last unit of a text; looked for at its end first, as units are short."""
    for size in (64, 1024):
        if size < len(text):
            units = _UNIT.findall(text[-size:])
            if len(units) > 1:
                return units[-1]
    return _UNIT.findall(text)[-1]


def _first_unit(text: str) -> str:
    return _UNIT.match(text)[0]


def _many_units(text: str, least: int) -> bool:
    return sum(1 for _, _ in zip(_UNIT.finditer(text), range(least))) == least


def pieces_of(text: str, shared: Callable[[bytes], bool], encode: Callable[[str], bytes], id_bytes: int) -> list[list]:
    """Pieces [hash or None, ids dropped in front, ids dropped behind, ids or None, chunk or None].

    ``shared`` tells by its hash whether a chunk is to be referenced; one of under three units is
    not.  Put together, the pieces' ids are those of the whole text.
    """
    parts: list[list] = []  # references [hash, head, tail, own text, chunk]; others [None, text]
    for chunk in chunks_of(text):
        h, own = chunk_hash(chunk), chunk.decode("utf-8")
        if shared(h) and _many_units(own, 3):
            parts.append([h, 0, 0, own, chunk])
        elif parts and parts[-1][0] is None:
            parts[-1][1] += own
        else:
            parts.append([None, own])
    out: list[list] = parts[:1]
    short = bool(parts) and parts[0][0] is None and not _many_units(parts[0][1], 2)  # of the last of out
    for part in parts[1:]:
        left = out[-1]
        before = _last_unit(left[3] if left[0] else left[1])
        after = _first_unit(part[3] if part[0] else part[1])
        alone = part[0] is None and not _many_units(part[1], 2)
        if short or alone or encode(before) + encode(after) != encode(before + after):
            # What touches the join is encoded in one; the references beside it lose those ids.
            moved = ""
            if left[0]:
                left[2] += len(encode(before)) // id_bytes
                moved = before
            if part[0]:
                part[1] += len(encode(after)) // id_bytes
                moved += after
            if left[0] is None:
                left[1] += moved
            elif part[0] is None:
                part[1] = moved + part[1]
            else:
                out.append([None, moved])
        out.append(part)
        short = alone
    return [p if p[0] else [None, 0, 0, encode(p[1]), None] for p in out]


def _encode_step(tokenizer: str, table_bytes: bytes, finish, names: list[str]):
    """mapInArrow: (doc_id, text) -> kind 0: finished rows, 1: pieces, 2: shared chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, table = unit_encoder(tokenizer, "byte"), np.frombuffer(table_bytes, np.uint32)
        one, width, press = enc.one, enc.dtype.itemsize, zstandard.ZstdCompressor(level=1)
        base, sent, row = pa.schema([(n, k) for n, k in _PIECE_KINDS]), set(), row_base()
        for b in small(batches):
            done_docs, done_ids, rows = [], [], []
            for doc, text in zip(*(c.to_pylist() for c in b.columns)):
                pieces = pieces_of(text, lambda h: in_filter(h, table), one, width)
                if len(pieces) == 1 and pieces[0][0] is None:
                    done_docs.append(doc)
                    done_ids.append(pieces[0][3])
                else:
                    for seq, (h, head, tail, ids, chunk) in enumerate(pieces):
                        rows.append((1, doc, row, seq, h, head, tail, None if h else ids, None))
                        if h is not None and h not in sent:  # at least once from every task that has it
                            sent.add(h)
                            rows.append((2, None, None, None, h, None, None, None, press.compress(chunk)))
                    row += 1
                enc.trim()
            if len(sent) > 1_000_000:
                sent.clear()
            yield _wide(pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], base.field(i).type)
                                                    for i in range(len(base))], schema=base), None, names)
            yield _wide(None, finish(done_docs, done_ids), names)

    return run


_PIECE_KINDS = [("kind", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int64()), ("seq", pa.int32()), ("h", pa.binary()),
                ("head", pa.int32()), ("tail", pa.int32()), ("ids", pa.binary()), ("chunk", pa.binary())]


def _wide(pieces: pa.RecordBatch | None, done: pa.RecordBatch | None, names: list[str]) -> pa.RecordBatch:
    """One schema for both kinds of rows: the piece columns, then a struct of the finished columns."""
    if pieces is not None:
        n = pieces.num_rows
        columns = [*pieces.columns, pa.nulls(n, pa.struct(_FINISHED[tuple(names)]))]
    else:
        n = done.num_rows
        columns = [pa.array([0] * n, pa.int32()), *[pa.nulls(n, k) for _, k in _PIECE_KINDS[1:]],
                   pa.StructArray.from_arrays(done.columns, fields=list(_FINISHED[tuple(names)]))]
    return pa.RecordBatch.from_arrays(columns, [*[c for c, _ in _PIECE_KINDS], "done"])


_FINISHED = {
    ("doc_id", "n_tokens", "ids"): [pa.field("doc_id", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("ids", pa.binary())],
    ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"): [
        pa.field("doc_id", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()),
        pa.field("decoded_sha256", pa.string())],
}


class Decoder:
    """Bytes of every id; a text is their concatenation read as UTF-8."""

    def __init__(self, tokenizer: str):
        tok = load_tokenizer(tokenizer)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        vocab = tok.get_vocab(with_added_tokens=True)
        self.parts = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            known = all(c in byte_of for c in token)
            self.parts[i] = bytes(byte_of[c] for c in token) if known else token.encode("utf-8")
        self.decimals = [str(i) for i in range(len(self.parts))]

    def text(self, ids: list[int]) -> str:
        return b"".join(map(self.parts.__getitem__, ids)).decode("utf-8", "replace")

    def decimal(self, ids: list[int]) -> str:
        return ",".join(map(self.decimals.__getitem__, ids))


def decoder(tokenizer: str) -> Decoder:
    key = (tokenizer, "decoder")
    if key not in _LOADED:
        _LOADED[key] = Decoder(tokenizer)
    return _LOADED[key]


def keep_ids(tokenizer: str):
    """Finish: the ids themselves."""
    def finish(docs: list, ids: list[bytes]) -> pa.RecordBatch:
        width = unit_encoder(tokenizer, "byte").dtype.itemsize
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array([len(x) // width for x in ids], pa.int64()),
                                           pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])
    return finish, ["doc_id", "n_tokens", "ids"]


def digests(tokenizer: str):
    """Finish: number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded text."""
    def finish(docs: list, ids: list[bytes]) -> pa.RecordBatch:
        dec, dtype = decoder(tokenizer), unit_encoder(tokenizer, "byte").dtype
        counts, a, b = [], [], []
        for raw in ids:
            own = np.frombuffer(raw, dtype).tolist()
            counts.append(len(own))
            a.append(hashlib.sha256(dec.decimal(own).encode()).hexdigest())
            b.append(hashlib.sha256(dec.text(own).encode("utf-8")).hexdigest())
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(counts, pa.int64()), pa.array(a, pa.string()),
                                           pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return finish, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def encode_documents(docs: DataFrame, tokenizer: str, finisher=keep_ids) -> DataFrame:
    """One row per document: doc_id, n_tokens and what ``finisher`` makes of the ids."""
    texts = texts_of(docs)
    finish, names = finisher(tokenizer)
    spark_kind = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    done_schema = ", ".join(f"{f.name} {spark_kind[f.type]}" for f in _FINISHED[tuple(names)])
    inner = ", ".join(f"{f.name}: {spark_kind[f.type]}" for f in _FINISHED[tuple(names)])
    made = stage(texts.mapInArrow(_encode_step(tokenizer, shared_filter(texts), finish, names),
                                  f"{PIECES}, done struct<{inner}>"), "pieces")

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, plain = unit_encoder(tokenizer, "byte"), zstandard.ZstdDecompressor()
        for b in small(batches):
            texts = [plain.decompress(x).decode("utf-8") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(enc.encode(texts), pa.binary())], ["h", "own"])

    encoded = (made.where("kind = 2").select("h", "chunk").dropDuplicates(["h"])
               .mapInArrow(encode_chunks, "h binary, own binary"))
    pieces = made.where("kind = 1").select("doc_id", "row", "seq", "h", "head", "tail", "ids")
    width = unit_encoder(tokenizer, "byte").dtype.itemsize
    used = pieces.where("h IS NOT NULL").join(encoded, "h").select(
        "doc_id", "row", "seq", F.expr(f"substring(own, head * {width} + 1, length(own) - (head + tail) * {width})").alias("ids"))
    whole = (pieces.where("h IS NULL").select("doc_id", "row", "seq", "ids").unionByName(used)
             .groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("seq", "ids"))).alias("p"))
             .select("doc_id", F.transform("p", lambda x: x["ids"]).alias("p")))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            yield finish(b.column(0).to_pylist(), [b"".join(p) for p in b.column(1).to_pylist()])

    return made.where("kind = 0").select("done.*").unionByName(whole.mapInArrow(assemble, done_schema))


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of rows with ``ids`` as ``encode_documents`` writes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec, dtype = decoder(tokenizer), unit_encoder(tokenizer, "byte").dtype
        for b in small(batches):
            texts = [dec.text(np.frombuffer(x or b"", dtype).tolist()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
