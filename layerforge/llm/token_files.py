"""Token-id files: every document its own zstandard frame, one shared dictionary, an offset index.

A dataset below one path has two Parquet tables: ``dictionary`` (one row: hash, bytes) and
``blocks``.  A block row holds the frames of consecutive documents in ``payload``, and an index:
``doc_ids``, ``counts`` (ids of each document), ``offsets`` (where each frame starts, and the end)
and ``inside`` (ids before the block in what its task wrote).  Blocks ascend by ``block``, documents inside and across them by doc_id (nulls first).  A
short document is read by slicing one payload and decompressing one frame.  Spark writes the
files, so any shared store will do and a lost executor's block is written again.

Only the dictionary's training sample is bounded (``sample_docs`` texts, ``sample_chars`` of each).

Defined cases: null text -> the end id alone; null doc_id -> kept, sorts first; repeated rows are
separate documents; an empty table gives empty files with an empty dictionary; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerforge.llm.common import row_base, small, stage, texts_of
from layerforge.llm.units import unit_encoder

END_ID = 2
DICT_BYTES = 1 << 16
BLOCK_BYTES = 4 << 20
FRAME_SCHEMA = "doc_id long, row long, n_tokens long, frame binary"
BLOCK_SCHEMA = ("block long, inside long, dict_hash string, doc_ids array<long>, counts array<long>, "
                "offsets array<long>, payload binary")
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def serialize(ids: np.ndarray, dtype: np.dtype) -> bytes:
    return ids.astype(dtype).tobytes()


def _zdict(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def train_dictionary(texts: DataFrame, tokenizer: str, sample_docs: int = 400,
                     sample_chars: int = 6000) -> bytes:
    """Dictionary trained on the id arrays of about ``sample_docs`` texts, chosen by hash.

    Empty when there are too few samples to train on.
    """
    import zstandard

    # First thinned to a few times the sample, by hash: what the tasks send does not grow with their number.
    thin = max(1, texts.count() // (4 * sample_docs))
    mark = F.xxhash64("doc_id", "text")
    rows = (texts.where(F.pmod(mark, F.lit(thin)) == 0).select(mark.alias("h"), F.substring("text", 1, sample_chars).alias("t"))
            .orderBy("h", "t").limit(sample_docs).collect())
    samples = [x for x in unit_encoder(tokenizer, "byte").encode([r["t"] for r in rows]) if len(x) >= 16]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _frames(tokenizer: str, end_id: int, raw: bytes):
    """mapInArrow: (doc_id, text) -> one compressed frame per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc = unit_encoder(tokenizer, "byte")
        press = zstandard.ZstdCompressor(level=3, dict_data=_zdict(raw))
        end = np.array([end_id], enc.dtype).tobytes()
        row = row_base()
        for b in small(batches):
            ids = [x + end for x in enc.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(range(row, row + len(ids)), pa.int64()),
                pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64()),
                pa.array([press.compress(x) for x in ids], pa.binary())],
                ["doc_id", "row", "n_tokens", "frame"])
            row += len(ids)

    return run


def _blocks(dict_hash: str):
    """mapInArrow over ordered frames: consecutive frames -> block rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, inside, docs, counts, offsets, parts = row_base(), 0, [], [], [0], []

        def made():
            cols = [[block], [inside], [dict_hash], [docs], [counts], [offsets], [b"".join(parts)]]
            kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              ["block", "inside", "dict_hash", "doc_ids", "counts", "offsets", "payload"])

        for b in small(batches):
            for doc, n, frame in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame"))):
                docs.append(doc)
                counts.append(n)
                parts.append(frame)
                offsets.append(offsets[-1] + len(frame))
                if offsets[-1] >= BLOCK_BYTES:
                    yield made()
                    block, inside, docs, counts, offsets, parts = block + 1, inside + sum(counts), [], [], [0], []
        if docs:
            yield made()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every document and write the dataset below ``path`` in ascending doc_id order."""
    spark = docs.sparkSession
    texts = texts_of(docs)
    raw = train_dictionary(texts, tokenizer)
    dict_hash = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(dict_hash, raw)], "dict_hash string, raw binary").coalesce(1).write.parquet(f"{path}/dictionary")
    # Written first, so that the range sampling below does not encode the texts a second time.
    frames = stage(texts.mapInArrow(_frames(tokenizer, end_id, raw), FRAME_SCHEMA), "frames")
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    (frames.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(_blocks(dict_hash), BLOCK_SCHEMA).write.parquet(f"{path}/blocks"))


def _load_dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.schema("dict_hash string, raw binary").parquet(f"{path}/dictionary").head()
    raw = bytes(row["raw"])
    if hashlib.sha256(raw).hexdigest() != row["dict_hash"]:
        raise ValueError("the dictionary does not match its hash")
    return row["dict_hash"], raw


def _opened(dict_hash: str, raw: bytes, id_bytes: int, with_ids: bool):
    """mapInArrow: (start, block columns) -> one row per document, from its decompressed frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        plain = zstandard.ZstdDecompressor(dict_data=_zdict(raw))
        dtype = np.dtype(f"<u{id_bytes}")
        for b in small(batches, 1):  # one block at a time
            for r in b.to_pylist():
                if r["dict_hash"] != dict_hash:
                    raise ValueError(f"block {r['block']} was written with another dictionary")
                start, out = r["start"], []
                for doc, n, a, z in zip(r["doc_ids"], r["counts"], r["offsets"], r["offsets"][1:]):
                    ids = np.frombuffer(plain.decompress(r["payload"][a:z]), dtype)
                    wide = serialize(ids, np.dtype("<u4"))
                    out.append((doc, start, len(ids), zlib.crc32(wide), ids.tolist() if with_ids else None))
                    start += n
                cols = list(zip(*out))
                arrays = [pa.array(c, pa.int64()) for c in cols[:4]]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(cols[4], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def read_token_files(spark: SparkSession, path: str, tokenizer: str, doc_ids: list[int] | None = None,
                     with_ids: bool = False) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens, ids_crc32 (and ids).

    ``doc_ids`` opens only the blocks whose index names one of them.
    """
    dict_hash, raw = _load_dictionary(spark, path)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # A block knows the ids before it in its writing task; those of the tasks before are one row per task.
    part = F.shiftright("block", 40).alias("part")
    totals = blocks.groupBy(part).agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = totals.select("part", F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    if doc_ids is not None:
        blocks = blocks.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(int(d)) for d in doc_ids])))
    opened = (blocks.withColumn("part", part).join(F.broadcast(before), "part")
              .withColumn("start", F.col("before") + F.col("inside")).drop("part", "before", "inside"))
    id_bytes = unit_encoder(tokenizer, "byte").dtype.itemsize
    out = opened.mapInArrow(_opened(dict_hash, raw, id_bytes, with_ids),
                            DOC_SCHEMA + (", ids array<long>" if with_ids else ""))
    return out if doc_ids is None else out.where(F.col("doc_id").isin([int(d) for d in doc_ids]))
