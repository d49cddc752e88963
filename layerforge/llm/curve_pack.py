"""Packing along a space-filling curve.

Each document's ids are hashed into a vector of counts, projected to three dimensions and given
the key of its cell on a Hilbert curve.  Rows are range-sorted by that key, so neighbours on the
curve, which are like documents, lie together; every range is cut into sequences of exactly
``length`` ids.  What is left at the end of a range is cut into sequences of powers of two, so
no padding is needed.  The row number breaks ties, so a group of copies spreads over ranges.

Defined cases: null text -> the end id alone; null doc_id -> kept; repeated rows are separate
documents; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import row_base, small, stage, texts_of
from layerforge.llm.units import unit_encoder

LENGTH = 2048
END_ID = 1
CELLS = 1024          # hashed dimensions
DIMS, BITS = 3, 16    # curve
KEYED = "doc_id long, row long, curve long, ids binary"
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long")


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of integer coordinates below 2**bits.

    Skilling's transposed form: undo the excess work from the highest bit down, Gray-encode,
    then interleave the bits.
    """
    x = [c.astype(np.int64).copy() for c in cells.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ flip) >> b) & 1)
    return key


def curve_keys(id_arrays: list[np.ndarray], seed: int = 7) -> np.ndarray:
    """Hilbert key of each document's hashed, projected vector of ids."""
    plan = np.random.default_rng(seed).normal(size=(CELLS, DIMS))
    keys = []
    for at in range(0, len(id_arrays), 1000):
        part = id_arrays[at:at + 1000]
        vectors = np.stack([np.bincount((x.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(7)).astype(np.int64)
                                        % CELLS, minlength=CELLS) for x in part]).astype(float)
        vectors = np.log1p(vectors)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        place = 0.5 + 0.5 * np.tanh(vectors @ plan)
        cells = np.minimum((place * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
        keys.append(hilbert_keys(cells, BITS))
    return np.concatenate(keys) if keys else np.zeros(0, np.int64)


def _keyed(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = unit_encoder(tokenizer, "word")
        end = np.array([end_id], enc.dtype).tobytes()
        row = row_base()
        for b in small(batches):
            ids = [x + end for x in enc.encode(b.column(1).to_pylist())]
            keys = curve_keys([np.frombuffer(x, enc.dtype) for x in ids])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(range(row, row + len(ids)), pa.int64()),
                                              pa.array(keys, pa.int64()), pa.array(ids, pa.binary())],
                                             ["doc_id", "row", "curve", "ids"])
            row += len(ids)

    return run


def _cut(pieces: list[tuple], sizes: list[int]) -> list[list[tuple]]:
    """Cut a run of (doc_id, start, ids, doc_tokens) into runs of the given numbers of ids."""
    runs, queue = [], list(reversed(pieces))
    for size in sizes:
        run, room = [], size
        while room:
            doc, start, ids, total = queue.pop()
            run.append((doc, start, ids[:room], total))
            if len(ids) > room:
                queue.append((doc, start + room, ids[room:], total))
            room -= min(room, len(ids))
        runs.append(run)
    return runs


def _packed(length: int, id_bytes: int):
    dtype = np.dtype(f"<u{id_bytes}")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, filled = row_base(), [], 0
        rows: list[tuple] = []

        def close(pieces: list[tuple]) -> None:
            nonlocal seq
            at = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, seq, at))
                at += len(ids)
            seq += 1

        def flushed():
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
            rows.clear()
            return out

        for b in small(batches):
            for doc, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                ids = np.frombuffer(raw, dtype)
                total, start = len(ids), 0
                while start < total:
                    part = ids[start:start + length - filled]
                    held.append((doc, start, part, total))
                    start += len(part)
                    filled += len(part)
                    if filled == length:
                        close(held)
                        held, filled = [], 0
                if len(rows) > 20_000:
                    yield flushed()
        for piece_run in _cut(held, [1 << k for k in range(filled.bit_length() - 1, -1, -1) if filled >> k & 1]):
            close(piece_run)
        if rows:
            yield flushed()

    return run


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    keyed = stage(texts_of(docs).mapInArrow(_keyed(tokenizer, end_id), KEYED), "curve")
    order = [F.col("curve"), F.col("doc_id").asc_nulls_first(), F.col("row")]
    id_bytes = unit_encoder(tokenizer, "word").dtype.itemsize
    return (keyed.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(_packed(length, id_bytes), PIECE))
