"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Weights are integers; a term is a vector component.  Candidates are packed into blocks whose columns
are the postings of the terms; the queries are packed into blocks as well.  Each pair of a query
block and a candidate block is one row of an equi-join: term after term, the weights of the queries
that have the term are scattered over the postings into dense score arrays.  ``np.partition`` picks
the k best of the block, and a window merges the blocks' winners.  Every block is of bounded size,
and no table is broadcast.

Defined cases: null vectors and vectors with null or non-finite components take no part; a missing
component is 0, so lengths may differ; rows of one vec_id count each, also if their vectors are the same:
each is a candidate and, as a query, is compared with all rows of other ids (a query_id has
its k best scores over all its rows); rows with a null vec_id take no part; scores beyond a long end
at its limits; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.llm.common import stage

BLOCK, QUERY_BLOCK, CHUNK = 1024, 4096, 64
PACKED = "ids binary, width int, weights binary"
FOUND = "query_id long, vec_id long, score long"


def finite(vector: str) -> Column:
    """True for a vector without null, NaN or infinite components."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _pack(rows: int):
    """mapInArrow: (vec_id, weights) -> blocks of at most ``rows`` vectors, padded with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                lists = part.column(1).to_pylist()
                width = max(map(len, lists))
                w = np.zeros((len(lists), width), np.int64)
                for i, x in enumerate(lists):
                    w[i, :len(x)] = x
                ids = np.array(part.column(0).to_pylist(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([width], pa.int32()),
                                                  pa.array([w.tobytes()], pa.binary())], ["ids", "width", "weights"])

    return run


def _matrix(ids: bytes, width: int, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(weights, np.int64).reshape(len(own), width)


def _kind(a: np.ndarray, b: np.ndarray):
    """A type that holds every partial score of the two blocks."""
    top = max((abs(int(x)) for m in (a,) if m.size for x in (m.min(), m.max())), default=0)
    other = max((abs(int(x)) for m in (b,) if m.size for x in (m.min(), m.max())), default=0)
    most = top * other * max(1, min(a.shape[1], b.shape[1]))
    return np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Dense scores of a few queries against one block, accumulated term by term."""
    kind = _kind(queries, candidates)
    queries, candidates = queries.astype(kind), candidates.astype(kind)
    acc = np.zeros((len(queries), len(candidates)), kind)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        posting, weight = candidates[:, term], queries[:, term]
        rows, having = np.flatnonzero(posting), np.flatnonzero(weight)
        if not len(rows) or not len(having):
            continue
        if 2 * len(rows) > len(posting) and 2 * len(having) > len(weight):  # mostly filled: no scatter
            acc += weight[:, None] * posting[None, :]
        else:
            acc[np.ix_(having, rows)] += weight[having, None] * posting[None, rows]
    return acc


def best_of(acc: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of each query's k best in a block whose ids ascend."""
    more = int(np.unique(ids, return_counts=True)[1].max())  # as many more: the rows of its own id
    if len(ids) > k + more:
        least = np.partition(acc, len(ids) - k - more, axis=1)[:, len(ids) - k - more]
    else:
        least = [None] * len(acc)
    out = []
    for q, own, floor in zip(query_ids.tolist(), acc, least):
        near = np.arange(len(ids)) if floor is None else np.flatnonzero(own >= floor)
        near = near[ids[near] != q]
        ranked = sorted(zip([-int(s) for s in own[near]], ids[near].tolist()))[:k]
        out += [(q, i, max(min(-s, (1 << 63) - 1), -(1 << 63))) for s, i in ranked]
    return out


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                qid, q = _matrix(r["q_ids"], r["q_width"], r["q_weights"])
                cid, c = _matrix(r["ids"], r["width"], r["weights"])
                order = np.argsort(cid)
                cid, c, out = cid[order], c[order], []
                for at in range(0, len(qid), CHUNK):
                    out += best_of(scores(q[at:at + CHUNK], c), qid[at:at + CHUNK], cid, k)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)],
                                                 ["query_id", "vec_id", "score"])

    return run


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
               block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows of other ids; ties to the smaller vec_id.

    Components are floor(scale * x).  ``is_query`` is a condition on vec_id.
    """
    weights = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    clean = stage(vectors.where(F.col("vec_id").isNotNull() & finite("embedding"))
                  .select(F.col("vec_id").cast("long"), weights.alias("weights"),
                          F.monotonically_increasing_id().alias("row")), "topk-weights")
    n, n_queries = clean.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).head()
    q_parts, groups = max(1, math.ceil(n_queries / query_block)), max(1, math.ceil(n / (8 * block)))
    part = F.pmod(F.xxhash64("row"), F.lit(q_parts)).cast("int")
    # Each part of the queries is gathered and packed on its own; parts are of bounded size.
    asked = (clean.where(is_query).repartition(q_parts, part).sortWithinPartitions("vec_id").select("vec_id", "weights")
             .mapInArrow(_pack(query_block), PACKED).withColumn("qb", F.monotonically_increasing_id()))
    asked = stage(asked, "topk-queries")
    placed = (asked.select("qb", F.col("ids").alias("q_ids"), F.col("width").alias("q_width"),
                           F.col("weights").alias("q_weights"))
              .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    held = (clean.select("vec_id", "weights").mapInArrow(_pack(block), PACKED)
            .withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
            .join(placed.select("qb", "g").distinct(), "g"))
    # A query block has a row per group here, which the planner does not see: no broadcast.
    found = held.join(placed.hint("merge"), ["qb", "g"]).select(
        "q_ids", "q_width", "q_weights", "ids", "width", "weights").mapInArrow(_search(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
