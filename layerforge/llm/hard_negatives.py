"""Hard-negative mining with an inverted multi-index: exact windows of inner products.

Vectors are cut into two halves, and each half has its own codebook, fitted on a bounded sample.  A row's
two codes name its cell.  All rows are indexed; the radius of a code is the largest distance of any row's
half from its centre.  For an anchor q, code i of a half bounds its half-score from above by
q.c_i + |q| * radius_i and from below by q.c_i - |q| * radius_i, and the two halves' bounds add up to
bounds for a cell.  A heap walks the cells in the order of the summed upper bounds (multi-sequence), without
ever listing all pairs of codes.

The search runs in rounds.  In each one an anchor that is not yet certified names its next cells, four times
as many as in the round before; anchors and cells meet in one shuffle, in groups of bounded size (a large cell
is cut into groups of rows, a much-asked one into groups of anchors); each group multiplies its two matrices
and keeps the k best of each window; a window function merges them with what was found before.  A window is
certified when it has k rows whose last score lies above the bound of every cell not yet visited, or when no
such cell can reach into it.  So results are exact, whatever the codebooks are; they only decide how many
cells are read.  The first search finds an anchor's positives (same label), the second one the negatives of
each positive (other labels, scores between two shares of the positive's).

Defined cases: rows with a null vec_id, a null label, a null vector or a null or non-finite component take no
part; shorter vectors are filled up with 0; weights and scores beyond a long end near its limits; rows count
each, repeated ones too, but no row of the anchor's own vec_id is its positive or negative; equal anchor rows
are one anchor, differing ones under one vec_id are anchors of their own; a negative positive_score has an
empty window; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.llm.common import row_base, stage
from layerforge.llm.exact_topk import finite

#: Rows of the codebooks' sample (fewer for very wide vectors), most codes of a half, rows aimed at per cell.
SAMPLE, SAMPLE_NUMBERS, MOST_CODES, CELL_ROWS = 8192, 1 << 22, 256, 256
#: Most rows and most anchors that meet in one group; anchors multiplied at once.
GROUP_ROWS, GROUP_ANCHORS, CHUNK = 8192, 8192, 64
FIRST_CELLS, GROWTH = 4, 4
WIDEST, LEAST, MOST = 1 << 62, -(1 << 63), (1 << 63) - 1
PLANNED = "key long, anchor_id long, label long, weights binary, scores array<long>, kth array<long>, pos int, cells array<int>, ahead double"
HIT = "key long, win int, vec_id long, score long"


@dataclass
class Codebooks:
    """Centres of both halves (the cut is at ``half``), their radii, and the rows of every occupied cell."""

    half: int
    first: np.ndarray
    second: np.ndarray
    radii: tuple[np.ndarray, np.ndarray] | None = None
    rows: dict[int, int] | None = None

    def cell(self, i: int, j: int) -> int:
        return i * len(self.second) + j


def _packed(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, width)


def _centres(points: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's codebook of a sample; starts from distinct points, spread over the sample."""
    own = np.unique(points, axis=0)
    centres = own[np.random.default_rng(0).permutation(len(own))[:codes]].copy()
    for _ in range(rounds):
        code = nearest(points, centres)[0]
        sums = np.zeros_like(centres)
        np.add.at(sums, code, points)
        n = np.bincount(code, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of every point, and the distance to it."""
    apart = (centres ** 2).sum(axis=1) - 2 * points @ centres.T
    code = apart.argmin(axis=1)
    return code, np.linalg.norm(points - centres[code], axis=1)


def fit_codebooks(rows: DataFrame, n: int, width: int, cell_rows: int = CELL_ROWS) -> Codebooks:
    """Codebooks from the rows whose hashes are smallest: at most SAMPLE rows, whatever the size of the table."""
    codes = min(MOST_CODES, max(1, math.ceil(math.sqrt(n / cell_rows))))
    bound = max(codes, min(SAMPLE, SAMPLE_NUMBERS // max(1, width)))
    sample = rows.select("weights").orderBy(F.xxhash64("weights", "row")).limit(bound).toPandas()
    points = np.frombuffer(b"".join(sample["weights"]), np.int64).reshape(len(sample), width).astype(np.float64)
    half = width // 2
    return Codebooks(half, _centres(points[:, :half], codes), _centres(points[:, half:], codes))


def _indexed(books: Codebooks, width: int):
    """mapInArrow: (row, vec_id, label, weights) -> with cell and the distances of both halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            m = _packed(b.column(3), width).astype(np.float64)
            i, far_i = nearest(m[:, :books.half], books.first)
            j, far_j = nearest(m[:, books.half:], books.second)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(i * len(books.second) + j, pa.int32()), pa.array(far_i), pa.array(far_j)],
                                             [*b.schema.names, "cell", "far_i", "far_j"])

    return run


def build_index(rows: DataFrame, n: int, width: int, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, Codebooks]:
    """All rows with their cell, and the codebooks with radii over all rows (at most MOST_CODES^2 cells)."""
    books = fit_codebooks(rows, n, width, cell_rows)
    index = stage(rows.mapInArrow(_indexed(books, width), "row long, vec_id long, label long, weights binary, cell int, far_i double, far_j double"),
                  "multi-index")
    cells = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far_i").alias("i"), F.max("far_j").alias("j")).collect()
    radii = np.zeros(len(books.first)), np.zeros(len(books.second))
    for c in cells:
        i, j = divmod(c["cell"], len(books.second))
        radii[0][i], radii[1][j] = max(radii[0][i], c["i"]), max(radii[1][j], c["j"])
    books.radii, books.rows = radii, {c["cell"]: c["n"] for c in cells}
    return index, books


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) in falling order of first[i] + second[j], from a heap of the cells next in line."""
    by_first, by_second = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap: list[tuple[float, int, int]] = []

    def offer(a: int, b: int) -> None:
        if a < len(first) and b < len(second):
            heapq.heappush(heap, (-(first[by_first[a]] + second[by_second[b]]), a, b))

    offer(0, 0)
    while heap:
        total, a, b = heapq.heappop(heap)
        yield -total, int(by_first[a]), int(by_second[b])
        # (a, b) brings the next pair of its row; the first pair of a row brings the row after it.
        offer(a, b + 1)
        if b == 0:
            offer(a + 1, 0)


def windows_of(scores, shares: tuple[int, int] | None) -> list[tuple[int, int]]:
    """Least and greatest score of every window: all scores, or two shares (in percent) of the given ones."""
    if shares is None:
        return [(LEAST, MOST)]
    low, high = shares
    return [(max(-(-low * int(s) // 100), LEAST), min(high * int(s) // 100, MOST)) for s in scores]


def _plan(books: Codebooks, want: int, shares: tuple[int, int] | None):
    """mapInArrow: anchors -> with the next cells to visit (``want`` at most) and the bound of all cells after them."""

    def bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mid, reach = centres @ q, np.linalg.norm(q) * radii
        room = 1e-9 * (np.abs(mid) + reach + np.linalg.norm(q) * np.linalg.norm(centres, axis=1)) + 1e-6
        return mid + reach + room, mid - reach - room

    def plan(q: np.ndarray, windows: list[tuple[int, int]], kth: list[int], pos: int):
        up_i, down_i = bounds(q[:books.half], books.first, books.radii[0])
        up_j, down_j = bounds(q[books.half:], books.second, books.radii[1])
        cells = []
        for at, (top, i, j) in enumerate(multi_sequence(up_i, up_j)):
            # Windows that cells of this bound can still change; later cells have no higher bound.
            live = [hi for (lo, hi), k in zip(windows, kth) if lo <= hi and top >= max(lo, k)]
            if not live:
                return cells, at, -math.inf
            if at < pos or books.cell(i, j) not in books.rows:
                continue
            if len(cells) == want:
                return cells, at, top
            if any(down_i[i] + down_j[j] <= hi for hi in live):
                cells.append(books.cell(i, j))
        return cells, 1 << 30, -math.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            anchors = b.to_pylist()
            found = [plan(np.frombuffer(a["weights"], np.int64).astype(np.float64), windows_of(a["scores"], shares), a["kth"], a["pos"])
                     for a in anchors]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("key", "anchor_id", "label", "weights", "scores", "kth")),
                 pa.array([f[1] for f in found], pa.int32()), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[2] for f in found], pa.float64())],
                ["key", "anchor_id", "label", "weights", "scores", "kth", "pos", "cells", "ahead"])

    return run


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of all rows, exact: in doubles, longs or Python integers, as their size asks."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, LEAST, MOST).astype(np.int64)


def best_rows(hits: np.ndarray, ids: np.ndarray, line: np.ndarray, k: int) -> np.ndarray:
    """The k of ``hits`` with the highest scores, ties to the smaller id."""
    if len(hits) > k:
        hits = hits[line[hits] >= np.partition(line[hits], len(hits) - k)[len(hits) - k]]
    return hits[np.lexsort((ids[hits], ~line[hits]))][:k]  # ~x falls as x rises, also at the ends of a long


def _meet(width: int, k: int, shares: tuple[int, int] | None):
    """cogroup: rows of a cell and the anchors that ask for it -> the k best rows of every anchor's windows."""

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        if len(rows) and len(asked):
            m = np.frombuffer(b"".join(rows["weights"]), np.int64).reshape(-1, width)
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            for at in range(0, len(asked), CHUNK):
                part = asked.iloc[at:at + CHUNK]
                products = exact_products(np.frombuffer(b"".join(part["weights"]), np.int64).reshape(-1, width), m)
                for key, own, label, scores, kth, line in zip(part["key"], part["anchor_id"], part["label"], part["scores"], part["kth"], products):
                    able = (ids != own) & ((labels == label) == (shares is None))
                    for win, ((lo, hi), least) in enumerate(zip(windows_of(scores, shares), kth)):
                        hits = np.flatnonzero(able & (line >= max(lo, int(least))) & (line <= hi))
                        out += [(key, win, int(ids[h]), int(line[h])) for h in best_rows(hits, ids, line, k)]
        return pd.DataFrame(out, columns=["key", "win", "vec_id", "score"]).astype({"key": "int64", "win": "int32", "vec_id": "int64", "score": "int64"})

    return run


def search(index: DataFrame, books: Codebooks, anchors: DataFrame, width: int, k: int,
           shares: tuple[int, int] | None = None) -> DataFrame:
    """(key, win, rank, vec_id, score): the k best rows of every window of every anchor, exact.

    ``anchors``: key, anchor_id, label, weights, scores.  Without ``shares`` the one window of an anchor are
    the rows of its label; with them there is a window per score, over the rows of other labels.
    """
    spark = index.sparkSession
    windows = F.lit(1) if shares is None else F.size("scores")
    state = anchors.select("key", "anchor_id", "label", "weights", "scores",
                           F.array_repeat(F.lit(LEAST), windows).alias("kth"), F.lit(0).alias("pos"))
    by_score = Window.partitionBy("key", "win").orderBy(F.col("score").desc(), F.col("vec_id"))
    held = spark.createDataFrame([(c, -(-n // GROUP_ROWS)) for c, n in books.rows.items()], "cell int, row_groups int")
    found, want = None, FIRST_CELLS
    while True:
        planned = stage(state.mapInArrow(_plan(books, want, shares), PLANNED), "planned-cells")
        asked = planned.select("key", "anchor_id", "label", "weights", "scores", "kth", F.explode("cells").alias("cell"))
        # One row per cell that somebody asks for: at most MOST_CODES^2 rows, so it may be broadcast.
        cells = stage(asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / GROUP_ANCHORS).cast("int").alias("anchor_groups"))
                      .join(held, "cell"), "asked-cells")
        if cells.isEmpty():
            break
        spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        rows = index.join(F.broadcast(cells), "cell").select(
            "cell", F.pmod(F.xxhash64("row"), F.col("row_groups")).cast("int").alias("g"), spread("anchor_groups").alias("p"),
            "vec_id", "label", "weights")
        asked = asked.join(F.broadcast(cells), "cell").select(
            "cell", spread("row_groups").alias("g"), F.pmod(F.xxhash64("key"), F.col("anchor_groups")).cast("int").alias("p"),
            "key", "anchor_id", "label", "weights", "scores", "kth")
        hits = rows.groupBy("cell", "g", "p").cogroup(asked.groupBy("cell", "g", "p")).applyInPandas(_meet(width, k, shares), HIT)
        found = stage((hits if found is None else found.select("key", "win", "vec_id", "score").unionByName(hits))
                      .withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k), "mined-rows")
        last = found.where(F.col("rank") == k).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("last"))
        state = planned.where(F.col("ahead") > F.lit(-math.inf)).join(last, "key", "left").select(
            "key", "anchor_id", "label", "weights", "scores",
            F.transform("kth", lambda _, win: F.coalesce(F.try_element_at("last", win), F.lit(LEAST))).alias("kth"), "pos")
        want *= GROWTH
    return found if found is not None else spark.createDataFrame([], HIT + ", rank int")


def _pack(width: int):
    """mapInArrow: (vec_id, label, weights array) -> row number of its own, and the weights as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = row_base()
        for b in batches:
            m = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(m)), pa.int64()), b.column(0), b.column(1),
                                              pa.array([x.tobytes() for x in m], pa.binary())], ["row", "vec_id", "label", "weights"])
            row += len(m)

    return run


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5,
                        negatives: int = 10, shares: tuple[int, int] = (30, 90), scale: float = 256.0,
                        cell_rows: int = CELL_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components are floor(scale * x); ``is_anchor`` is a condition on vec_id, ``label`` an expression (default:
    the column).  Negatives of a positive score between the two ``shares`` (percent) of the positive's score.
    """
    able = vectors.where(F.col("vec_id").isNotNull() & finite("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
        "embedding").where(F.col("label").isNotNull())
    width = max(2, able.agg(F.max(F.size("embedding"))).head()[0] or 0)
    whole = lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(WIDEST)), F.lit(-WIDEST))
    weights = F.concat(F.transform("embedding", whole), F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("embedding")))
    rows = stage(able.select("vec_id", "label", weights.alias("weights")).mapInArrow(
        _pack(width), "row long, vec_id long, label long, weights binary"), "mining-rows")
    n = rows.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    index, books = build_index(rows, n, width, cell_rows)
    anchors = stage(rows.where(is_anchor).groupBy("vec_id", "label", "weights").agg(F.min("row").alias("key")).select(
        "key", F.col("vec_id").alias("anchor_id"), "label", "weights"), "mining-anchors")
    near = search(index, books, anchors.withColumn("scores", F.array().cast("array<long>")), width, positives)
    of = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))
    asked = stage(anchors.join(of, "key").withColumn("scores", F.col("near.score")), "mining-positives")
    far = search(index, books, asked, width, negatives, shares)
    pairs = asked.select("key", "anchor_id", F.posexplode("near").alias("win", "positive"))
    return far.join(pairs, ["key", "win"]).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT row_number() OVER (ORDER BY vec_id, label, w) AS k, * FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0)),
s AS (SELECT k, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        CAST(list_sum(list_transform(list_zip(a.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM a JOIN v c ON c.vec_id <> a.vec_id),
p AS (SELECT k, anchor_id, vec_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS nr FROM s WHERE same QUALIFY nr <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.k, p.nr ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.k = p.k AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10"""
