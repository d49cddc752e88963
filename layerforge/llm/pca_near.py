"""Embedding near-duplicates by tiled comparison in the order of principal components.

Equal vectors become one class with a number of copies.  Unit vectors are turned into the basis of
their principal components.  Two unit vectors with cosine >= t differ by at most sqrt(2 - 2t) in
any direction, so classes are binned by that width along the first component (a handful of bins
on [-1, 1], whatever the input) and only equal and adjacent bins meet.  A bin is cut into tiles by
hash; every pair of tiles is one group.  Inside it the leading dimensions are multiplied first, the
rest is bounded by the product of the suffix norms, and only pairs that can still reach t go on to
further dimensions and at last to the double-precision cosine of the given values.  A group
returns link counts and a spanning forest of its links, never all pairs.

Defined cases: null vectors, zero vectors and vectors with null or non-finite components link with
nothing and name themselves; lengths may differ (missing components are 0); repeated rows are
separate vectors that link; a null vec_id links but never names a component while another id is
there, and is not kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import stage
from layerforge.llm.components import components
from layerforge.llm.exact_topk import finite

COSINE, STEP = 0.95, 16
PRODUCTS = 1 << 21  # products of leading dimensions held at a time
TILE_BYTES = 8 << 20  # of the vectors of one tile; a group holds two tiles
LINKS = 4096  # links taken into the forest between two looks at who is joined already
SLACK = 1e-4  # of single precision, far above its rounding error


def unit(rows: list, width: int) -> np.ndarray:
    """Unit vectors in double precision, padded with zeros; scaled first so squares can't overflow."""
    m = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        m[i, :len(x)] = x
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _moments(width: int):
    """mapInArrow: vectors -> the sums of products of their components, one row per pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            u = unit(b.column(0).to_pylist(), width)
            total += u.T @ u
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         ["i", "j", "x"])

    return run


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Columns: principal directions of the unit vectors, strongest first."""
    moments = vectors.mapInArrow(_moments(width), "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    i, j, x = (c.to_numpy() for c in moments.toArrow().columns)  # width * (width + 1) / 2 rows
    m = np.zeros((width, width))
    m[i, j] = m[j, i] = x
    return np.linalg.eigh(m)[1][:, ::-1]


def _turned(axes: np.ndarray):
    """mapInArrow: (cls, copies, embedding) -> first coordinate and the unit vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = unit(b.column(2).to_pylist(), len(axes))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(u @ axes[:, 0]),
                                              pa.array([x.tobytes() for x in u], pa.binary())],
                                             ["cls", "copies", "lead", "vector"])

    return run


def compare_tiles(x: np.ndarray, y: np.ndarray | None, axes: np.ndarray, cosine: float,
                  step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (row of x, row of y) of unit vectors, by chunks; y None: pairs inside x, once."""
    same = y is None
    y = x if same else y
    px, py = (x @ axes).astype(np.float32), (y @ axes).astype(np.float32)
    width = len(axes)
    cuts = list(range(step, width, step))
    tails = {c: (np.linalg.norm(px[:, c:], axis=1), np.linalg.norm(py[:, c:], axis=1)) for c in cuts}
    chunk = max(1, PRODUCTS // len(y))
    for at in range(0, len(x), chunk):
        own = slice(at, min(len(x), at + chunk))
        shift = at if same else 0
        lead = min(step, width)
        # The suffix norms as one more coordinate: product of the leading ones plus the bound.
        a, b = px[own, :lead], py[shift:, :lead]
        if cuts:
            a = np.hstack([a, tails[lead][0][own, None]])
            b = np.hstack([b, tails[lead][1][shift:, None]])
        reach = a @ b.T
        i, j = np.nonzero(reach >= cosine - SLACK)
        i, j = i + at, j + shift
        if same:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 1 << 16):
            pi, pj = i[part:part + (1 << 16)], j[part:part + (1 << 16)]
            so_far = np.einsum("ij,ij->i", px[pi, :lead], py[pj, :lead])
            for c, nxt in zip(cuts, [*cuts[1:], width]):
                able = so_far + tails[c][0][pi] * tails[c][1][pj] >= cosine - SLACK
                pi, pj, so_far = pi[able], pj[able], so_far[able]
                so_far += np.einsum("ij,ij->i", px[pi, c:nxt], py[pj, c:nxt])
            linked = np.einsum("ij,ij->i", x[pi], y[pj]) >= cosine
            yield pi[linked], pj[linked]


class Forest:
    """A spanning forest of the links of one group; links inside a tree cost one array look-up."""

    def __init__(self, nodes: int):
        self.tree, self.edges = np.arange(nodes), []

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        for at in range(0, len(i), LINKS):
            p, q = i[at:at + LINKS], j[at:at + LINKS]
            apart = np.flatnonzero(self.tree[p] != self.tree[q])
            if not len(apart):
                continue
            parent = self.tree.tolist()

            def root(k: int) -> int:
                while parent[k] != k:
                    parent[k] = parent[parent[k]]
                    k = parent[k]
                return k

            for a, b in zip(p[apart].tolist(), q[apart].tolist()):
                u, v = root(a), root(b)
                if u != v:
                    parent[v] = u
                    self.edges.append((a, b))
            tree = np.array(parent)
            while (tree != tree[tree]).any():
                tree = tree[tree]
            self.tree = tree


def tile_links(group: pd.DataFrame, axes: np.ndarray, cosine: float) -> pd.DataFrame:
    """Of one pair of tiles: (a, null, n) link counts and (a, b, 0) a spanning forest."""
    x, y = group[group["left"]], group[~group["left"]]
    cls = np.concatenate([x["cls"].to_numpy(), y["cls"].to_numpy()])
    copies = np.concatenate([x["copies"].to_numpy(), y["copies"].to_numpy()])
    width = len(axes)
    vx, vy = (np.frombuffer(b"".join(t["vector"]), np.float64).reshape(len(t), width) for t in (x, y))
    alone = bool(group["alone"].iat[0])
    counts, forest = np.zeros(len(cls), np.int64), Forest(len(cls))
    if len(x) and (alone or len(y)):
        for i, j in compare_tiles(vx, None if alone else vy, axes, cosine):
            j = j if alone else j + len(x)
            for p, q in ((i, j), (j, i)):
                counts += np.bincount(p, copies[q], len(cls)).astype(np.int64)
            forest.join(i, j)
    edges = np.array(forest.edges, np.int64).reshape(-1, 2)
    some = np.flatnonzero(counts)
    return pd.DataFrame({"a": np.concatenate([cls[some], cls[edges[:, 0]]]).astype("int64"),
                         "b": pd.array([None] * len(some) + cls[edges[:, 1]].tolist(), dtype="Int64"),
                         "n": np.concatenate([counts[some], np.zeros(len(edges))]).astype("int64")})


def near_embeddings(vectors: DataFrame, cosine: float = COSINE, tile: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    ``tile``: vectors of a tile, by default as many as fill ``TILE_BYTES``.  A vector is sent once to every tile
    that it meets, so wide tiles mean few copies.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    able = F.coalesce(finite("embedding") & F.exists("embedding", lambda v: v != 0), F.lit(False))
    classes = stage(rows.where(able).groupBy("embedding").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
        .withColumn("cls", F.monotonically_increasing_id()), "classes")
    width = classes.agg(F.max(F.size("embedding"))).head()[0]
    idle = rows.where(~able).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                    F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if width is None:
        return idle
    tile = tile or max(1, TILE_BYTES // (8 * width))
    axes = principal_axes(classes.select("embedding"), width)
    reach = math.sqrt(2 - 2 * cosine) + 1e-9
    turned = stage(classes.select("cls", "copies", "embedding").mapInArrow(
        _turned(axes), "cls long, copies long, lead double, vector binary")
        .withColumn("bin", F.floor(F.col("lead") / reach).cast("int")), "turned")
    # As many bins as fit on [-1, 1]: their tile numbers are a table of constant size.
    tiles = {r["bin"]: math.ceil(r["n"] / tile) for r in turned.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    of = F.create_map(*[F.lit(v) for k in tiles for v in (k, tiles[k])])
    first = {}
    for b in sorted(tiles):  # tiles numbered along the bins
        first[b] = sum(tiles[c] for c in first)
    start = F.create_map(*[F.lit(v) for k in first for v in (k, first[k])])
    meets = F.flatten(F.array(*[
        F.when(F.col("bin").isin([b - d for b in tiles]),
               F.sequence(start[F.col("bin") + d], start[F.col("bin") + d] + of[F.col("bin") + d] - 1))
        .otherwise(F.array().cast("array<int>")) for d in (-1, 0, 1)]))
    placed = turned.withColumn("own", (start[F.col("bin")] + F.pmod(F.xxhash64("cls"), of[F.col("bin")])).cast("int"))
    placed = placed.select("cls", "copies", "vector", "own", F.explode(meets).alias("other"))
    placed = placed.select("cls", "copies", "vector", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                           (F.col("own") <= F.col("other")).alias("left"), (F.col("own") == F.col("other")).alias("alone"))
    found = stage(placed.groupBy("i", "j").applyInPandas(
        lambda g: tile_links(g, axes, cosine), "a long, b long, n long"), "tile-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "cls")
    known = stage(classes.join(counts, "cls", "left").join(roots, "cls", "left").select(
        "cls", "embedding", "first", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("root", "cls").alias("root")), "class-links")
    names = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(names, "root").select("embedding", "n_links", "component_id")
    linked = rows.where(able).join(named, "embedding").select(
        "vec_id", "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return linked.unionByName(idle)
