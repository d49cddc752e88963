"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: majority bit of the XXH64 values of the word shingles.  For radius r every one of the
64 bit places gets a fixed vector of r + 1 bits; each non-zero vector v of r + 1 bits gives a mask
of the places whose vector has an even product with v.  Any r places leave some v that is
orthogonal to all their vectors, so a pair that differs in those places alone agrees under that
mask: each pair within the radius meets in some of the 2**(r+1) - 1 tables.

A table's bucket is compared in blocks.  Buckets above ``block`` fingerprints are cut into blocks
by hash and each pair of blocks is its own group, so one large bucket spreads over many tasks.  A
group returns a spanning forest of its links, not all pairs.

Defined cases: null or empty text -> fingerprint zero, linked like any other; rows with a null
doc_id keep a fingerprint and link, and the smallest non-null doc_id names the component (null if
there is none); repeated rows stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import free_names, small, stage, texts_of
from layerforge.llm.components import components

SHINGLE, RADIUS, SEED, BLOCK = 4, 4, 42, 1024


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the ASCII-lower-cased words' shingles, repeats counted."""
    import xxhash

    line = b" ".join(text.encode("utf-8").lower().split())
    if not line:
        return 0
    view, gaps = memoryview(line), np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(line))  # of the words
    n = max(1, len(starts) - shingle + 1)
    last = min(shingle, len(starts)) - 1
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        upto = min(n, at + (1 << 16))
        raw = b"".join([digest(view[a:z], seed) for a, z in zip(starts[at:upto].tolist(), ends[at + last:upto + last].tolist())])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            marks = np.array([fingerprint(t, shingle, seed) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks.view(np.int64)), *b.columns[2:]],
                                             ["doc_id", "mark", *b.schema.names[2:]])

    return run


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits, as signed 64-bit integers."""
    width = radius + 1
    rng = random.Random(1009 * radius + bits)
    # Each non-zero vector as often as any other, in a fixed random order; zero would waste a place.
    vectors = [1 + i % ((1 << width) - 1) for i in range(bits)]
    rng.shuffle(vectors)
    masks = []
    for v in range(1, 1 << width):
        mask = sum(1 << i for i, x in enumerate(vectors) if bin(x & v).count("1") % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def spanning_links(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within the radius between two sorted arrays (or inside one), thinned to a forest.

    ``left`` is ``right`` for a group inside one block.
    """
    same = left is right
    nodes = left if same else np.concatenate([left, right])
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out, shift = [], 0 if same else len(left)
    for i, x in enumerate(left):
        rest = right[i + 1:] if same else right
        near = np.flatnonzero(np.bitwise_count((rest ^ x).view(np.uint64)) <= radius)
        base = i + 1 if same else shift
        for j in near.tolist():
            a, b = root(i), root(base + j)
            if a != b:
                parent[b] = a
                out.append((int(x), int(rest[j])))
    return out


def simhash_links(marks: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints that keep every component together."""
    masks = F.array(*[F.lit(m) for m in covering_masks(radius)])
    # A bucket is named by its table and what the mask leaves; 64 bits of a hash name it shortly,
    # and two buckets under one name only cost a needless comparison.
    keyed = (marks.select("mark", F.posexplode(masks).alias("table", "mask"))
             .select("mark", F.xxhash64("table", F.col("mark").bitwiseAND(F.col("mask"))).alias("bucket")))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # The planner does not see that each fingerprint has a row per table; the hints keep it from broadcasting.
    held = keyed.join(sizes.hint("merge"), "bucket").select(
        "mark", "bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    held = held.withColumn("own", F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int"))
    # Each pair of blocks is a group; a row goes to the pairs that name its block.
    placed = held.select("mark", "bucket", "blocks", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = placed.select("mark", "bucket", "blocks", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iat[0], group["j"].iat[0]
        marks = group["mark"].to_numpy()
        left = np.sort(marks[group["own"].to_numpy() == i])
        found = spanning_links(left, left if i == j else np.sort(marks[group["own"].to_numpy() == j]), radius)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    small = held.where("blocks = 1").groupBy("bucket").agg(F.collect_list("mark").alias("marks"))
    large = placed.where("blocks > 1")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for m in b.column(0).to_pylist():
                own = np.sort(np.array(m, np.int64))
                out += spanning_links(own, own, radius)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return (small.select("marks").mapInArrow(pairs, "a long, b long")
            .union(large.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long")).distinct())


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                   block: int = BLOCK, carry: str | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    ``carry`` takes a long column along; mark_root then tells components without a doc_id apart.
    """
    texts = texts_of(docs, carry=[carry] if carry else [])
    extra = f", {carry} long" if carry else ""
    marked = stage(texts.mapInArrow(_fingerprints(shingle, seed), "doc_id long, mark long" + extra), "marks")
    marks = stage(marked.groupBy("mark").agg(F.min("doc_id").alias("first")), "distinct-marks")
    found = components(stage(simhash_links(marks, radius, block), "mark-links"))
    roots = marks.join(found, marks["mark"] == found["node"], "left").select(
        "mark", "first", F.coalesce("root", "mark").alias("root"))
    named = roots.join(roots.groupBy("root").agg(F.min("first").alias("component_id")), "root").select(
        "mark", "component_id", F.col("root").alias("mark_root"))
    return marked.join(named, "mark").select(
        "doc_id", F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id",
        *([carry, "mark_root"] if carry else []))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """One row of each component, all columns kept: smallest doc_id (nulls last), then text hash."""
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    groups = stage(simhash_groups(hashed, carry="h", **how), "simhash-groups")
    keys = groups.groupBy("mark_root", "doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    own, text, many = free_names(docs, "own_id", "own_text", "many")
    best = stage(keys.groupBy("mark_root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "n")).alias("k"))
        .select(F.col("k.doc_id").alias(own), F.col("k.h").alias(text), F.col("k.n").alias(many)), "simhash-kept")
    same = docs["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(docs["text"]) == F.col(text))
    kept = docs.join(best.where(F.col(many) == 1).hint("shuffle_hash"), same, "left_semi")
    if best.where(F.col(many) > 1).isEmpty():
        return kept
    repeats = docs.join(best.where(F.col(many) > 1).hint("shuffle_hash"), same, "left_semi")
    return kept.unionByName(repeats.dropDuplicates(["doc_id", "text"]))
