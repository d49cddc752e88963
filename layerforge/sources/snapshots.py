"""Change capture between stored snapshots by a tree of digests over key buckets.

A snapshot is stored by leaf (a hash of the key) together with the digests of its leaves and of the nodes above
them.  A leaf's digest does not depend on the order of rows: their number, and the sum and the exclusive or of two
64-bit row hashes.  A node's digest is the hash of its children's.  To compare two snapshots the tree is walked from
the root, into nodes whose digests differ only; leaves that are equal are never read.  (Different leaves have equal
digests with a chance of about 2^-128.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.operators.extras import snapshot_diff
from layerforge.sources import versions as V
from layerforge.sources.merge_table import hash_of

LEAF, LEAVES, FAN = "_leaf", 256, 16
DIGESTS = "_digests"


def _leaf_digest(columns: Sequence[str]) -> Column:
    one = hash_of(columns)
    two = F.xxhash64(F.lit("second"), one, *[F.col(c) for c in columns])
    return F.sha2(F.concat_ws("|", F.count(F.lit(1)), F.sum(one.cast("decimal(38,0)")), F.bit_xor(two)), 256)


def publish_snapshot(df: DataFrame, base: str, keys: Sequence[str], leaves: int = LEAVES, fan: int = FAN) -> V.Version:
    """Store a keyed table with its digest tree as the next version."""
    spark, folder = df.sparkSession, f"snapshot-{uuid.uuid4().hex}"
    path = f"{base.rstrip('/')}/{folder}"
    (df.withColumn(LEAF, F.pmod(hash_of(keys), F.lit(leaves)).cast("int")).hint("rebalance", LEAF)
     .write.mode("errorifexists").partitionBy(LEAF).parquet(path))
    stored = spark.read.schema(T.StructType(df.schema.fields + [T.StructField(LEAF, T.IntegerType())])).parquet(path)
    level = stored.groupBy(F.col(LEAF).alias("node")).agg(_leaf_digest(df.columns).alias("digest")).select(F.lit(0).alias("level"), "node", "digest")
    digests = f"{path}/{DIGESTS}"
    height, wide = 0, leaves
    while True:  # one small table a level, at most ``leaves`` rows
        level.write.mode("errorifexists").parquet(f"{digests}/level={height}")
        if wide == 1:
            break
        below = spark.read.schema("node int, digest string").parquet(f"{digests}/level={height}")
        height, wide = height + 1, -(-wide // fan)
        level = below.groupBy(F.floor(F.col("node") / fan).cast("int").alias("node")).agg(
            F.sha2(F.concat_ws("|", F.array_sort(F.collect_list(F.concat_ws(":", "node", "digest")))), 256).alias("digest"))
    return V.commit(spark, base, {"paths": [folder], "keys": list(keys), "leaves": leaves, "fan": fan, "height": height,
                                    "schema": df.schema.json(), "columns": [list(c) for c in df.dtypes]})


def _snapshot(spark: SparkSession, base: str, n: int) -> V.Version:
    v = V.version(spark, base, n)
    if v is None:
        raise FileNotFoundError(f"no version {n} at {base}")
    return v


def _rows(spark: SparkSession, base: str, v: V.Version) -> DataFrame:
    fields = T.StructType.fromJson(json.loads(v.entry["schema"])).fields
    return spark.read.schema(T.StructType(fields + [T.StructField(LEAF, T.IntegerType())])).parquet(f"{base.rstrip('/')}/{v.paths[0]}")


def read_snapshot(spark: SparkSession, base: str, n: int) -> DataFrame:
    return _rows(spark, base, _snapshot(spark, base, n)).drop(LEAF)


def changed_leaves(spark: SparkSession, base: str, old: V.Version, new: V.Version) -> list[int]:
    """Leaves whose digests differ; per level only the children of differing nodes are looked at."""
    shape = ("leaves", "fan", "height", "keys", "columns")
    if any(old.entry[c] != new.entry[c] for c in shape):
        raise ValueError("the snapshots have different trees or columns")
    nodes = [0]
    for height in range(new.entry["height"], -1, -1):
        sides = [{r["node"]: r["digest"] for r in spark.read.schema("node int, digest string").parquet(
            f"{base.rstrip('/')}/{v.paths[0]}/{DIGESTS}/level={height}").where(F.col("node").isin(nodes)).collect()} for v in (old, new)]
        nodes = [n for n in nodes if sides[0].get(n) != sides[1].get(n)]
        if not nodes or height == 0:
            return nodes
        nodes = [c for n in nodes for c in range(n * new.entry["fan"], (n + 1) * new.entry["fan"]) if c < new.entry["leaves"]]
    return nodes


def snapshot_changes(spark: SparkSession, base: str, old: int, new: int) -> DataFrame:
    """INSERT, UPDATE and DELETE rows between two versions; only differing leaves are read."""
    a, b = _snapshot(spark, base, old), _snapshot(spark, base, new)
    leaves = changed_leaves(spark, base, a, b)
    sides = [_rows(spark, base, v).where(F.col(LEAF).isin(leaves) if leaves else F.lit(False)).drop(LEAF) for v in (a, b)]
    return snapshot_diff(*sides, a.entry["keys"])
