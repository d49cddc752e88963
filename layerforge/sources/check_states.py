"""Tables stored in parts with the states of their quality checks, so that a report reads states, not rows.

Every check is a count of good rows among all it looks at, or needs counts per foreign key; both add up over parts.
A load writes its rows as a new part, computes the part's states from what it wrote, and commits both together:

    rows/            the part's rows
    _measures/       (layer, table, kind, name, good, total, note) of the part
    _columns/        (column, non_null, least, greatest, sketch): ranges, and distinct values as a mergeable sketch
    _keys-<column>/  (key, n): rows per foreign key

A report sums the states of all parts.  Rows of older parts are not opened again; integrity is checked with the
counts per key against the dimension as it is now, so keys that a dimension gains or loses later count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.operators import quality as Q
from layerforge.sources import versions as V

#: Size of the sketch of distinct values: relative standard error about 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_BITS = 12


@dataclass(frozen=True)
class CheckedTable:
    """A table in parts and what is measured of it: checks, profiled columns, foreign keys that are counted."""

    base: str
    layer: str
    name: str
    measures: tuple[Q.Measure, ...] = ()
    columns: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()


def append_part(spark: SparkSession, table: CheckedTable, rows: DataFrame) -> V.Version:
    """Store rows as a new part with their states; only these rows are read."""
    folder = f"part-{uuid.uuid4().hex}"
    path = f"{table.base.rstrip('/')}/{folder}"
    rows.write.mode("errorifexists").parquet(f"{path}/rows")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    Q.measured(stored, table.layer, table.name, table.measures).write.parquet(f"{path}/_measures")
    if table.columns:
        _column_states(stored, table.columns).write.parquet(f"{path}/_columns")
    for key in table.keys:
        stored.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/_keys-{key}")
    while True:
        last = V.newest(spark, table.base)
        if last is not None and last.entry["columns"] != [list(c) for c in rows.dtypes]:
            raise ValueError("the rows' columns are not those of the table")
        try:
            return V.commit(spark, table.base, {"paths": [*(last.paths if last else []), folder], "schema": rows.schema.json(),
                                                 "columns": [list(c) for c in rows.dtypes]}, last.n if last else 0)
        except V.CommitConflict:
            continue


def _column_states(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kind = lambda c: df.schema[c].dataType
    able = lambda c: F.col(c) if isinstance(kind(c), (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else F.col(c).cast("string")
    agg = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}"),
        F.hll_sketch_agg(able(c), SKETCH_BITS).alias(f"s{i}"))])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("non_null"), F.col(f"lo{i}").alias("least"),
                                                   F.col(f"hi{i}").alias("greatest"), F.col(f"s{i}").alias("sketch"))
                                          for i, c in enumerate(columns)])).alias("c")).select("c.*")


def _open(spark: SparkSession, table: CheckedTable, what: str) -> DataFrame | None:
    last = V.newest(spark, table.base)
    if last is None:
        return None
    return spark.read.parquet(*[f"{table.base.rstrip('/')}/{p}/{what}" for p in last.paths])


def read_rows(spark: SparkSession, table: CheckedTable) -> DataFrame:
    """All rows of all parts."""
    last = V.newest(spark, table.base)
    if last is None:
        raise FileNotFoundError(f"no version at {table.base}")
    return spark.read.schema(T.StructType.fromJson(json.loads(last.entry["schema"]))).parquet(
        *[f"{table.base.rstrip('/')}/{p}/rows" for p in last.paths])


def measures_of(spark: SparkSession, table: CheckedTable) -> DataFrame:
    """The table's measures, summed over its parts; one failed row for a table that was never loaded."""
    states = _open(spark, table, "_measures")
    if states is None:
        return Q.measured(Q.Unreadable(f"no version at {table.base}"), table.layer, table.name, ())
    return states.groupBy("layer", "table", "kind", "name", "note").agg(
        F.sum("good").alias("good"), F.sum("total").alias("total")).select("layer", "table", "kind", "name", "good", "total", "note")


def matched_keys(spark: SparkSession, table: CheckedTable, key: str, dimension: DataFrame, label: str) -> DataFrame:
    """Rows whose key finds a row of the dimension as it is now, from the stored counts per key."""
    counts = _open(spark, table, f"_keys-{key}").groupBy("key").agg(F.sum("n").alias("n"))
    keys = dimension.select(F.col(key).alias("_k")).distinct()
    found = counts.join(keys, F.col("key") == F.col("_k"), "left").agg(
        F.coalesce(F.sum(F.when(F.col("_k").isNotNull(), F.col("n"))), F.lit(0)).alias("good"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return found.select(F.lit(table.layer).alias("layer"), F.lit(table.name).alias("table"), F.lit("match").alias("kind"),
                        F.lit(label).alias("name"), "good", "total", F.lit("").alias("note"))


def report(spark: SparkSession, tables: Sequence[CheckedTable], integrity: Mapping[str, tuple[CheckedTable, str, DataFrame]]) -> DataFrame:
    """Check rows of all tables and of the integrity rules (label -> table, key, dimension), from states."""
    parts = [measures_of(spark, t) for t in tables]
    parts += [matched_keys(spark, t, key, dim, label) for label, (t, key, dim) in integrity.items()]
    return Q.checks_of(Q.union_all(parts))


def column_profile(spark: SparkSession, table: CheckedTable) -> DataFrame:
    """(column, non_null, least, greatest, distinct_values): ranges exact, distinct values estimated by the merged sketches."""
    kinds = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(V.newest(spark, table.base).entry["schema"])).fields}
    states = _open(spark, table, "_columns")
    ends = {c: (F.min(F.col("least").cast(kinds[c])).cast("string"), F.max(F.col("greatest").cast(kinds[c])).cast("string")) for c in table.columns}
    per_column = [states.where(F.col("column") == c).groupBy("column").agg(
        F.sum("non_null").alias("non_null"), ends[c][0].alias("least"), ends[c][1].alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values")) for c in table.columns]
    return reduce(DataFrame.unionByName, per_column)
