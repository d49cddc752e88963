"""Merge-on-read tables: a load writes its change file only, readers merge, compaction rewrites what is due.

A table holds one row per key: the newest by an order column, NULLs lowest, ties by the other columns (the rule
of ``dedup_latest``; a NULL in a key is a value like any other).  Rows are dealt to buckets by a hash of the key.
A version names

    bases    folders with the merged rows of some buckets; every bucket lives in one of them at most
    deltas   change files, in which the newest rows per key of one load lie by bucket

Newest-per-key does not depend on the order in which rows arrive, so a load never reads the table (but for the
rows at its own watermark, which it leaves out when they are there already), and two loads that collide are both
committed, one after the other, as they are.

Readers pass buckets without a delta straight through.  In the others the deltas' key hashes are the filter: base
rows whose key no delta holds pass straight through as well, only the rest is grouped.  The hashes are broadcast up
to FILTER_ROWS of them; beyond that the touched buckets are merged as a whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.operators.windows import dedup_latest
from layerforge.sources import versions as V

BUCKET, HASH = "_bucket", "_key_hash"
#: Most change rows whose key hashes a reader broadcasts (8 bytes each).
FILTER_ROWS = 2_000_000


@dataclass(frozen=True)
class MergeTable:
    """Where a table lies, its key, and the column by which the newest row wins; ``deal_by``: default the key."""

    base: str
    keys: tuple[str, ...]
    order: str
    buckets: int = 64
    deal_by: tuple[str, ...] | None = None


def hash_of(columns: Sequence[str]) -> Column:
    """64-bit hash that tells NULLs by their place (``xxhash64`` alone skips them)."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*[F.col(c) for c in columns], nulls)


def bucket_of(table: MergeTable) -> Column:
    return F.pmod(hash_of(table.deal_by or table.keys), F.lit(table.buckets)).cast("int")


def same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    """NULL-safe equality of the columns; an equi-join."""
    return reduce(Column.__and__, [a[c].eqNullSafe(b[c]) for c in columns])


def _schema(v: V.Version) -> T.StructType:
    return T.StructType.fromJson(json.loads(v.entry["schema"]))


def _stored(spark: SparkSession, table: MergeTable, v: V.Version, part: str, buckets: Sequence[int]) -> DataFrame:
    """Rows of one folder in the given buckets, read from their folders alone."""
    full = T.StructType(_schema(v).fields + [T.StructField(HASH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(full).parquet(f"{table.base.rstrip('/')}/{part}").where(F.col(BUCKET).isin([int(b) for b in buckets]))


def _write(table: MergeTable, rows: DataFrame) -> tuple[str, dict[int, int]]:
    """A new folder with the rows by bucket; rows per bucket."""
    part = f"part-{uuid.uuid4().hex}"
    path = f"{table.base.rstrip('/')}/{part}"
    # Rebalanced, not one task a bucket: a large bucket is written by several.
    (rows.withColumn(HASH, hash_of(table.keys)).withColumn(BUCKET, bucket_of(table)).hint("rebalance", BUCKET)
     .write.mode("errorifexists").partitionBy(BUCKET).parquet(path))
    full = T.StructType(rows.schema.fields + [T.StructField(HASH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    counts = rows.sparkSession.read.schema(full).parquet(path).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
    return part, {r[BUCKET]: r["n"] for r in counts}


def _parts(v: V.Version | None) -> tuple[dict, dict]:
    """(bases, deltas): folder -> {bucket: rows}."""
    if v is None:
        return {}, {}
    return tuple({p: {int(b): n for b, n in own.items()} for p, own in v.entry[kind].items()} for kind in ("bases", "deltas"))


def _entry(rows_schema: T.StructType, bases: dict, deltas: dict, watermark: str | None) -> dict:
    bases, deltas = ({p: own for p, own in parts.items() if own} for parts in (bases, deltas))
    return {"paths": [*bases, *deltas], "bases": bases, "deltas": deltas, "schema": rows_schema.json(), "watermark": watermark}


def _newest_rows(table: MergeTable, rows: DataFrame) -> DataFrame:
    return dedup_latest(rows, table.keys, table.order, drop_null_keys=False)


def load(spark: SparkSession, table: MergeTable, fresh: DataFrame, parent: int | None = None) -> V.Version | None:
    """Add rows to the table: writes their change file and commits it.

    Without ``parent`` a commit that meets another one is repeated after it.  With it, one that finds a later
    version than ``parent`` (0: none) raises ``CommitConflict`` and leaves nothing but its unnamed folder.
    """
    taken = [c for c in (BUCKET, HASH) if c in fresh.columns]
    if taken:
        raise ValueError(f"column names in use: {taken}")
    part, counts = _write(table, _newest_rows(table, fresh))
    if not counts:
        V.delete(spark, f"{table.base.rstrip('/')}/{part}")
        return V.newest(spark, table.base)
    high = spark.read.schema(fresh.schema).parquet(f"{table.base.rstrip('/')}/{part}").agg(F.max(table.order)).head()[0]
    while True:
        last = V.newest(spark, table.base)
        bases, deltas = _parts(last)
        if last is None:
            bases = {part: counts}
        else:
            if [(f.name, f.dataType) for f in _schema(last)] != [(f.name, f.dataType) for f in fresh.schema]:
                raise ValueError("the rows' columns are not those of the table")
            deltas = {**deltas, part: counts}
        marks = [m for m in (_watermark(last, table), high) if m is not None]
        kept = str(max(marks)) if marks else None
        try:
            return V.commit(spark, table.base, _entry(fresh.schema, bases, deltas, kept),
                            parent if parent is not None else last.n if last else 0)
        except V.CommitConflict:
            if parent is not None:
                raise


def _watermark(v: V.Version | None, table: MergeTable):
    """Greatest order value loaded so far, in its own type."""
    if v is None or v.entry["watermark"] is None:
        return None
    kind, text = _schema(v)[table.order].dataType, v.entry["watermark"]
    if isinstance(kind, T.DateType):
        from datetime import date
        return date.fromisoformat(text)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        from datetime import datetime
        return datetime.fromisoformat(text)
    if isinstance(kind, (T.IntegralType,)):
        return int(text)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(text)
    if isinstance(kind, T.DecimalType):
        from decimal import Decimal
        return Decimal(text)
    return text


def load_since(spark: SparkSession, table: MergeTable, source: DataFrame, overlap_days: int = 0) -> V.Version | None:
    """Load what ``source`` holds from the watermark on.

    The watermark's own day (value) is read again, as more of its rows may have come, and so are rows without an
    order value, which have no place in time; ``overlap_days`` goes further back.  Rows that the table's files
    already hold are not written again.
    """
    last = V.newest(spark, table.base)
    mark = _watermark(last, table)
    if mark is None:
        return load(spark, table, source)
    order = F.col(table.order)
    since = order >= (F.date_sub(F.lit(mark), overlap_days) if overlap_days else F.lit(mark))
    fresh = _newest_rows(table, source.where(order.isNull() | since))
    known = _every(spark, table, last).where(order.isNull() | since).select(*fresh.columns)
    return load(spark, table, fresh.join(known, same(fresh, known, fresh.columns), "left_anti"))


def _every(spark: SparkSession, table: MergeTable, v: V.Version) -> DataFrame:
    bases, deltas = _parts(v)
    return reduce(DataFrame.unionByName, [_stored(spark, table, v, p, list(own)) for p, own in [*bases.items(), *deltas.items()]])


def read(spark: SparkSession, table: MergeTable, buckets: Sequence[int] | None = None, at: V.Version | None = None) -> DataFrame:
    """The newest row per key, of all buckets or of some; of the newest version or of ``at``."""
    v = at or V.newest(spark, table.base)
    if v is None:
        raise FileNotFoundError(f"no version at {table.base}")
    wanted = set(range(table.buckets)) if buckets is None else set(buckets)
    columns = _schema(v).names
    of = lambda parts, some: [_stored(spark, table, v, p, sorted(set(own) & some)).select(*columns, HASH)
                              for p, own in parts.items() if set(own) & some]
    bases, deltas = _parts(v)
    touched = {b for own in deltas.values() for b in own} & wanted
    out = of(bases, wanted - touched)
    if touched:
        changes, old = of(deltas, touched), of(bases, touched)
        changed = reduce(DataFrame.unionByName, changes)
        if old:
            whole = reduce(DataFrame.unionByName, old)
            if sum(n for own in deltas.values() for b, n in own.items() if b in touched) <= FILTER_ROWS:
                hashes = F.broadcast(changed.select(HASH).distinct())
                out.append(whole.join(hashes, HASH, "left_anti"))
                whole = whole.join(hashes, HASH, "left_semi")
            changed = changed.unionByName(whole)
        out.append(_newest_rows(table, changed.drop(HASH)))
    if not out:
        return spark.createDataFrame([], _schema(v))
    return reduce(DataFrame.unionByName, [df.select(*columns) for df in out])


def compact(spark: SparkSession, table: MergeTable, least_share: float = 0.0) -> V.Version | None:
    """Rewrite the buckets whose change rows are at least ``least_share`` of their base rows; others stay as they are.

    Loads that commit meanwhile are kept: their deltas stay in the version.  Another compaction of the same
    buckets raises ``CommitConflict``.
    """
    seen = V.newest(spark, table.base)
    bases, deltas = _parts(seen)
    total = lambda parts, b: sum(own.get(b, 0) for own in parts.values())
    due = sorted(b for b in {b for own in deltas.values() for b in own}
                 if total(deltas, b) >= least_share * max(1, total(bases, b)))
    if not due:
        return seen
    part, counts = _write(table, read(spark, table, due, seen))
    while True:
        last = V.newest(spark, table.base)
        now_bases, now_deltas = _parts(last)
        if any(now_bases.get(p, {}).get(b) != n for p, own in bases.items() for b, n in own.items() if b in due):
            V.delete(spark, f"{table.base.rstrip('/')}/{part}")
            raise V.CommitConflict(f"{table.base}: compacted by another writer")
        without = lambda parts, names: {p: {b: n for b, n in own.items() if p not in names or b not in due}
                                        for p, own in parts.items()}
        entry = _entry(_schema(last), {**without(now_bases, bases), part: counts}, without(now_deltas, deltas), last.entry["watermark"])
        try:
            return V.commit(spark, table.base, entry, last.n)
        except V.CommitConflict:
            continue
