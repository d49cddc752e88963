"""Slowly changing dimensions kept up to date by batches: a batch closes, opens and splits stored intervals.

The history is a merge-on-read table with one row per version of a key, with the end of its interval (the day
before the next version starts; NULL: still open).  A batch may hold versions of any age.  Only the histories of
its own keys are read, ends are found by a range-partitioned lead over those alone, and only rows that are new or
whose end changed are written.  Ends depend on what was stored, so a batch that meets another commit starts again.

Versions of one key, start and tie-break are one version; of differing contents the greatest stays, so batches
may come in any order and more than once, and always give the intervals of a full rebuild (``scd2_intervals``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.operators.sequence import lead_in_group
from layerforge.session import write_through
from layerforge.sources import merge_table as M
from layerforge.sources import versions as V

SEQ, NEXT = "_seq", "_next_start"


@dataclass(frozen=True)
class IntervalTable:
    base: str
    keys: tuple[str, ...]
    start: str
    end: str
    tie_break: tuple[str, ...] = ()
    buckets: int = 64

    @property
    def version_key(self) -> tuple[str, ...]:
        return (*self.keys, self.start, *self.tie_break)

    @property
    def store(self) -> M.MergeTable:
        """Rows of a version replace those written before it."""
        return M.MergeTable(self.base, self.version_key, SEQ, self.buckets, self.keys)


def _one_each(table: IntervalTable, rows: DataFrame) -> DataFrame:
    rest = [c for c in rows.columns if c not in table.version_key]
    if not rest:
        return rows.distinct()
    best = rows.groupBy(*table.version_key).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in table.version_key else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def merge_versions(spark: SparkSession, table: IntervalTable, batch: DataFrame) -> V.Version | None:
    """Put a batch of versions (all columns but the end) into the history."""
    columns = batch.columns
    batch = write_through(_one_each(table, batch), "interval-batch")
    touched = [r[0] for r in batch.select(M.bucket_of(table.store)).distinct().collect()]  # at most the buckets
    while True:
        last = V.newest(spark, table.base)
        versions, near = batch, None
        if last is not None:
            asked = batch.select(*table.keys).distinct()
            stored = M.read(spark, table.store, touched, last)
            near = write_through(stored.join(asked, M.same(stored, asked, table.keys), "left_semi").select(*columns, table.end), "intervals-near")
            versions = _one_each(table, near.select(*columns).unionByName(batch))
        ends = lead_in_group(versions, table.keys, [table.start, *table.tie_break], table.start, NEXT).withColumn(
            table.end, F.date_sub(F.to_date(F.col(NEXT)), 1)).select(*columns, table.end)
        if near is not None:
            ends = ends.join(near, M.same(ends, near, ends.columns), "left_anti")
        try:
            return M.load(spark, table.store, ends.withColumn(SEQ, F.lit(last.n + 1 if last else 1).cast("long")), last.n if last else 0)
        except V.CommitConflict:
            continue


def read_intervals(spark: SparkSession, table: IntervalTable) -> DataFrame:
    """All versions with their intervals."""
    return M.read(spark, table.store).drop(SEQ)
