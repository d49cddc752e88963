"""Incremental loads with stored state: keep-latest rows with a watermark, and stable surrogate keys.

Both keep their state as versions (``files.publish``): a load that fails leaves the state before it, and
a load that is run again gives the state it gave the first time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.operators.sequence import global_row_number
from layerforge.operators.windows import dedup_latest
from layerforge.sources import files as FS
from layerforge.sources import versions as V
from layerforge.sources.merge_table import same


def watermark(spark: SparkSession, base: str, column: str):
    """Greatest ``column`` loaded so far; None before the first load."""
    if not FS.has_version(spark, base):
        return None
    return FS.read_current(spark, base).agg(F.max(column)).head()[0]


def load_increment(source: DataFrame, base: str, keys: Sequence[str], column: str, overlap_days: int = 0) -> DataFrame:
    """Merge what ``source`` holds from the stored watermark on into the stored newest row per key.

    The watermark's own day is read again, as more of its rows may have come.  Rows without a ``column`` value
    have no place in time and are always read.  ``overlap_days`` reads late rows again; as newest-per-key of a
    union is the newest of the newest, reading rows twice changes nothing.  A load that meets another one's
    commit starts again from the new state.  Returns the new state as stored.  The whole state is written
    each time; ``merge_table`` writes the increment alone.
    """
    spark = source.sparkSession
    while True:
        seen = V.newest(spark, base)
        merged = source
        if seen is not None:
            state = FS.read_version(spark, base, seen)
            last = state.agg(F.max(column)).head()[0]
            if last is not None:
                since = F.date_sub(F.lit(last), overlap_days) if overlap_days else F.lit(last)
                merged = source.where(F.col(column).isNull() | (F.col(column) >= since))
            merged = state.unionByName(merged)
        try:
            FS.publish(dedup_latest(merged, keys, column), base, seen.n if seen else 0)
            return FS.read_current(spark, base)
        except V.CommitConflict:
            continue


def assign_keys(rows: DataFrame, base: str, natural: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """``rows`` with a surrogate key that never changes: known natural keys keep theirs, new ones follow on.

    The map (natural key, surrogate key) is stored at ``base``.  New natural keys are numbered in
    ``order`` after the greatest key given out.  A NULL in a natural key is a value like any other.  Of two
    loads at once the second numbers its keys again, after the first one's.
    """
    spark = rows.sparkSession
    natural = list(natural)
    while True:
        seen = V.newest(spark, base)
        known = FS.read_version(spark, base, seen) if seen else None
        least = [F.min(c).alias(c) for c in order if c not in natural]
        new = rows.groupBy(*natural).agg(*least) if least else rows.select(*natural).distinct()
        first = 0
        if known is not None:
            have = known.select(*natural)
            new = new.join(have, same(new, have, natural), "left_anti")
            first = known.agg(F.max(key)).head()[0] or 0
        numbered = global_row_number(new, [*order, *[n for n in natural if n not in order]], key)
        numbered = numbered.select(*natural, (F.col(key) + F.lit(first)).alias(key))
        try:
            FS.publish(numbered if known is None else known.unionByName(numbered), base, seen.n if seen else 0)
            break
        except V.CommitConflict:
            continue
    given = FS.read_current(spark, base)
    return rows.join(given, same(rows, given, natural)).select(*[rows[c] for c in rows.columns], given[key])
