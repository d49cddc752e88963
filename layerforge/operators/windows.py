"""Keep-latest deduplication and SCD-2 validity intervals.

``dedup_latest`` is written as a grouped ``max`` over a struct whose leading
fields are the ordering.  The aggregate runs in two phases -- a partial
aggregate in every map task before the shuffle, a final one after -- so a key
that holds a third of all rows is reduced to one row per map task before it
moves, instead of being collected into a single window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.operators.sequence import PID, POS, lead_in_group, ranged


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: str,
                 tie_break: Sequence[str] | None = None, drop_null_keys: bool = True) -> DataFrame:
    """One row per ``keys``: the greatest ``order_by`` (NULLs last), then ``tie_break`` desc.

    Equivalent to ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_by DESC
    NULLS LAST, tie_break DESC NULLS LAST) = 1``.  ``tie_break`` defaults to
    all remaining columns, which makes the choice deterministic; rows equal
    in every column are interchangeable.
    """
    keys = list(keys)
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    others = [c for c in df.columns if c not in keys]
    ties = list(tie_break) if tie_break is not None else [c for c in others if c != order_by]
    payload = [c for c in others if c != order_by and c not in ties]
    # Struct order = comparison order. NULL fields compare lowest, so max()
    # prefers a non-NULL date: DESC NULLS LAST.
    best = F.max(F.struct(
        F.col(order_by).alias("_o0"),
        *[F.col(c).alias(f"_t{i}") for i, c in enumerate(ties)],
        *[F.col(c).alias(f"_p{i}") for i, c in enumerate(payload)],
    )).alias("_best")
    agg = df.groupBy(*keys).agg(best)
    sel = [F.col(k) for k in keys]
    sel.append(F.col("_best._o0").alias(order_by))
    sel += [F.col(f"_best._t{i}").alias(c) for i, c in enumerate(ties)]
    sel += [F.col(f"_best._p{i}").alias(c) for i, c in enumerate(payload)]
    return agg.select(*sel).select(*df.columns)


def scd2_intervals(df: DataFrame, keys: Sequence[str], start: str, end_name: str,
                   tie_break: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Validity interval per version: ``end = next start of the same key - 1 day``.

    The newest version per key gets a NULL (open) end.  Supplied end dates are
    ignored.  The next start is found with a range-partitioned lead, so a key
    with a very long history does not pin one task.
    """
    nxt = "_next_start"
    with_next = lead_in_group(df, keys, [start, *tie_break], start, nxt, num_partitions)
    end = F.date_sub(F.to_date(F.col(nxt)), 1)
    return with_next.withColumn(end_name, end).drop(nxt)


def current_rows(df: DataFrame, end_col: str) -> DataFrame:
    """Rows whose validity interval is still open (``end IS NULL``)."""
    return df.where(F.col(end_col).isNull())


def asof_join(facts: DataFrame, versions: DataFrame, fact_key: str, version_key: str,
              fact_date: str, start: str, end: str, num_partitions: int | None = None) -> DataFrame:
    """Point-in-time left join: each fact gets the version whose [start, end] holds its date.

    For SCD-2 versions (non-overlapping non-empty intervals, an open end
    reaching to the end of time) this is exact.  Instead of an equi-join on the key with a
    range post-filter -- which compares every fact of a key with every
    version of that key -- facts and version starts are merged into one
    sequence ordered by (key, date, versions first) and range-partitioned on
    that full order, so a hot key is spread over many tasks.  Each fact takes
    the last version before it: inside a partition by a running ``last``,
    across a partition edge from a table with one row per partition.
    The version's interval must still hold the date, else the fact gets NULLs.
    """
    fcols, vcols = facts.columns, versions.columns
    f_t = facts.select(F.struct(*fcols).alias("s")).schema["s"].dataType
    v_t = versions.select(F.struct(*vcols).alias("s")).schema["s"].dataType
    f = facts.select(F.col(fact_key).alias("_k"), F.to_date(F.col(fact_date)).alias("_d"), F.lit(1).alias("_tag"),
                     F.lit(None).cast(v_t).alias("_v"), F.struct(*fcols).alias("_f"))
    # A version whose interval is empty (end before start) holds no date; without
    # them at most one version starts per (key, date), so the order among rows
    # of equal (key, date, tag) does not change the result and a 64-bit hash
    # serves as the tie-break (a cheap primitive sort key, not whole structs).
    # A version without a start holds no date either.
    live = versions.where(F.col(start).isNotNull()).where(F.col(end).isNull() | (F.to_date(F.col(end)) >= F.to_date(F.col(start))))
    v = live.select(F.col(version_key).alias("_k"), F.to_date(F.col(start)).alias("_d"), F.lit(0).alias("_tag"),
                    F.struct(*vcols).alias("_v"), F.lit(None).cast(f_t).alias("_f"))
    u = f.unionByName(v).withColumn("_h", F.xxhash64("_v", "_f"))
    seq = ranged(u, ["_k", "_d", "_tag", "_h"], num_partitions)

    mark = F.when(F.col("_tag") == 0, F.struct(F.col("_k").alias("k"), F.col("_v").alias("v")))
    run = Window.partitionBy(PID).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = seq.withColumn("_in", F.last(mark, ignorenulls=True).over(run))

    # Last version row of every partition, then for each partition the last one before it.
    pids = seq.select(PID).distinct()
    last_v = (seq.where(F.col("_tag") == 0).groupBy(PID)
              .agg(F.max_by(F.struct(F.col("_k").alias("k"), F.col("_v").alias("v")), F.col(POS)).alias("_lv")))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = pids.join(last_v, PID, "left").select(PID, F.last("_lv", ignorenulls=True).over(before).alias("_carry"))

    facts_seq = inside.where(F.col("_tag") == 1).join(F.broadcast(carry), PID, "left")
    cand = F.when(F.col("_in").isNotNull(), F.col("_in")).otherwise(F.col("_carry"))
    hit = (cand.isNotNull() & (cand["k"] == F.col("_k"))
           & (F.col("_d") <= F.coalesce(cand["v"][end].cast("date"), F.lit("9999-12-31").cast("date"))))
    return facts_seq.select(
        *[F.col("_f")[c].alias(c) for c in fcols],
        *[F.when(hit, cand["v"][c]).alias(c) for c in vcols],
    )


def desc_nulls_last(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]
