"""Order-dependent operators that stay balanced under skew.

Spark offers two plain ways to number or neighbour rows in a total order:
a window without ``partitionBy`` (all rows in one task) or a window
partitioned by a business key (a hot key lands in one task).  Neither holds
at scale.  This module range-partitions on the *complete* sort order instead:
even a key that holds a third of the rows is cut over many partitions,
because the trailing order columns split it.

``ranged`` returns the rows range-partitioned and sorted, tagged with the
partition index ``_pid`` and the position ``_pos`` inside the partition, and
writes them as Parquet below the shared checkpoint folder.  That fixes the
partition bounds, so everything derived from it (partition counts, first
rows) agrees with the rows, also when tasks are retried.

Derived operators
-----------------
global_row_number  ROW_NUMBER() OVER (ORDER BY ...) without a single-task window
lead_in_group      LEAD(v) OVER (PARTITION BY k ORDER BY ...) without a per-key task
quantiles_in_group exact interpolated quantiles per group by rank selection, without a buffer per group
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.session import write_through

PID, POS = "_pid", "_pos"


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def ranged(df: DataFrame, order: Sequence[str | Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partition + sort on ``order`` (NULLs first), tag ``_pid``/``_pos``, store.

    ``order`` must be a total order over the rows (append a unique column as a
    tie-break), otherwise equal rows may swap places between recomputations.
    """
    cols = _order_cols(order)
    shift = F.lit(1 << 33)
    # Without an explicit count AQE may coalesce neighbouring ranges; merged
    # ranges are still contiguous, so partition index order stays sort order.
    parted = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    staged = (
        parted
        .sortWithinPartitions(*cols)
        .withColumn(PID, F.spark_partition_id())
        # monotonically_increasing_id = (partition index << 33) + row index in partition
        .withColumn(POS, F.monotonically_increasing_id() - F.col(PID).cast("long") * shift)
    )
    # Written once; later reads take only the columns they need, with file statistics.
    return write_through(staged, "sequence")


def partition_offsets(seq: DataFrame) -> DataFrame:
    """(_pid, _offset): number of rows in all earlier partitions.

    One row per partition, so the table is bounded by the partition count and
    safe to broadcast; the running sum runs over these few rows only.
    """
    counts = seq.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(PID, F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long").alias("_offset"))


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str,
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..n in ``order`` (NULLs first), equal to a global ROW_NUMBER."""
    seq = ranged(df, order, num_partitions)
    offsets = partition_offsets(seq)
    out = seq.join(F.broadcast(offsets), PID, "inner")
    return out.withColumn(name, (F.col("_offset") + F.col(POS) + 1).cast("long")).drop(PID, POS, "_offset")


def lead_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str,
                  name: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = ``value`` of the next row of the same ``keys`` group in ``order`` (of the previous one if it descends).

    The rows are range-partitioned on (keys, order); inside a partition the
    next row is found by a window over that partition (bounded size); the
    next row of a partition's last row is the first row of the next non-empty
    partition, taken from a table with one row per partition.
    """
    seq = ranged(df, [*keys, *order], num_partitions)
    w = Window.partitionBy(PID).orderBy(POS)
    nxt = F.struct(*[F.lead(F.col(k)).over(w).alias(k) for k in keys],
                   F.lead(F.col(value)).over(w).alias("_v"))
    with_next = seq.withColumn("_next", nxt).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())

    firsts = (
        seq.where(F.col(POS) == 0)
        .select(PID, F.struct(*[F.col(k) for k in keys], F.col(value).alias("_v")).alias("_first"))
    )
    wp = Window.orderBy(PID)
    boundary = firsts.select(PID, F.lead("_first").over(wp).alias("_after"))

    joined = with_next.join(F.broadcast(boundary), PID, "left")
    cand = F.when(F.col("_last"), F.col("_after")).otherwise(F.col("_next"))
    same = None
    for k in keys:
        eq = cand[k].eqNullSafe(F.col(k))
        same = eq if same is None else same & eq
    out = joined.withColumn(name, F.when(cand.isNotNull() & same, cand["_v"]))
    return out.drop(PID, POS, "_next", "_last", "_after")


def quantiles_in_group(counts: DataFrame, group: str, value: str, n: str, shares: Mapping[str, float],
                       num_partitions: int | None = None) -> DataFrame:
    """(group, one column per share): exact interpolated quantiles of ``value`` that occurs ``n`` times per row.

    ``counts`` has one row per (group, value).  The values are range-partitioned by (group, value); the ranks before
    a row are the counts before it in its partition and those of its group in earlier partitions, a table with a row
    per group and partition it lies in.  The two values around each quantile's rank are picked by that rank, so a
    group may have any number of distinct values: no task and no buffer holds it whole.
    """
    seq = ranged(counts.select(F.col(group).alias("_g"), F.col(value).alias("_x"), F.col(n).alias("_n")), ["_g", "_x"], num_partitions)
    pieces = seq.groupBy("_g", PID).agg(F.sum("_n").alias("_here"))
    earlier = Window.partitionBy("_g").orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_g")
    pieces = pieces.select(F.col("_g").alias("_pg"), F.col(PID).alias("_pp"),
                           F.coalesce(F.sum("_here").over(earlier), F.lit(0)).alias("_before"), F.sum("_here").over(whole).alias("_all"))
    inside = Window.partitionBy(PID, "_g").orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (seq.withColumn("_skip", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
             .join(pieces, (F.col(PID) == F.col("_pp")) & F.col("_g").eqNullSafe(F.col("_pg")))
             .withColumn("_first", F.col("_before") + F.col("_skip")))
    low, high = F.col("_first"), F.col("_first") + F.col("_n")
    at = {name: (F.col("_all") - 1).cast("double") * F.lit(q) for name, q in shares.items()}
    holds = lambda rank: (rank >= low) & (rank < high)
    picked = ranks.where(reduce(Column.__or__, [holds(F.floor(p)) | holds(F.ceil(p)) for p in at.values()]))
    aggs = []
    for i, p in enumerate(at.values()):
        aggs += [F.max(F.when(holds(F.floor(p)), F.col("_x"))).cast("double").alias(f"_lo{i}"),
                 F.max(F.when(holds(F.ceil(p)), F.col("_x"))).cast("double").alias(f"_hi{i}"), F.max(p).alias(f"_at{i}")]
    ends = picked.groupBy("_g").agg(*aggs)
    return ends.select(F.col("_g").alias(group), *[
        F.when(F.floor(f"_at{i}") == F.ceil(f"_at{i}"), F.col(f"_lo{i}")).otherwise(
            (F.ceil(f"_at{i}") - F.col(f"_at{i}")) * F.col(f"_lo{i}") + (F.col(f"_at{i}") - F.floor(f"_at{i}")) * F.col(f"_hi{i}")).alias(name)
        for i, name in enumerate(shares)])
