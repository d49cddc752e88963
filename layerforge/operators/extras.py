"""Operators the warehouse declares in its configuration and documentation.

mask_columns    hash or coarsen sensitive columns
group_stats     per-group mean / standard deviation / quartiles, with outlier counts
profile         per-column nulls, distinct values, min, max, mean in one pass
row_filter      keep rows a principal is entitled to (left semi join)
snapshot_diff   insert / update / delete between two snapshots of a keyed table
reject_rows     rows that fail load rules, with the reasons
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.functions import cleanse as C
from layerforge.operators.sequence import quantiles_in_group
from layerforge.session import write_through

# Fixed value: |z| above this marks an outlier; IQR fences at 1.5 x IQR.
Z_LIMIT = 3.0
IQR_FACTOR = 1.5


def mask_columns(df: DataFrame, hash_cols: Sequence[str] = (), year_cols: Sequence[str] = ()) -> DataFrame:
    """SHA-256 hex of text columns; dates cut to the first day of their year."""
    out = df
    for c in hash_cols:
        out = out.withColumn(c, F.sha2(F.col(c).cast("string"), 256))
    for c in year_cols:
        out = out.withColumn(c, F.trunc(F.col(c), "year"))
    return out


def group_stats(df: DataFrame, group: str, value: str, exact: bool = True,
                accuracy: int = 100_000) -> DataFrame:
    """Per group: n, mean, sample standard deviation, quartiles, outlier counts.

    The rows are read once, into counts per (group, value), which are stored; mean and variance
    (exact integer sums), quartiles and outliers all come from those counts.  Exact quartiles are
    selected by rank over range partitions, so a group may have any number of distinct values;
    ``exact=False`` takes them from a sketch of bounded size per group over the rows instead.
    """
    counts = write_through(df.where(F.col(value).isNotNull()).groupBy(
        F.col(group).alias("_g"), F.col(value).cast("long").alias("_x")).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    x, k = F.col("_x"), F.col("_n").cast("decimal(19,0)")
    stats = counts.groupBy("_g").agg(F.sum("_n").alias("n"), F.sum(k * x).alias("s1"), F.sum(k * x * x).alias("s2"))
    shares = {"q1": 0.25, "q3": 0.75}
    if exact:
        quartiles = quantiles_in_group(counts, "_g", "_x", "_n", shares).withColumnRenamed("_g", "_s")
    else:
        quartiles = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("_s")).agg(
            *[F.percentile_approx(F.col(value).cast("long"), q, accuracy).cast("double").alias(c) for c, q in shares.items()])
    stats = stats.join(quartiles, F.col("_g").eqNullSafe(F.col("_s"))).drop("_s")
    n, s1, s2 = F.col("n").cast("double"), F.col("s1").cast("double"), F.col("s2").cast("double")
    var = F.when(F.col("n") > 1, (s2 - s1 * s1 / n) / (n - F.lit(1.0)))
    stats = stats.select(F.col("_g").alias(group), "n", (s1 / n).alias("mean"), F.sqrt(var).alias("stddev"), "q1", "q3")
    # Null-safe: rows without a group value form their own group.
    z = (x.cast("double") - F.col("mean")) / F.col("stddev")
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - IQR_FACTOR * iqr, F.col("q3") + IQR_FACTOR * iqr
    out = counts.join(stats, F.col("_g").eqNullSafe(F.col(group))).groupBy(group, "n", "mean", "stddev", "q1", "q3").agg(
        F.sum(F.when((F.col("stddev") > 0) & (F.abs(z) > Z_LIMIT), F.col("_n"))).alias("z_outliers"),
        F.sum(F.when((x < low) | (x > high), F.col("_n"))).alias("iqr_outliers"))
    return out.select(
        group, F.col("n").cast("long").alias("n"),
        F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
        F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"),
        F.coalesce("z_outliers", F.lit(0)).cast("long").alias("z_outliers"),
        F.coalesce("iqr_outliers", F.lit(0)).cast("long").alias("iqr_outliers"),
    )


def outlier_rows(df: DataFrame, group: str, value: str, key_cols: Sequence[str]) -> DataFrame:
    """The rows whose |z| in their group exceeds the limit, with the z-score."""
    x = F.col(value).cast("long")
    stats = df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(x).alias("n"), F.sum(x).alias("s1"), F.sum(x.cast("decimal(19,0)") * x).alias("s2"))
    n, s1, s2 = F.col("n").cast("double"), F.col("s1").cast("double"), F.col("s2").cast("double")
    stats = stats.select(group, (s1 / n).alias("mean"),
                         F.sqrt(F.when(F.col("n") > 1, (s2 - s1 * s1 / n) / (n - F.lit(1.0)))).alias("stddev"))
    j = df.join(stats, group)
    z = (F.col(value).cast("double") - F.col("mean")) / F.col("stddev")
    return j.where((F.col("stddev") > 0) & (F.abs(z) > Z_LIMIT)).select(
        *key_cols, group, value, F.round(z, 6).alias("z_score"))


_NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType, T.DecimalType)


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: rows, nulls, distinct values, min, max (as text), mean (numeric).

    Exact distinct counts expand every row once per column.  ``exact=False`` counts them by a
    sketch of fixed size in the one pass over the table.  Exact: two single-pass aggregates over the table: counts, min, max and sums in
    one, the exact distinct counts in the other (mixing both in one aggregate
    makes Spark expand every row once per distinct column *and* carry all the
    other aggregates through each copy).  Each result is unpivoted to one row
    per column and the two are joined on the column name.
    """
    fields = df.schema.fields
    plain = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        plain += [F.count(c).alias(f"_nn{i}"), F.min(c).cast("string").alias(f"_mn{i}"),
                  F.max(c).cast("string").alias(f"_mx{i}")]
        if not exact:
            plain.append(F.approx_count_distinct(c, 0.02).alias(f"_nd{i}"))
        if isinstance(f.dataType, _NUMERIC):
            plain.append(F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double")).alias(f"_avg{i}"))
        else:
            plain.append(F.lit(None).cast("double").alias(f"_avg{i}"))
    a = df.agg(*plain).select(F.col("_rows").cast("long").alias("row_count"), F.explode(F.array(*[F.struct(
        F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
        F.col(f"_nn{i}").cast("long").alias("non_null"), F.col(f"_mn{i}").alias("min_value"),
        F.col(f"_mx{i}").alias("max_value"), F.col(f"_avg{i}").alias("mean"),
        (F.lit(None) if exact else F.col(f"_nd{i}")).cast("long").alias("distinct_values")) for i, f in enumerate(fields)]))
        .alias("_p")).select("row_count", "_p.*")
    if not exact:
        return _profile_columns(a)
    d = df.agg(*[F.countDistinct(F.col(f.name)).alias(f"_nd{i}") for i, f in enumerate(fields)]).select(
        F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                                     F.col(f"_nd{i}").cast("long").alias("distinct_values"))
                            for i, f in enumerate(fields)])).alias("_d")).select("_d.*")
    return _profile_columns(a.drop("distinct_values").join(d, "column_name"))


def _profile_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "column_name", "data_type", "row_count", (F.col("row_count") - F.col("non_null")).alias("null_count"),
        "distinct_values", "min_value", "max_value", F.round("mean", 6).alias("mean"))


def row_filter(df: DataFrame, entitlements: DataFrame, principal: str, on: str,
               principal_col: str = "principal") -> DataFrame:
    """Rows whose ``on`` value the principal is granted (semi join: no row duplication)."""
    grants = entitlements.where(F.col(principal_col) == principal).select(F.col(on))
    return df.join(grants, on, "left_semi")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows between two snapshots: INSERT, UPDATE or DELETE per key (full outer join).

    Rows are compared as whole structs with null-safe equality, so a change
    from or to NULL counts; a NULL in a key is a value like any other.
    """
    keys = list(keys)
    vals = [c for c in new.columns if c not in keys]
    o = old.select(F.struct(*keys).alias("_ok"), F.struct(*vals).alias("_old"))
    n = new.select(F.struct(*keys).alias("_nk"), F.struct(*vals).alias("_new"))
    j = o.join(n, reduce(Column.__and__, [F.col(f"_ok.{k}").eqNullSafe(F.col(f"_nk.{k}")) for k in keys]), "full_outer")
    change = (F.when(F.col("_ok").isNull(), F.lit("INSERT"))
              .when(F.col("_nk").isNull(), F.lit("DELETE"))
              .when(~F.col("_old").eqNullSafe(F.col("_new")), F.lit("UPDATE")))
    out = j.withColumn("change_type", change).where(F.col("change_type").isNotNull())
    # Values of the new snapshot; a deleted row shows its last known values.
    pick = lambda a, b, c: F.when(F.col("_nk").isNotNull(), F.col(f"{b}.{c}")).otherwise(F.col(f"{a}.{c}")).alias(c)
    return out.select(*[pick("_ok", "_nk", k) for k in keys], "change_type", *[pick("_old", "_new", v) for v in vals])


def reject_reasons(reasons: Sequence[tuple[str, Column]]) -> Column:
    """';'-joined labels of the reasons that hold (NULL conditions do not count)."""
    return F.concat_ws(";", *[F.when(cond, F.lit(label)) for label, cond in reasons])


def sales_reject_reason() -> Column:
    """Why a bronze sales row cannot load cleanly, all reasons that apply, or the empty text.

    All three dates, the quantity, and what the amounts would load as.
    """
    reasons = []
    for day in ("order", "ship", "due"):
        c = F.col(f"sls_{day}_dt")
        absent = (c == 0) | (F.length(c.cast("string")) != 8)
        reasons += [(f"{day}_date_invalid", C.int_date_rejected(c)), (f"{day}_date_missing", F.coalesce(absent, F.lit(True)))]
    new_sales, new_price = C.repair_amounts("sls_sales", "sls_quantity", "sls_price")
    reasons += [
        ("quantity_not_positive", F.coalesce(F.col("sls_quantity") <= 0, F.lit(True))),
        ("price_unrepairable", new_price.isNull()),
        ("price_not_positive", new_price <= 0),
        ("sales_unrepairable", new_sales.isNull()),
        # Never holds.  The optimizer repeats no expression with a task's number in a filter below: twice all
        # the conditions make a generated method that is too large to be compiled (6 s against 1.6 s).
        ("", F.spark_partition_id() < 0),
    ]
    return reject_reasons(reasons)


def reject_rows(sales: DataFrame) -> DataFrame:
    """Bronze sales rows that cannot load cleanly, with every reason that applies.

    The reasons are written once, in one projection, and the filter reads their text.
    """
    return sales.withColumn("reject_reason", sales_reject_reason()).where(F.col("reject_reason") != "")
