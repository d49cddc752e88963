"""Business queries over the gold star schema.

Plans aggregate the fact table *before* joining a dimension wherever the
query allows it: the fact is reduced to one row per dimension key with a
two-phase (map-side partial) aggregate, so a customer or product that owns a
third of all sales is combined in every map task before the shuffle, and the
join that follows is one-to-one (only ``flat_sales`` joins sale by sale).  Small aggregated results come in report
order (a range-partitioned sort of a few rows); the fact-sized ``flat_sales``
is left unsorted -- a global sort of every sale serves no reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _mean(sum_col: Column, n_col: Column) -> Column:
    """Mean as exact integer sum / count, both engines give the same double."""
    return F.try_divide(sum_col.cast("double"), n_col.cast("double"))


def customer_name(first: str = "first_name", last: str = "last_name") -> Column:
    """``first + ' ' + last``; NULL when either part is NULL (not concat_ws)."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def spread_nulls(key: str, *by: str, ways: int = 1 << 20) -> Column:
    """A join key whose NULLs are spread over negative values, which no surrogate key has.

    In a shuffled join all NULL keys of the kept side would meet in one task.
    """
    return F.coalesce(F.col(key), -1 - F.pmod(F.xxhash64(*by), F.lit(ways)))


_SALE, _CUSTOMER, _PRODUCT = (("order_date", "sales_amount", "quantity", "price"), ("customer_name", "country", "gender", "marital_status"),
                              ("product_name", "category", "subcategory", "product_line"))


def flat_sales(fact: DataFrame, dim_cust: DataFrame, dim_prod: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Denormalised sales rows with a known order date; with ``columns`` those alone.

    A dimension's key is unique, so a left join with one of which no column is asked for gives each sale once and
    nothing else: it is left out.
    """
    by = ("order_number", "customer_key", "product_key", "order_date", "sales_amount")
    sales = fact.where(F.col("order_date").isNotNull()).select(
        "order_date", "sales_amount", "quantity", "price",
        spread_nulls("customer_key", *by).alias("_c"), spread_nulls("product_key", *by).alias("_p"))
    customer = dim_cust.select(F.col("customer_key").alias("_c"), customer_name().alias("customer_name"),
                               "country", "gender", "marital_status")
    product = dim_prod.select(F.col("product_key").alias("_p"), "product_name", "category", "subcategory", "product_line")
    wanted = list(columns or _SALE + _CUSTOMER + _PRODUCT)
    for dim, key, own in ((customer, "_c", _CUSTOMER), (product, "_p", _PRODUCT)):
        if set(wanted) & set(own):
            sales = sales.join(dim, key, "left")
    return sales.select(*wanted)


def _fact_by(fact: DataFrame, key: str) -> DataFrame:
    """One row per dimension key: rows, non-NULL sales, sales sum, quantity sum."""
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("sales_amount").alias("_n_sales"),
        F.sum("sales_amount").alias("_sum_sales"),
        F.sum("quantity").alias("_sum_qty"),
        F.count("order_number").alias("_n_orders"),
    )


def _customer_rows(dim_cust: DataFrame, fact: DataFrame) -> DataFrame:
    """dim_customers LEFT JOIN fact, pre-aggregated: a customer without sales counts 1."""
    per = _fact_by(fact.where(F.col("customer_key").isNotNull()), "customer_key")
    return dim_cust.select("customer_key", "country", "gender", "marital_status").join(
        per, "customer_key", "left")


def customer_summary(dim_cust: DataFrame, fact: DataFrame) -> DataFrame:
    """Customers and mean sale per (country, gender, marital status)."""
    rows = _customer_rows(dim_cust, fact)
    return rows.groupBy("country", "gender", "marital_status").agg(
        F.sum(F.coalesce(F.col("_rows"), F.lit(1))).cast("long").alias("customer_count"),
        _mean(F.sum("_sum_sales"), F.sum("_n_sales")).alias("avg_sales"),
    ).orderBy(F.col("customer_count").desc())


def demographics_rollup(dim_cust: DataFrame, fact: DataFrame) -> DataFrame:
    """Hierarchical totals country -> gender -> marital status (sunburst levels).

    ``level`` is the grouping id, so a real NULL country stays apart from a
    subtotal row.
    """
    rows = _customer_rows(dim_cust, fact)
    return rows.rollup("country", "gender", "marital_status").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum(F.coalesce(F.col("_rows"), F.lit(1))).cast("long").alias("customer_count"),
    )


def product_performance(fact: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Orders, sales, quantity and mean sale per product attributes."""
    per = _fact_by(fact, "product_key")
    p = dim_prod.select("product_key", "product_name", "category", "subcategory", "product_line")
    # fact LEFT JOIN dim: unmatched (NULL) product keys form the NULL group.
    rows = per.join(p, per.product_key.eqNullSafe(p.product_key), "left")
    return rows.groupBy("product_name", "category", "subcategory", "product_line").agg(
        F.sum("_rows").cast("long").alias("order_count"),
        F.sum("_sum_sales").cast("long").alias("total_sales"),
        F.sum("_sum_qty").cast("long").alias("total_quantity"),
        _mean(F.sum("_sum_sales"), F.sum("_n_sales")).alias("avg_order_value"),
    )


def product_performance_sorted(fact: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Product performance in report order (highest sales first)."""
    return product_performance(fact, dim_prod).orderBy(F.col("total_sales").desc_nulls_last())


def top_products(fact: DataFrame, dim_prod: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows of product performance by total sales (NULLs last)."""
    perf = product_performance(fact, dim_prod)
    return perf.orderBy(
        F.col("total_sales").desc_nulls_last(), F.col("product_name").asc_nulls_first(),
        F.col("category").asc_nulls_first(), F.col("subcategory").asc_nulls_first(),
        F.col("product_line").asc_nulls_first(),
    ).limit(n)


def category_performance(fact: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Product performance re-aggregated by category; the NULL category is dropped."""
    perf = product_performance(fact, dim_prod)
    return perf.where(F.col("category").isNotNull()).groupBy("category").agg(
        F.sum("total_sales").cast("long").alias("total_sales"),
        F.sum("total_quantity").cast("long").alias("total_quantity"),
        F.sum("order_count").cast("long").alias("order_count"),
    )


def top_customers(fact: DataFrame, dim_cust: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` customers by total sales (inner join; ties by customer key)."""
    per = fact.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(
        F.sum("sales_amount").alias("total_sales"),
        F.count("order_number").alias("order_count"),
    )
    c = dim_cust.select("customer_key", "first_name", "last_name", "country")
    joined = per.join(c, "customer_key", "inner")
    return (
        joined.orderBy(F.col("total_sales").desc_nulls_last(), F.col("customer_key").asc())
        .limit(n)
        .select(
            customer_name().alias("customer_name"),
            "country",
            F.col("total_sales").cast("long").alias("total_sales"),
            F.col("order_count").cast("long").alias("order_count"),
        )
    )


def monthly_trend(fact: DataFrame) -> DataFrame:
    """Sales and distinct customers per (year, month); NULL dates form one group."""
    return fact.groupBy(
        F.year("order_date").cast("int").alias("sales_year"),
        F.month("order_date").cast("int").alias("sales_month"),
    ).agg(
        F.sum("sales_amount").cast("long").alias("monthly_sales"),
        F.countDistinct("customer_key").cast("long").alias("unique_customers"),
    ).orderBy(F.col("sales_year").asc_nulls_first(), F.col("sales_month").asc_nulls_first())


def kpi_summary(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Headline numbers of dated sales: total, rows, distinct customer names, mean sale.

    The fact is reduced to one row per customer key before the one join.
    """
    per = _fact_by(fact.where(F.col("order_date").isNotNull()), "customer_key")
    named = per.join(dim_cust.select("customer_key", customer_name().alias("customer_name")), "customer_key", "left")
    return named.agg(
        F.coalesce(F.sum("_sum_sales"), F.lit(0)).cast("long").alias("total_sales"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("total_orders"),
        F.countDistinct("customer_name").cast("long").alias("total_customers"),
        _mean(F.sum("_sum_sales"), F.sum("_n_sales")).alias("avg_order"),
    )


def daily_sales(fact: DataFrame) -> DataFrame:
    """Sales per order day, from the fact alone (a day whose sales are all NULL sums to 0)."""
    dated = fact.where(F.col("order_date").isNotNull())
    return dated.groupBy(F.to_date("order_date").alias("order_date")).agg(
        F.coalesce(F.sum("sales_amount"), F.lit(0)).cast("long").alias("sales_amount")).orderBy("order_date")


def country_sales(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Dated sales per country: summed per customer key, then one join."""
    per = _fact_by(fact.where(F.col("order_date").isNotNull() & F.col("customer_key").isNotNull()), "customer_key")
    known = dim_cust.where(F.col("country").isNotNull()).select("customer_key", "country")
    return per.join(known, "customer_key").groupBy("country").agg(
        F.coalesce(F.sum("_sum_sales"), F.lit(0)).cast("long").alias("sales_amount"))


def sales_by_country(fact: DataFrame, dim_cust: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` countries with the highest sales (ties by name)."""
    return country_sales(fact, dim_cust).orderBy(F.col("sales_amount").desc(), F.col("country").asc()).limit(n)


def country_share(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Every country with its sales and its share of all country sales.

    The total is a one-row aggregate of the (small) per-country frame; a
    window without partition over that frame is bounded by the number of
    countries.
    """
    per = country_sales(fact, dim_cust)
    total = F.sum("sales_amount").over(Window.partitionBy())
    return per.select("country", "sales_amount",
                      F.try_divide(F.col("sales_amount").cast("double"), total.cast("double")).alias("share"))


#: Size of the stored sketches: relative standard error about 1.04 / sqrt(2^12) = 1.6 %; three of them are the bound.
SKETCH_BITS = 12
DISTINCT_BOUND = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def daily_customer_sketches(fact: DataFrame) -> DataFrame:
    """(order_date, orders, total_sales, customers): per day, with a mergeable sketch of its customers.

    Stored once a day, it answers distinct customers of any set of days without the fact; a distinct count does not
    add up, its sketch does.
    """
    return fact.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("sales_amount").cast("long")).alias("total_sales"),
        F.hll_sketch_agg(F.col("customer_key"), SKETCH_BITS).alias("customers"))


def distinct_from_sketches(sketches: DataFrame, *by: Column) -> DataFrame:
    """Orders, sales and distinct customers per group of days, from their stored sketches; estimate within ``DISTINCT_BOUND``."""
    return sketches.groupBy(*by).agg(
        F.sum("orders").alias("orders"), F.sum("total_sales").alias("total_sales"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("distinct_customers"))
