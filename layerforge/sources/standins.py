"""Bronze feeds derived from the driver's TPC-H-like tables.

The warehouse expects six raw CRM/ERP feeds.  The test tables stand in for
them; every stand-in is a full scan (plus joins) of the source tables, so its
size grows with the scale factor.  Dirty values -- NULL ids, blank codes,
bad integer dates, wrong amounts, unmatched keys -- are made by fixed
expressions over the keys, so that the SQL oracle can build identical inputs.

Mapping
-------
crm_cust_info      orders JOIN customer: one customer record per order
                   (several versions per id, the newest must win)
crm_prd_info       part x versions 1..(1 + partkey % 3) (product history)
crm_sales_details  lineitem JOIN orders
erp_cust_az12      customer (demographics, 'NAS' prefix on every third id)
erp_loc_a101       customer JOIN nation (country)
erp_px_cat_g1v2    distinct (type, brand) categories of part
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _m(c: str | Column, n: int) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col % F.lit(n)


def padded(key: Column, width: int) -> Column:
    """Decimal key filled up to ``width`` digits; a longer one keeps all of its digits."""
    text = key.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def customer_number(key: Column) -> Column:
    """Business key of a customer: 'AW' + id of at least 8 digits."""
    return F.concat(F.lit("AW"), padded(key, 8))


def product_number(key: Column) -> Column:
    """Product key without category: 'P' + part key of at least 6 digits."""
    return F.concat(F.lit("P"), padded(key, 6))


def category_id_raw(p_type: Column, p_brand: Column) -> Column:
    """5-character category part of the compound product key, e.g. 'EC-07'."""
    return F.concat(
        F.upper(F.substring(p_type, 1, 2)), F.lit("-"),
        F.lpad(F.split_part(p_brand, F.lit("#"), F.lit(2)), 2, "0"),
    )


def ymd_int(d: Column) -> Column:
    """Date/timestamp -> yyyymmdd integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def bronze_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k = F.col("o_orderkey")
    return j.select(
        F.when(_m(k, 53) == 0, F.lit(None)).otherwise(F.col("o_custkey")).cast("long").alias("cst_id"),
        customer_number(F.col("o_custkey")).alias("cst_key"),
        F.when(_m(k, 41) == 0, F.lit(""))
        .when(_m(k, 43) == 0, F.lit(None))
        .otherwise(F.concat(F.lit("  "), F.split_part("c_name", F.lit("#"), F.lit(1)), F.lit(" ")))
        .alias("cst_firstname"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit("  "))
        .alias("cst_lastname"),
        F.when(_m(k, 5) == 0, F.lit("S")).when(_m(k, 5) == 1, F.lit(" M "))
        .when(_m(k, 5) == 2, F.lit("s")).when(_m(k, 5) == 3, F.lit(""))
        .otherwise(F.lit(None)).cast("string").alias("cst_marital_status"),
        F.when(_m(k, 4) == 0, F.lit("F")).when(_m(k, 4) == 1, F.lit(" m"))
        .when(_m(k, 4) == 2, F.lit(None)).otherwise(F.lit("x")).cast("string").alias("cst_gndr"),
        F.when(_m(k, 29) == 0, F.lit(None)).otherwise(F.col("o_orderdate")).cast("date")
        .alias("cst_create_date"),
    )


def bronze_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    v = p.withColumn("v", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(1) + _m("p_partkey", 3))))
    start = F.date_add(F.lit("2010-01-01").cast("date"),
                       (_m("p_partkey", 400) + (F.col("v") - 1) * 365).cast("int"))
    return v.select(
        (F.col("p_partkey") * 10 + F.col("v")).cast("long").alias("prd_id"),
        F.concat(category_id_raw(F.col("p_type"), F.col("p_brand")), F.lit("-"),
                 product_number(F.col("p_partkey"))).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(_m("p_partkey", 50) == 0, F.lit(None))
        .otherwise(F.floor("p_retailprice") + F.col("v")).cast("int").alias("prd_cost"),
        F.when(_m("p_size", 5) == 0, F.lit("R ")).when(_m("p_size", 5) == 1, F.lit("M "))
        .when(_m("p_size", 5) == 2, F.lit("S ")).when(_m("p_size", 5) == 3, F.lit("T "))
        .otherwise(F.lit("")).alias("prd_line"),
        start.cast("timestamp_ntz").alias("prd_start_dt"),
        F.when(_m("v", 2) == 1, F.date_sub(start, 30).cast("timestamp_ntz"))
        .otherwise(F.lit(None).cast("timestamp_ntz")).alias("prd_end_dt"),
    )


def bronze_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Days, not times, go through the join's shuffle: they compress better.
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.to_date("l_shipdate").alias("l_shipdate"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"))
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    k = F.col("l_orderkey")
    q = (F.when(_m(k, 37) == 0, F.lit(0)).when(_m(k, 43) == 0, F.lit(None))
         .otherwise(F.col("l_quantity")).cast("int"))
    base = (_m("l_partkey", 90) + 1).cast("int")
    p = (F.when(_m(k, 7) == 0, F.lit(None)).when(_m(k, 5) == 0, -base)
         .when(_m(k, 47) == 0, F.lit(0)).otherwise(base).cast("int"))
    staged = j.select("*", q.alias("_q"), p.alias("_p"))
    qq, pp = F.col("_q"), F.col("_p")
    sales = (F.when(_m(k, 6) == 0, F.lit(None)).when(_m(k, 9) == 0, F.lit(0))
             .when(_m(k, 8) == 0, qq * F.abs(pp) + 3).otherwise(qq * F.abs(pp)).cast("int"))
    order_dt = (F.when(_m("o_orderkey", 11) == 0, F.lit(0))
                .when(_m("o_orderkey", 13) == 0, F.lit(2010122))
                .when(_m("o_orderkey", 17) == 0, F.lit(20101399))
                .otherwise(ymd_int(F.col("o_orderdate"))).cast("int"))
    ship_dt = (F.when(_m("l_linenumber", 7) == 0, F.lit(0))
               .when(_m(k, 19) == 0, F.lit(-2010101))
               .otherwise(ymd_int(F.col("l_shipdate"))).cast("int"))
    return staged.select(
        F.concat(F.lit("SO"), k.cast("string")).alias("sls_ord_num"),
        F.when(_m(k + F.col("l_linenumber"), 23) == 0,
               F.concat(F.lit("ZZ"), F.col("l_partkey").cast("string")))
        .otherwise(product_number(F.col("l_partkey"))).alias("sls_prd_key"),
        F.when(_m(k, 31) == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
        .cast("long").alias("sls_cust_id"),
        order_dt.alias("sls_order_dt"),
        ship_dt.alias("sls_ship_dt"),
        F.when(_m(k, 59) == 0, F.lit(0)).when(_m(k, 61) == 0, F.lit(20110231))
        .otherwise(ymd_int(F.date_add("l_shipdate", 30))).cast("int").alias("sls_due_dt"),
        sales.alias("sls_sales"),
        qq.alias("sls_quantity"),
        pp.alias("sls_price"),
    )


def bronze_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    num = customer_number(k)
    return c.select(
        F.when(_m(k, 3) == 0, F.concat(F.lit("NAS"), num)).otherwise(num).alias("cid"),
        F.date_add(F.lit("1940-01-01").cast("date"), _m(k * 37, 25000).cast("int")).alias("bdate"),
        F.when(_m(k, 6) == 0, F.lit("F")).when(_m(k, 6) == 1, F.lit("Female"))
        .when(_m(k, 6) == 2, F.lit(" male")).when(_m(k, 6) == 3, F.lit(""))
        .when(_m(k, 6) == 4, F.lit(None)).otherwise(F.lit("M")).cast("string").alias("gen"),
    )


def bronze_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation is a fixed 25-row reference table: broadcasting it is size-safe.
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
    k = F.col("c_custkey")
    return j.select(
        F.concat(F.lit("AW-"), padded(k, 8)).alias("cid"),
        F.when(_m(k, 7) == 0, F.lit("DE")).when(_m(k, 7) == 1, F.lit("US"))
        .when(_m(k, 7) == 2, F.lit("USA"))
        .when(_m(k, 7) == 3, F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")))
        .when(_m(k, 7) == 4, F.lit("")).when(_m(k, 7) == 5, F.lit(None))
        .otherwise(F.col("n_name")).cast("string").alias("cntry"),
    )


def bronze_px_cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_type", "p_brand")
    brand_no = F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")
    cats = (
        p.where(brand_no % 10 != 0)
        .select(
            F.replace(category_id_raw(F.col("p_type"), F.col("p_brand")), F.lit("-"), F.lit("_")).alias("id"),
            F.col("p_type").alias("cat"),
            F.col("p_brand").alias("subcat"),
            F.when(brand_no % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("maintenance"),
        )
        .distinct()
    )
    return cats


BRONZE_BUILDERS = {
    "crm_cust_info": bronze_cust_info,
    "crm_prd_info": bronze_prd_info,
    "crm_sales_details": bronze_sales_details,
    "erp_cust_az12": bronze_cust_az12,
    "erp_loc_a101": bronze_loc_a101,
    "erp_px_cat_g1v2": bronze_px_cat,
}


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six bronze stand-ins as lazy DataFrames."""
    return {name: fn(spark, sf_dir) for name, fn in BRONZE_BUILDERS.items()}
