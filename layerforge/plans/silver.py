"""Silver layer: one cleansing function per bronze table.

Each function takes the bronze DataFrame and returns the silver DataFrame
(without ``dwh_create_date``; ``stamp`` adds it at write time so that query
results stay free of wall-clock values).  All rules are built-in column
expressions evaluated in a single projection per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.functions import cleanse as C
from layerforge.operators.windows import dedup_latest, scd2_intervals


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Drop NULL ids, keep the newest record per id, trim names, map codes."""
    latest = dedup_latest(bronze, ["cst_id"], "cst_create_date")
    return latest.select(
        "cst_id",
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        C.map_codes("cst_marital_status", C.MARITAL_CODES).alias("cst_marital_status"),
        C.map_codes("cst_gndr", C.GENDER_CODES).alias("cst_gndr"),
        "cst_create_date",
    )


def silver_products(bronze: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Split the compound key, fill cost, map line, recompute validity ends.

    The interval is computed over the *raw* compound key (before splitting),
    ordered by start date with ``prd_id`` as tie-break.
    """
    cat_id, prd_key = C.split_key("prd_key")
    with_end = scd2_intervals(
        bronze.select("prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt"),
        ["prd_key"], "prd_start_dt", "prd_end_dt", tie_break=["prd_id"],
        num_partitions=num_partitions,
    )
    return with_end.select(
        "prd_id",
        cat_id.alias("cat_id"),
        prd_key.alias("prd_key"),
        "prd_nm",
        C.fill_nulls("prd_cost", 0).cast("int").alias("prd_cost"),
        C.map_codes("prd_line", C.PRODUCT_LINE_CODES).alias("prd_line"),
        F.to_date("prd_start_dt").alias("prd_start_dt"),
        F.col("prd_end_dt").cast("date").alias("prd_end_dt"),
    )


def silver_sales(bronze: DataFrame) -> DataFrame:
    """Parse the three integer dates and repair sales and price in one projection."""
    sales, price = C.repair_amounts("sls_sales", "sls_quantity", "sls_price")
    return bronze.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cust_id",
        C.parse_int_date("sls_order_dt").alias("sls_order_dt"),
        C.parse_int_date("sls_ship_dt").alias("sls_ship_dt"),
        C.parse_int_date("sls_due_dt").alias("sls_due_dt"),
        sales.alias("sls_sales"),
        "sls_quantity",
        price.alias("sls_price"),
    )


def silver_demographics(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """Strip the 'NAS' prefix, NULL birth dates after ``as_of`` (default: today), map gender words."""
    return bronze.select(
        C.strip_prefix("cid").alias("cid"),
        C.null_future_dates("bdate", as_of).alias("bdate"),
        C.map_code_lists("gen", C.GENDER_WORDS).alias("gen"),
    )


def silver_locations(bronze: DataFrame) -> DataFrame:
    """Remove '-' from the id, map country codes."""
    return bronze.select(C.normalize_id("cid").alias("cid"), C.map_country("cntry").alias("cntry"))


def passthrough(bronze: DataFrame) -> DataFrame:
    """Categories are copied as they are."""
    return bronze.select("id", "cat", "subcat", "maintenance")


def stamp(df: DataFrame, run_ts=None) -> DataFrame:
    """Add ``dwh_create_date``: the run timestamp (fixed per run), or now."""
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return df.withColumn("dwh_create_date", ts)


def build_silver(bronze: dict[str, DataFrame], as_of: str | None = None,
                 num_partitions: int | None = None) -> dict[str, DataFrame]:
    return {
        "crm_cust_info": silver_customers(bronze["crm_cust_info"]),
        "crm_prd_info": silver_products(bronze["crm_prd_info"], num_partitions),
        "crm_sales_details": silver_sales(bronze["crm_sales_details"]),
        "erp_cust_az12": silver_demographics(bronze["erp_cust_az12"], as_of),
        "erp_loc_a101": silver_locations(bronze["erp_loc_a101"]),
        "erp_px_cat_g1v2": passthrough(bronze["erp_px_cat_g1v2"]),
    }
