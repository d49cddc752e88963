"""Gold layer: the star schema (two dimensions and one fact).

Joins are written plainly; AQE picks broadcast for a dimension only when its
runtime size is under ``autoBroadcastJoinThreshold`` and otherwise keeps a
sort-merge join, splitting skewed fact partitions.  Surrogate keys come from
the range-partitioned row number, never from a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.functions import cleanse as C
from layerforge.operators.sequence import global_row_number
from layerforge.operators.windows import current_rows


def dim_customers(cust: DataFrame, demo: DataFrame, loc: DataFrame,
                  num_partitions: int | None = None) -> DataFrame:
    """CRM customers enriched with ERP demographics and location."""
    person = demo.select(F.col("cid").alias("person"), "bdate", "gen")
    place = loc.select(F.col("cid").alias("place"), "cntry")
    joined = (
        cust.join(person, F.col("cst_key") == F.col("person"), "left")
        .join(place, F.col("cst_key") == F.col("place"), "left")
        .select(
            F.col("cst_id").alias("customer_id"),
            F.col("cst_key").alias("customer_number"),
            F.col("cst_firstname").alias("first_name"),
            F.col("cst_lastname").alias("last_name"),
            F.col("cntry").alias("country"),
            F.col("cst_marital_status").alias("marital_status"),
            C.coalesce_sources("cst_gndr", "gen").alias("gender"),
            F.col("bdate").alias("birthdate"),
            F.col("cst_create_date").alias("create_date"),
        )
    )
    # Order of the key: customer id; the remaining columns complete the order
    # when a fan-out (duplicate ERP ids) repeats an id.
    lead = ["customer_id", "customer_number", "country", "gender", "birthdate"]
    order = lead + [c for c in joined.columns if c not in lead]
    keyed = global_row_number(joined, order, "customer_key", num_partitions)
    return keyed.select("customer_key", *[c for c in joined.columns])


def dim_products(prd: DataFrame, cat: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Current product versions enriched with their category."""
    current = current_rows(prd, "prd_end_dt")
    joined = current.join(cat, F.col("cat_id") == F.col("id"), "left").select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )
    # Key order of the source (start date, product number); the remaining
    # columns make the order total even if a category id repeats.
    lead = ["start_date", "product_number", "product_id", "category"]
    order = lead + [c for c in joined.columns if c not in lead]
    keyed = global_row_number(joined, order, "product_key", num_partitions)
    return keyed.select("product_key", *joined.columns)


def fact_sales(sales: DataFrame, dim_prod: DataFrame, dim_cust: DataFrame) -> DataFrame:
    """Sales with the surrogate keys of both dimensions; unmatched -> NULL key."""
    product = dim_prod.select("product_key", "product_number")
    customer = dim_cust.select("customer_key", "customer_id")
    return (
        sales.join(product, F.col("sls_prd_key") == F.col("product_number"), "left")
        .join(customer, F.col("sls_cust_id") == F.col("customer_id"), "left")
        .select(
            F.col("sls_ord_num").alias("order_number"), "product_key", "customer_key",
            F.col("sls_order_dt").alias("order_date"),
            F.col("sls_ship_dt").alias("shipping_date"),
            F.col("sls_due_dt").alias("due_date"),
            F.col("sls_sales").alias("sales_amount"),
            F.col("sls_quantity").alias("quantity"),
            F.col("sls_price").alias("price"),
        )
    )


def build_gold(silver: dict[str, DataFrame], num_partitions: int | None = None) -> dict[str, DataFrame]:
    dc = dim_customers(silver["crm_cust_info"], silver["erp_cust_az12"], silver["erp_loc_a101"],
                       num_partitions)
    dp = dim_products(silver["crm_prd_info"], silver["erp_px_cat_g1v2"], num_partitions)
    fs = fact_sales(silver["crm_sales_details"], dp, dc)
    return {"dim_customers": dc, "dim_products": dp, "fact_sales": fs}
