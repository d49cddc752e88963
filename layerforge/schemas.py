"""Declared schemas of the three layers and of the operational tables.

Bronze is typed at load (no inference).  Silver adds ``dwh_create_date`` and
turns the integer / datetime dates into dates.  Gold surrogate keys are
``bigint`` (a row number can exceed the int range on a large table), and so
are all ids of the feeds.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
DBL, B = T.DoubleType(), T.BooleanType()
TS, TSN = T.TimestampType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BRONZE = {
    "crm_cust_info": _struct(
        ("cst_id", L), ("cst_key", S), ("cst_firstname", S), ("cst_lastname", S),
        ("cst_marital_status", S), ("cst_gndr", S), ("cst_create_date", D),
    ),
    "crm_prd_info": _struct(
        ("prd_id", L), ("prd_key", S), ("prd_nm", S), ("prd_cost", I),
        ("prd_line", S), ("prd_start_dt", TSN), ("prd_end_dt", TSN),
    ),
    "crm_sales_details": _struct(
        ("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", L),
        ("sls_order_dt", I), ("sls_ship_dt", I), ("sls_due_dt", I),
        ("sls_sales", I), ("sls_quantity", I), ("sls_price", I),
    ),
    "erp_loc_a101": _struct(("cid", S), ("cntry", S)),
    "erp_cust_az12": _struct(("cid", S), ("bdate", D), ("gen", S)),
    "erp_px_cat_g1v2": _struct(("id", S), ("cat", S), ("subcat", S), ("maintenance", S)),
}

SILVER = {
    "crm_cust_info": _struct(
        ("cst_id", L), ("cst_key", S), ("cst_firstname", S), ("cst_lastname", S),
        ("cst_marital_status", S), ("cst_gndr", S), ("cst_create_date", D),
        ("dwh_create_date", TS),
    ),
    "crm_prd_info": _struct(
        ("prd_id", L), ("cat_id", S), ("prd_key", S), ("prd_nm", S), ("prd_cost", I),
        ("prd_line", S), ("prd_start_dt", D), ("prd_end_dt", D), ("dwh_create_date", TS),
    ),
    "crm_sales_details": _struct(
        ("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", L),
        ("sls_order_dt", D), ("sls_ship_dt", D), ("sls_due_dt", D),
        ("sls_sales", I), ("sls_quantity", I), ("sls_price", I), ("dwh_create_date", TS),
    ),
    "erp_loc_a101": _struct(("cid", S), ("cntry", S), ("dwh_create_date", TS)),
    "erp_cust_az12": _struct(("cid", S), ("bdate", D), ("gen", S), ("dwh_create_date", TS)),
    "erp_px_cat_g1v2": _struct(
        ("id", S), ("cat", S), ("subcat", S), ("maintenance", S), ("dwh_create_date", TS),
    ),
}

GOLD = {
    "dim_customers": _struct(
        ("customer_key", L), ("customer_id", L), ("customer_number", S), ("first_name", S),
        ("last_name", S), ("country", S), ("marital_status", S), ("gender", S),
        ("birthdate", D), ("create_date", D),
    ),
    "dim_products": _struct(
        ("product_key", L), ("product_id", L), ("product_number", S), ("product_name", S),
        ("category_id", S), ("category", S), ("subcategory", S), ("maintenance", S),
        ("cost", I), ("product_line", S), ("start_date", D),
    ),
    "fact_sales": _struct(
        ("order_number", S), ("product_key", L), ("customer_key", L), ("order_date", D),
        ("shipping_date", D), ("due_date", D), ("sales_amount", I), ("quantity", I),
        ("price", I),
    ),
}

# One row per check result, the shape every quality operator emits.
CHECK_RESULT = _struct(
    ("check_name", S), ("category", S), ("passed", B), ("score", DBL), ("details", S),
)

PIPELINE_RUNS = _struct(
    ("id", L), ("run_timestamp", TSN), ("status", S), ("duration_seconds", DBL),
    ("total_records", L), ("data_quality_score", DBL), ("error_count", L), ("created_at", TSN),
)
DATA_QUALITY_CHECKS = _struct(
    ("id", L), ("run_id", L), ("check_name", S), ("check_category", S), ("passed", B),
    ("score", DBL), ("details", S), ("created_at", TSN),
)
TABLE_METRICS = _struct(
    ("id", L), ("run_id", L), ("schema_name", S), ("table_name", S), ("row_count", L),
    ("created_at", TSN),
)

# Expected bronze headers per source file (case-insensitive match).
EXPECTED_COLUMNS = {name: [f.name for f in st.fields] for name, st in BRONZE.items()}
