"""SQL text of the quality checks for the DuckDB cross-check (uses the layer CTEs)."""

from __future__ import annotations

from layerforge.plans.oracle import AS_OF, with_layers

BRONZE_CTE = {
    "crm_cust_info": "b_cust", "crm_prd_info": "b_prd", "crm_sales_details": "b_sales",
    "erp_cust_az12": "b_az", "erp_loc_a101": "b_loc", "erp_px_cat_g1v2": "b_cat",
}
SILVER_CTE = {
    "crm_cust_info": "s_cust", "crm_prd_info": "s_prd", "crm_sales_details": "s_sales",
    "erp_cust_az12": "s_az", "erp_loc_a101": "s_loc", "erp_px_cat_g1v2": "s_cat",
}
GOLD_CTE = {"dim_customers": "g_cust", "dim_products": "g_prod", "fact_sales": "g_fact"}


def _res(name: str, passed: str, score: str, details: str, src: str) -> str:
    return (f"SELECT {name} AS check_name, split_part({name}, ' - ', 1) AS category, "
            f"CAST({passed} AS BOOLEAN) AS passed, CAST({score} AS DOUBLE) AS score, "
            f"{details} AS details FROM ({src}) t")


def _ratio(num: str, den: str, empty: float) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE {empty} END"


def _n(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def row_counts(label: str, ctes: dict[str, str], suffix: str = "Row Count") -> list[str]:
    found = "rows present" if suffix == "Row Count" else "rows readable"
    none = "No rows present in table" if suffix == "Row Count" else "view is empty"
    out = []
    for t, cte in ctes.items():
        name = f"'{label} {t} - {suffix}'"
        out.append(_res(name, "n > 0", "CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END",
                        f"CASE WHEN n > 0 THEN {_n('n')} || ' {found}' ELSE '{none}' END",
                        f"SELECT COUNT(*) AS n FROM {cte}"))
    return out


def retention() -> list[str]:
    out = []
    for t in BRONZE_CTE:
        ok = "(s > 0 AND s <= b)"
        ratio = _ratio("s", "b", 0.0)
        out.append(_res(
            f"'Silver {t} - Data Retention'", f"{ok} AND {ratio} >= 0.8",
            f"CASE WHEN {ok} THEN {ratio} ELSE 0.0 END",
            f"CASE WHEN {ok} THEN 'Retained ' || {_n('s')} || ' of ' || {_n('b')} || ' rows' "
            f"ELSE 'row count outside 1 to the source count' END",
            f"SELECT (SELECT COUNT(*) FROM {BRONZE_CTE[t]}) AS b, (SELECT COUNT(*) FROM {SILVER_CTE[t]}) AS s"))
    return out


CRITICAL = {"crm_cust_info": ["cst_id", "cst_key"], "crm_prd_info": ["prd_id", "prd_key"],
            "crm_sales_details": ["sls_ord_num", "sls_cust_id"]}


def completeness() -> list[str]:
    out = []
    for t, fields in CRITICAL.items():
        for f in fields:
            score = _ratio("nn", "total", 0.0)
            out.append(_res(f"'Silver {t}.{f} - Completeness'", f"{score} >= 0.95", score,
                            f"{_n('nn')} || ' of ' || {_n('total')} || ' rows complete'",
                            f"SELECT COUNT(*) AS total, COUNT({f}) AS nn FROM {SILVER_CTE[t]}"))
    return out


def dtypes() -> list[str]:
    out = []
    cust = {"cst_id": ("INTEGER", "int"), "cst_create_date": ("DATE", "date")}
    for f, (duck, rule) in cust.items():
        src = (f"SELECT COUNT({f}) AS present, "
               f"COUNT(*) FILTER (WHERE {f} IS NOT NULL AND TRY_CAST(CAST({f} AS VARCHAR) AS {duck}) IS NULL) AS bad "
               f"FROM b_cust")
        out.append(_dt(f"crm_cust_info.{f}", rule, src))
    for f in ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]:
        present = f"{f} IS NOT NULL AND {f} <> 0"
        good = (f"length(CAST({f} AS VARCHAR)) = 8 AND "
                f"try_strptime(CAST({f} AS VARCHAR), '%Y%m%d') IS NOT NULL")
        src = (f"SELECT COUNT(*) FILTER (WHERE {present}) AS present, "
               f"COUNT(*) FILTER (WHERE {present} AND NOT ({good})) AS bad FROM b_sales")
        out.append(_dt(f"crm_sales_details.{f}", "yyyyMMdd", src))
    return out


def dtypes_of_text() -> list[str]:
    """The rules on the text of two feeds: an absent id is written 'none', an absent day 1999-02-30, an absent quantity 'few'."""
    out = []
    for f, rule in (("cst_id", "bigint"), ("cst_create_date", "date")):
        out.append(_dt(f"crm_cust_info.{f}", rule, f"SELECT count(*) AS present, count(*) - count({f}) AS bad FROM b_cust"))
    for f in ("sls_order_dt", "sls_ship_dt", "sls_due_dt"):
        out.append(_dt(f"crm_sales_details.{f}", "yyyyMMdd", f"""
            SELECT count(*) FILTER (WHERE {f} <> 0) AS present, count(*) FILTER (WHERE {f} <> 0 AND
              (length(CAST({f} AS VARCHAR)) <> 8 OR try_strptime(CAST({f} AS VARCHAR), '%Y%m%d') IS NULL)) AS bad FROM b_sales"""))
    out.append(_dt("crm_sales_details.sls_quantity", "int", "SELECT count(*) AS present, count(*) - count(sls_quantity) AS bad FROM b_sales"))
    return out


def _dt(field: str, rule: str, src: str) -> str:
    return _res(f"'Bronze {field} - Data Types'", "bad = 0", _ratio("present - bad", "present", 1.0),
                f"{_n('bad')} || ' of ' || {_n('present')} || ' values are not {rule}'", src)


def integrity() -> list[str]:
    out = []
    for label, dim, key in [("Customer", "g_cust", "customer_key"), ("Product", "g_prod", "product_key")]:
        src = (f"SELECT COUNT(*) AS total, COUNT(d.{key}) AS matched FROM g_fact f "
               f"LEFT JOIN {dim} d ON f.{key} = d.{key}")
        score = _ratio("matched", "total", 1.0)
        out.append(_res(f"'Gold - Sales-{label} Integrity'", f"{score} >= 0.95", score,
                        f"{_n('matched')} || ' of ' || {_n('total')} || ' sales match a {label.lower()}'",
                        src))
    return out


def business(as_of: str = AS_OF) -> list[str]:
    amount = _res("'Business Rule - Valid Sales Amounts'", "bad = 0", _ratio("total - bad", "total", 1.0),
                  f"CAST(bad AS VARCHAR) || ' amounts at or below zero among ' || {_n('total')} || ' rows'",
                  "SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE sales_amount <= 0) AS bad FROM g_fact")
    dates = _res("'Business Rule - Valid Date Ranges'", "bad = 0", _ratio("total - bad", "total", 1.0),
                 f"CAST(bad AS VARCHAR) || ' dates out of range among ' || {_n('total')} || ' rows'",
                 f"SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE order_date > DATE '{as_of}') "
                 f"+ COUNT(*) FILTER (WHERE order_date < DATE '2000-01-01') AS bad FROM g_fact")
    names = _res("'Business Rule - Customer Name Completeness'", "bad = 0", _ratio("total - bad", "total", 1.0),
                 f"CAST(bad AS VARCHAR) || ' customers without a first name among ' || {_n('total')} || ' rows'",
                 "SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE first_name IS NULL OR first_name = '') AS bad "
                 "FROM g_cust")
    return [amount, dates, names]


def uniqueness() -> list[str]:
    out = []
    for t, f in [("crm_cust_info", "cst_id"), ("crm_prd_info", "prd_id")]:
        out.append(_res(f"'Silver {t}.{f} - Uniqueness'", "nn - nd = 0", _ratio("nd", "nn", 1.0),
                        f"{_n('nn - nd')} || ' duplicate values of ' || {_n('nn')}",
                        f"SELECT COUNT({f}) AS nn, COUNT(DISTINCT {f}) AS nd FROM {SILVER_CTE[t]}"))
    return out


def ranges() -> list[str]:
    out = []
    for f, (lo, hi) in {"sls_quantity": (1, 1000), "sls_price": (0, 100000)}.items():
        out.append(_res(f"'Silver crm_sales_details.{f} - Range'", "inside = n", _ratio("inside", "n", 1.0),
                        f"{_n('n - inside')} || ' of ' || {_n('n')} || ' values outside [{lo}, {hi}]'",
                        f"SELECT COUNT({f}) AS n, COUNT(*) FILTER (WHERE {f} BETWEEN {lo} AND {hi}) AS inside "
                        f"FROM s_sales"))
    return out


def all_checks(types: list[str] | None = None) -> list[str]:
    return (row_counts("Bronze", BRONZE_CTE) + retention() + completeness() + (types or dtypes())
            + row_counts("Gold", GOLD_CTE, "Accessibility") + integrity() + business())


def sql(parts: list[str]) -> str:
    return with_layers("\nUNION ALL\n".join(parts))


def all_checks_cte() -> str:
    """The full suite as a CTE named ``checks`` followed by ``{select}``."""
    return ",\nchecks AS (\n" + "\nUNION ALL\n".join(all_checks()) + "\n)\n"
