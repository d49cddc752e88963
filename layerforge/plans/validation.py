"""The quality suite over the three layers: one DataFrame of check results.

Families (in report order): bronze row counts, silver retention, silver
completeness of key fields, declared data types, gold accessibility,
fact-to-dimension integrity, and three business rules.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.operators import quality as Q
from layerforge.plans.warehouse import Layers, run_parallel
from layerforge.sources import check_states as CS
from layerforge.sources.files import read_current

# Fields and rules of the quality suite.
CRITICAL_FIELDS = {
    "crm_cust_info": ["cst_id", "cst_key"],
    "crm_prd_info": ["prd_id", "prd_key"],
    "crm_sales_details": ["sls_ord_num", "sls_cust_id"],
}
TYPE_RULES = {
    "crm_cust_info": {"cst_id": "int", "cst_create_date": "date"},
    "crm_sales_details": {"sls_order_dt": "yyyyMMdd", "sls_ship_dt": "yyyyMMdd", "sls_due_dt": "yyyyMMdd"},
}
TEXT_RULES = {
    "crm_cust_info": {"cst_id": "bigint", "cst_create_date": "date"},
    "crm_sales_details": {"sls_order_dt": "yyyyMMdd", "sls_ship_dt": "yyyyMMdd", "sls_due_dt": "yyyyMMdd", "sls_quantity": "int"},
}
TEXT_MISSING = {"crm_sales_details": {"sls_order_dt": "0", "sls_ship_dt": "0", "sls_due_dt": "0"}}
TYPE_MISSING = {"crm_sales_details": {"sls_order_dt": 0, "sls_ship_dt": 0, "sls_due_dt": 0}}
UNIQUE_FIELDS = {"crm_cust_info": ["cst_id"], "crm_prd_info": ["prd_id"]}
RANGES = {"sls_quantity": (1, 1000), "sls_price": (0, 100000)}


def completeness(layers: Layers) -> DataFrame:
    view = getattr(layers.silver, "view", layers.silver.get)  # every table is read once
    return Q.union_all([Q.completeness_checks(view(t), t, f) for t, f in CRITICAL_FIELDS.items()])


def dtype_family(layers: Layers) -> DataFrame:
    return Q.union_all([
        Q.dtype_checks(layers.bronze[t], t, rules, missing=TYPE_MISSING.get(t))
        for t, rules in TYPE_RULES.items()
    ])


def integrity(layers: Layers) -> DataFrame:
    g = layers.gold
    return Q.integrity_checks(g["fact_sales"], {
        "Customer": (g["dim_customers"], "customer_key"),
        "Product": (g["dim_products"], "product_key"),
    })


def business_rules(layers: Layers, as_of: str | None = None) -> DataFrame:
    g = layers.gold
    return Q.union_all([
        Q.sales_amount_check(g["fact_sales"]),
        Q.date_range_check(g["fact_sales"], as_of),
        Q.name_completeness(g["dim_customers"]),
    ])


def uniqueness(layers: Layers) -> DataFrame:
    return Q.union_all([Q.uniqueness_checks(layers.silver[t], t, f) for t, f in UNIQUE_FIELDS.items()])


def ranges(layers: Layers) -> DataFrame:
    return Q.range_checks(layers.silver["crm_sales_details"], "crm_sales_details", RANGES)


def text_measures(table: str) -> list[Q.Measure]:
    """Type rules on the text of a feed, where a value can still be of the wrong type."""
    absent = TEXT_MISSING.get(table, {})
    return [Q.typed(f, r, absent.get(f)) for f, r in TEXT_RULES[table].items()]


def table_measures(layer: str, table: str, as_of: str | None = None) -> list[Q.Measure]:
    """What the suite counts in one table."""
    if layer == "bronze":
        absent = TYPE_MISSING.get(table, {})
        return [Q.typed(f, r, absent.get(f)) for f, r in TYPE_RULES.get(table, {}).items()]
    if layer == "silver":
        return [Q.complete(f) for f in CRITICAL_FIELDS.get(table, [])]
    last = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    day = F.col("order_date")
    return {
        "fact_sales": [
            Q.rule("Valid Sales Amounts", F.col("sales_amount") <= 0, " amounts at or below zero among "),
            Q.rule("Valid Date Ranges", (day > last) | (day < F.lit(Q.OLDEST_ORDER_DATE).cast("date")), " dates out of range among "),
        ],
        "dim_customers": [Q.rule("Customer Name Completeness", F.col("first_name").isNull() | (F.col("first_name") == ""),
                                 " customers without a first name among ")],
    }.get(table, [])


#: Integrity rules of the fact (fixed values): label, dimension, key.
INTEGRITY = (("Customer", "dim_customers", "customer_key"), ("Product", "dim_products", "product_key"))


def all_checks(layers: Layers, as_of: str | None = None, text: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Every check of one run, as rows: one aggregate per table, and one join per dimension.

    A table given as ``quality.Unreadable`` gives one failed row.  ``text``: feeds as read before typing; the type rules
    of those tables look at them, as a typed column holds only what has passed already.
    """
    text = {t: df for t, df in (text or {}).items() if t in TEXT_RULES}
    parts = [Q.measured(df, layer, table, [] if layer == "bronze" and table in text else table_measures(layer, table, as_of))
             for layer in ("bronze", "silver", "gold") for table, df in getattr(layers, layer).items()]
    parts += [Q.measured(df, "bronze", table, text_measures(table)).where("kind <> 'rows'") for table, df in text.items()]
    fact = layers.gold["fact_sales"]
    for label, dim, key in INTEGRITY:
        if not isinstance(fact, Q.Unreadable) and not isinstance(layers.gold[dim], Q.Unreadable):
            parts.append(Q.matched(fact, layers.gold[dim], key, label))
    return Q.checks_of(Q.union_all(parts))


def store_with_states(spark: SparkSession, layers: Layers, base: str, parts: int = 1, as_of: str | None = None) -> dict[tuple[str, str], CS.CheckedTable]:
    """Every table of the layers stored in parts with its check states; tables that do not depend on each other at once."""
    out, loads = {}, {}
    for layer in ("bronze", "silver", "gold"):
        for table, df in getattr(layers, layer).items():
            out[layer, table] = CS.CheckedTable(f"{base}/{layer}/{table}", layer, table, tuple(table_measures(layer, table, as_of)),
                                                keys=tuple(key for _, _, key in INTEGRITY) if table == "fact_sales" else ())
            loads[f"{layer}.{table}"] = lambda t=out[layer, table], d=df: [
                CS.append_part(spark, t, d.where(F.pmod(F.xxhash64(*d.columns), F.lit(parts)) == i) if parts > 1 else d) for i in range(parts)]
    run_parallel(loads)
    return out


def report_from_states(spark: SparkSession, tables: Mapping[tuple[str, str], CS.CheckedTable]) -> DataFrame:
    """The rows of ``all_checks`` from stored states."""
    fact = tables["gold", "fact_sales"]
    return CS.report(spark, list(tables.values()), {
        label: (fact, key, CS.read_rows(spark, tables["gold", dim])) for label, dim, key in INTEGRITY})


def open_layer(spark: SparkSession, root: str, layer: str, tables: Iterable[str]) -> dict[str, DataFrame | Q.Unreadable]:
    """The current version of each stored table; what cannot be opened is ``Unreadable``."""
    out = {}
    for table in tables:
        try:
            out[table] = read_current(spark, f"{root}/{layer}/{table}")
        except (FileNotFoundError, PySparkException) as e:
            out[table] = Q.Unreadable(str(e).splitlines()[0][:200])
    return out
