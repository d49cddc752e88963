"""Plan checks over every registered query: no cross products, pruned scans, map-side aggregation."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from layerforge.plans import catalog

QUERIES = {k: q for k, q in E.queries().items() if k in catalog.QUERIES}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_products(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _above(plan: str, leaf: str) -> list[str]:
    """Names of the nodes above the first line that holds ``leaf``, nearest first."""
    depth = lambda line: re.search(r"[A-Za-z(*]", line).start()
    lines = [line for line in plan.splitlines() if re.search(r"[A-Za-z]", line)]
    at = next(k for k, line in enumerate(lines) if leaf in line)
    out, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            out.append(re.sub(r"^[ :+*()\-\d]+", "", line).split(" ")[0].split("(")[0])
    return out


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fact_scan_is_pruned_and_limited_per_task(spark):
    df = QUERIES["top_customers"](spark, SF_SMALL)
    scans = [line for line in _plan(df).splitlines() if "FileScan parquet" in line and "order_number" in line]
    assert scans and all("due_date" not in s and "shipping_date" not in s for s in scans)
    assert "TakeOrderedAndProject" in _plan(df)


@pytest.mark.parametrize("key", ["top_customers", "product_performance", "sales_by_country", "kpi_summary"])
def test_fact_is_aggregated_below_its_join(spark, key):
    text = _optimized(QUERIES[key](spark, SF_SMALL))
    leaf = next(line for line in text.splitlines() if "Relation" in line and "sales_amount" in line)
    nodes = _above(text, leaf)
    assert "Aggregate" in nodes and nodes.index("Aggregate") < nodes.index("Join")


@pytest.mark.parametrize("key,joins", [("daily_sales", 0), ("sales_by_country", 1), ("country_share", 1), ("kpi_summary", 1)])
def test_no_needless_joins(spark, key, joins):
    text = _optimized(QUERIES[key](spark, SF_SMALL))
    assert len(re.findall(r"\bJoin ", text)) == joins


def test_date_parameters_reach_the_files(spark):
    assert "PushedFilters: [IsNotNull(order_date)" in _plan(QUERIES["param_query"](spark, SF_SMALL))


def test_quality_report_scans_each_table_once(spark):
    text = _optimized(QUERIES["quality_report"](spark, SF_SMALL))
    relations = re.findall(r"Relation \[([^\]]*)\]", text)
    assert len(relations) <= 15 + 4  # each stored table, and the two integrity joins
