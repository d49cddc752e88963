"""Every registered query against its DuckDB oracle on the smallest test data."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import SPARK_TO_DUCK, rows_key  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from layerforge.plans import catalog  # noqa: E402
from layerforge.plans.oracle import with_layers  # noqa: E402
from layerforge.sources import files as FS  # noqa: E402
from layerforge.sources.standins import TABLES  # noqa: E402

QUERIES = {k: q for k, q in E.queries().items() if k in catalog.QUERIES}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["customer_name", "country", "total_sales", "order_count"]
    assert 0 < len(rows) <= 10


def test_every_key_has_an_oracle_or_is_documented():
    beyond_sql = {"file_inventory_sizes"}  # sizes and times of files; tests/test_versions_tables.py compares them with the file system
    assert set(QUERIES) == set(catalog.QUERIES) and set(catalog.QUERIES) - set(ORACLE) == beyond_sql


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows = df.collect()
    if key not in ORACLE:
        assert len(srows) > 0
        return
    cur = duck.execute(ORACLE[key])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    so = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    stypes = [SPARK_TO_DUCK.get(type(df.schema.fields[i].dataType).__name__) for i in so]
    dtypes = [str(cur.description[i][1]) for i in do]
    assert stypes == dtypes
    assert rows_key(srows, so) == rows_key(drows, do)


def test_every_stored_month_matches_the_fact(spark, duck, tmp_path):
    FS.write_partitioned(catalog._gold(spark, SF_SMALL)["fact_sales"], f"{tmp_path}/fact", "order_date")
    back = spark.read.parquet(f"{tmp_path}/fact")
    months = back.groupBy("order_year", "order_month").agg(F.count(F.lit(1)), F.sum("sales_amount"), F.sum("quantity"), F.sum("customer_key"))
    wanted = duck.execute(with_layers("""SELECT year(order_date), month(order_date), count(*), sum(sales_amount), sum(quantity), sum(customer_key)
                                         FROM g_fact GROUP BY ALL""")).fetchall()
    rows = lambda found: sorted((tuple(-1 if x is None else int(x) for x in r) for r in found))
    assert rows(months.collect()) == rows(wanted) and any(r[0] is None for r in wanted) and len(wanted) > 12
    pruned = back.where((F.col("order_year") == 1998) & F.col("order_month").between(3, 5))
    assert "PartitionFilters: [isnotnull(order_year" in pruned._jdf.queryExecution().executedPlan().toString()
