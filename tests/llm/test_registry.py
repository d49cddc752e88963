"""The registered queries on the smallest tables: against DuckDB, or their rows against the table's."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import ROOT, SF_SMALL
from layerforge.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import SPARK_TO_DUCK, rows_key  # noqa: E402


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[key](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[key])
    rows, names = cur.fetchall(), [d[0] for d in cur.description]
    a, b = (sorted(range(len(n)), key=lambda i, n=n: n[i]) for n in (df.columns, names))
    assert sorted(df.columns) == sorted(names)
    assert [SPARK_TO_DUCK.get(type(df.schema.fields[i].dataType).__name__) for i in a] == [str(cur.description[i][1]) for i in b]
    assert rows_key(df.collect(), a) == rows_key(rows, b)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, key):
    table, column = ("embeddings", "vec_id") if key.startswith(("op5", "op13")) else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(column).collect()}
    df = E.queries()[key](spark, SF_SMALL)
    assert {r[0] for r in df.select(column).collect()} == ids
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
