"""Benchmark: headline queries at one scale factor; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Timed steps
-----------
warehouse_build   bronze -> silver -> gold, every table written as Parquet and read back
<query keys>      each headline query run to completion through the ``noop`` sink
                  (all rows produced, nothing collected to the driver)

Beside each Spark time the same query's oracle SQL runs on DuckDB over the same
files (``duckdb_queries``), as the single-node reference point.  Both engines store
the same tables first and compute each query from the layer below it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_customers", "monthly_trend", "customer_summary", "product_performance", "kpi_summary",
    "daily_sales", "demographics_rollup", "flat_sales", "category_performance", "country_share",
    "silver_customers", "silver_products", "silver_sales", "dedup_latest", "scd2_intervals",
    "scd2_asof_join", "quality_report", "ref_integrity", "run_history_summary", "threshold_alerts",
    "pipeline_health", "lineage_closure", "lineage_path", "outliers", "profile", "snapshot_diff",
    "reject_rows", "incremental_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    with_duck = os.environ.get("BENCH_DUCKDB", "1") != "0"

    from layerforge.plans.catalog import ORACLE, QUERIES
    from layerforge.plans.warehouse import layers
    from layerforge.session import build_session
    from layerforge.sources.standins import TABLES

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g"})
    # Warm the JVM (class loading, codegen caches) outside the timings.
    spark.range(1000).selectExpr("sum(id)").collect()

    times: dict[str, float] = {}
    t0 = time.time()
    layers(spark, sf_dir).store_all()
    times["warehouse_build"] = round(time.time() - t0, 3)

    for key in HEADLINE:
        t0 = time.time()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)

    duck: dict[str, float] = {}
    if with_duck:
        import duckdb

        con = duckdb.connect()
        con.execute(f"SET threads TO {cpus}")
        for t in TABLES:
            p = f"{sf_dir}/{t}.parquet"
            if os.path.exists(p):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        from layerforge.plans import oracle

        # Like for like: the tables that Spark stores are stored first (timed as the build).  Every query reads them
        # and computes the rest; those that Spark computes from bronze (silver, increments) are given bronze alone.
        stored = re.compile(r"b_(cust|prd|sales|az|loc|cat)|s_\w+|g_(cust|prod|fact)")
        from_bronze = {"silver_customers", "silver_products", "silver_sales", "incremental_upsert", "snapshot_diff"}
        ctes = re.split(r"^(\w+) AS \(", oracle.LAYERS.replace("WITH ", "", 1), flags=re.M)[1:]
        ctes = {name: f"{name} AS ({body.rstrip().rstrip(',')}" for name, body in zip(ctes[::2], ctes[1::2])}
        t0 = time.time()
        for name in ctes:
            if stored.fullmatch(name):
                con.execute(f"CREATE TABLE stored_{name} AS {oracle.with_layers(f'SELECT * FROM {name}')}")
        duck["warehouse_build"] = round(time.time() - t0, 3)

        def over_stored(key: str, rest: str) -> str:
            kept = stored if key not in from_bronze else re.compile("b_(cust|prd|sales|az|loc|cat)")
            own = [f"{n} AS (FROM stored_{n})" if kept.fullmatch(n) else body for n, body in ctes.items()]
            return "WITH " + ",\n".join(own) + "\n" + rest

        for key in HEADLINE:
            if key in ORACLE:
                sql = ORACLE[key]
                if sql.startswith(oracle.LAYERS):
                    sql = over_stored(key, sql[len(oracle.LAYERS):].strip())
                t0 = time.time()
                con.execute(sql).fetchall()
                duck[key] = round(time.time() - t0, 3)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus,
        "duckdb_queries": duck, "duckdb_total": round(sum(duck.values()), 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
