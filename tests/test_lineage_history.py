"""Lineage closure (with a cycle), warehouse lineage, history and alert operators."""

import random

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from layerforge.session import scratch_dir
from layerforge.operators import history as H
from layerforge.operators import lineage as LN


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_closure_methods_agree_on_a_long_chain(spark):
    chain = [(str(i), str(i + 1)) for i in range(40)] + [("x", "5"), ("20", "x")]
    e = _edges(spark, chain)
    lin = {tuple(r) for r in LN.closure(e, method="linear").collect()}
    dbl = {tuple(r) for r in LN.closure(e, method="doubling").collect()}
    assert lin == dbl
    assert ("0", "40") in dbl and ("x", "x") in dbl


def test_closure_with_cycle_reaches_itself(spark):
    e = _edges(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")])
    got = {(r.asset, r.reached) for r in LN.closure(e).collect()}
    for x in "abc":
        assert (x, x) in got and (x, "d") in got
    assert ("d", "a") not in got
    up = {(r.asset, r.reached) for r in LN.closure(e, reverse=True).collect()}
    assert up == {(b, a) for a, b in got}


def test_warehouse_lineage_shape(spark):
    assets = LN.warehouse_assets(spark)
    edges = LN.edges_from_transformations(LN.warehouse_transformations(spark))
    assert assets.count() == 15
    assert edges.count() == 14
    down = {r.reached for r in LN.closure(edges.select("src", "dst")).where(
        F.col("asset") == "bronze.crm_cust_info").collect()}
    assert down == {"silver.crm_cust_info", "gold.dim_customers", "gold.fact_sales"}
    imp = {r.asset: r.risk_level for r in LN.impact(edges.select("src", "dst"),
                                                    LN.closure(edges.select("src", "dst"))).collect()}
    assert imp["bronze.crm_cust_info"] == "LOW"


def test_shortest_path_prefers_fewer_hops(spark):
    e = _edges(spark, [("a", "b"), ("b", "t"), ("a", "t"), ("c", "a")])
    got = {r.asset: (r.path, r.hops) for r in LN.shortest_paths_to(e, "t").collect()}
    assert got["a"] == ("a->t", 1)
    assert got["c"] == ("c->a->t", 2)
    assert got["t"] == ("t", 0)


def test_paths_equal_a_plain_search_on_graphs_with_cycles(spark):
    rng = random.Random(4)
    names = [f"n{i:02d}" for i in range(24)]
    pairs = list({(rng.choice(names), rng.choice(names)) for _ in range(40)}) + list(zip(names, names[1:])) + [("n05", "n05")]
    best, level = {"n23": ("n23",)}, {"n23": ("n23",)}
    while level:
        step = {}
        for a, b in pairs:
            if b in level and a not in best:
                step[a] = min(step.get(a, ("~",)), (a, *level[b]))
        best.update(step)
        level = step
    wanted = {k: ("->".join(p), len(p) - 1) for k, p in best.items()}
    for hops in (1, 4):
        got = {r.asset: (r.path, r.hops) for r in LN.shortest_paths_to(_edges(spark, pairs), "n23", hops).collect()}
        assert got == wanted


def test_threshold_alert_severity(spark):
    m = spark.createDataFrame([(1, "pipeline_duration", 650.0), (2, "pipeline_duration", 800.0),
                               (3, "pipeline_duration", 100.0)], "run_id long, metric_name string, value double")
    got = {r.run_id: r.severity for r in H.threshold_alerts(m).collect()}
    assert got == {1: "WARNING", 2: "CRITICAL"}
    crit = H.threshold_alerts(m, severity="CRITICAL").collect()
    assert [r.run_id for r in crit] == [2]


def test_health_rule_order(spark):
    runs = spark.createDataFrame([
        (1, 10.0, 1.0, 0), (2, 10.0, 0.5, 0), (3, None, 1.0, 0), (4, 10.0, 0.5, 3), (5, None, 0.0, 0),
    ], "id long, duration_seconds double, data_quality_score double, error_count long")
    got = {r.run_id: r.status for r in H.pipeline_health(runs).collect()}
    assert got == {1: "HEALTHY", 2: "WARNING", 3: "UNHEALTHY", 4: "UNHEALTHY", 5: "UNHEALTHY"}


def test_metric_categories_overlap(spark):
    names = spark.createDataFrame([("bronze_rows_per_second", 1.0), ("quality_score", 2.0), ("load_errors", 3.0), ("x", 4.0), ("x", 6.0)],
                                  "metric_name string, value double")
    assert {(r.n, r.least, r.most) for r in H.metric_categories(names).where("metric_name = 'x'").collect()} == {(2, 4.0, 6.0)}
    got = {(r.metric_name, r.category) for r in H.metric_categories(names).collect()}
    assert got == {("bronze_rows_per_second", "Throughput"), ("quality_score", "Quality"),
                   ("load_errors", "Errors"), ("x", "Other")}


def test_runs_from_events(spark):
    ev = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 1, 1), 7, "view", 1.25, "{}"),
        (2, dt.datetime(2024, 1, 1, 2), 7, "error", 2.5, "{}"),
        (3, dt.datetime(2024, 1, 2, 1), 7, "view", 1.0, "{}"),
    ], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    runs = {r.total_records: r for r in H.runs_from_events(ev).collect()}
    assert runs[2].status == "FAILED" and runs[2].duration_seconds == 3.75
    assert runs[1].status == "COMPLETED" and runs[1].data_quality_score == 1.0


def test_closure_and_impact_of_given_assets(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(20)] + [("b", "n3"), ("b", "n3"), ("loop", "loop")]
    edges = spark.createDataFrame(chain, "src string, dst string")
    start = spark.createDataFrame([("n17",), ("b",), ("loop",)], "asset string")
    got = {(r.asset, r.reached) for r in LN.closure(edges, start=start).collect()}
    assert got == {("n17", "n18"), ("n17", "n19"), ("n17", "n20"), ("loop", "loop")} | {("b", f"n{i}") for i in range(3, 21)}
    row = LN.impact_of(edges, start).first()  # both transformations that read b count, though they have one target
    assert (row.changed_assets, row.affected_assets, row.affected_transformations, row.risk_level) == (3, 19, 4, "HIGH")
    lists = {r.asset: r for r in LN.dependency_lists(edges, start).collect()}
    assert lists["n17"].impacts == ["n18", "n19", "n20"] and len(lists["n17"].depends_on) == 18 and lists["b"].depends_on is None
    assert LN.closure(edges).where("asset = 'n0'").count() == 20  # a chain of 20 in full


def test_stored_alerts_replace_their_run(spark):
    root = scratch_dir(spark, "alerts")
    m = spark.createDataFrame([(1, "error_rate", 0.5), (2, "error_rate", 0.9)], "run_id long, metric_name string, value double")
    for _ in range(2):
        H.store_alerts(H.threshold_alerts(m), root, 1)
    H.store_alerts(H.threshold_alerts(m), root, 2)
    assert sorted(r.run_id for r in spark.read.parquet(f"{root}/alerts").collect()) == [1, 2]


def test_layers_of_the_warehouse(spark):
    got = {r.layer: r.n_assets for r in LN.assets_per_layer(LN.warehouse_assets(spark)).collect()}
    assert got == {"bronze": 6, "silver": 6, "gold": 3}


def test_unreadable_table_is_a_failed_check(spark):
    from layerforge.operators import quality as Q
    from layerforge.plans.validation import open_layer

    gone = open_layer(spark, scratch_dir(spark, "nothing"), "bronze", ["t"])
    there = Q.measured(spark.range(2), "bronze", "u", [])
    rows = {r.check_name: r for r in Q.checks_of(Q.measured(gone["t"], "bronze", "t", []).unionByName(there)).collect()}
    assert not rows["Bronze t - Accessibility"].passed and rows["Bronze u - Row Count"].passed


def test_volume_changes_split_a_hot_pipeline(spark):
    rows = [(i, 1 if i % 3 else i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i // 2), i * 37 % 11) for i in range(600)]
    runs = spark.createDataFrame([(i, p, t, None if i % 50 == 7 else n) for i, p, t, n in rows],
                                 "id long, p long, created_at timestamp_ntz, total_records long").repartition(7)
    w = Window.partitionBy("p").orderBy("created_at", "id")
    wanted = runs.withColumn("before", F.lag("total_records").over(w)).where(
        F.try_divide(F.abs(F.col("total_records") - F.col("before")), F.col("before")) > 0.2)
    found = H.volume_change_alerts(runs, F.col("p"))
    assert sorted(map(tuple, found.select("id", "pipeline", "previous_records", "total_records").collect())) == \
        sorted(map(tuple, wanted.select("id", "p", "before", "total_records").collect()))
    assert found.count() > 300 and "hashpartitioning(pipeline" not in found._jdf.queryExecution().toString()
