"""Sources, sinks, catalog helpers, the pipeline run and quality edge cases."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from layerforge import schemas as SCH
from layerforge.operators import history as H
from layerforge.operators import lineage as LN
from layerforge.operators import quality as Q
from layerforge.plans import pipeline as PL
from layerforge.session import scratch_dir
from layerforge.sources import feeds as FE
from layerforge.sources import files as FS
from layerforge.sources import incremental as INC
from layerforge.sources import standins
from layerforge.streaming.ingest import ingest_csv_folder


def test_csv_load_keeps_bad_rows_aside(spark):
    path = scratch_dir(spark, "csv-bad")
    os.makedirs(path)
    with open(os.path.join(path, "loc.csv"), "w") as fh:
        fh.write("cid,cntry\nAW-1, DE \nAW-2,\nAW-3,US,extra\n")
    df = FS.read_bronze_csv(spark, path, SCH.BRONZE["erp_loc_a101"], keep_corrupt=True)
    rows = {r.cid: r for r in df.collect()}
    assert rows["AW-1"].cntry == " DE "          # blanks kept, no quoting
    assert rows["AW-2"].cntry is None            # empty field -> NULL
    assert rows["AW-3"][FS.CORRUPT] is not None  # too many fields -> kept aside


def test_read_csv_infer_missing_file(spark):
    assert FS.read_csv_infer(spark, "/nonexistent/folder/x.csv") is None


def test_feed_headers_and_bad_lines(spark, tmp_path):
    paths = FE.feed_paths(str(tmp_path))
    (tmp_path / "source_erp").mkdir()
    (tmp_path / "source_erp/LOC_A101.csv").write_text("CID,CNTRY\nAW-1,DE\nAW-2,US,too,many\nAW-3,\n")
    (tmp_path / "source_erp/CUST_AZ12.csv").write_text("gen,cid,extra\nF,A,1\n")
    rows = {r.file: r for r in FE.check_feeds(spark, paths).collect()}
    assert (rows["erp_loc_a101"].ok, rows["erp_loc_a101"].column_count) == (True, 2)
    assert (rows["erp_cust_az12"].missing, rows["erp_cust_az12"].extra, rows["erp_cust_az12"].ok) == ("bdate", "extra", False)
    assert not rows["crm_cust_info"].found
    feed = FE.load_feed(spark, "erp_loc_a101", paths["erp_loc_a101"])
    assert sorted(tuple(r) for r in feed.rows.collect()) == [("AW-1", "DE"), ("AW-3", None)]
    assert [r.line for r in feed.rejected.collect()] == ["AW-2,US,too,many"]
    assert (feed.rows.count(), feed.rejected.count()) == (2, 1)
    group = FE.load_group(spark, str(tmp_path / "."), "crm")
    assert group == {"customers": None, "products": None, "sales": None}
    with pytest.raises(ValueError):
        FE.load_feed(spark, "erp_cust_az12", paths["erp_cust_az12"])


def test_pipeline_from_feed_files(spark):
    root, folder = scratch_dir(spark, "wh-feeds"), scratch_dir(spark, "feeds")
    paths = FE.write_feeds(standins.bronze_tables(spark, SF_SMALL), folder)
    res = PL.run_pipeline(spark, paths, root, run_id=3, as_of="2001-01-01")
    assert res.table_rows[("bronze", "rejected_lines")] == 0
    assert res.table_rows[("gold", "fact_sales")] == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_a_run_reports_values_of_the_wrong_type(spark):
    """The typed load puts the line aside; the run's own type rules, on the text of the feed, name the field."""
    root, tables = scratch_dir(spark, "wh-types"), standins.bronze_tables(spark, SF_SMALL)
    cust = tables["crm_cust_info"].withColumn("cst_id", F.col("cst_id").cast("string"))
    wrong = cust.limit(1).withColumn("cst_id", F.lit("none")).withColumn("cst_create_date", F.lit("1999-01-01").cast("date"))
    paths = FE.write_feeds({**tables, "crm_cust_info": cust.unionByName(wrong)}, scratch_dir(spark, "feeds"))
    res = PL.run_pipeline(spark, paths, root, run_id=4, as_of="2001-01-01")
    assert res.table_rows[("bronze", "rejected_lines")] == 1
    stored = {r.check_name: r for r in PL.read_history(spark, f"{root}/history")["data_quality_checks"].collect()}
    ids, days = (stored[f"Bronze crm_cust_info.{c} - Data Types"] for c in ("cst_id", "cst_create_date"))
    assert not ids.passed and ids.details.startswith("1 of ") and days.passed
    assert "Bronze crm_sales_details.sls_quantity - Data Types" in stored


def test_wide_keys_do_not_meet(spark):
    """Keys beyond the padded width, and ids beyond 32 bits, go through dimensions and fact without fan-out."""
    from layerforge.plans import gold, silver

    ids = [1234567, 1234568, 2 ** 31 + 5]
    key = F.col("k")
    prd = spark.createDataFrame([(i,) for i in ids], "k long").select(
        (key * 10).alias("prd_id"), F.concat(F.lit("EC-07-"), standins.product_number(key)).alias("prd_key"), F.lit("n").alias("prd_nm"),
        F.lit(1).alias("prd_cost"), F.lit("M").alias("prd_line"), F.lit("2010-01-01").cast("timestamp_ntz").alias("prd_start_dt"))
    custs = [123456789, 123456788, 2 ** 31 + 7]
    cust = spark.createDataFrame([(i,) for i in custs], "k long").select(
        key.alias("cst_id"), standins.customer_number(key).alias("cst_key"), *[F.lit("x").alias(c) for c in (
            "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr")], F.lit("2000-01-01").cast("date").alias("cst_create_date"))
    demo = cust.select(F.col("cst_key").alias("cid"), F.lit("2010-05-05").cast("date").alias("bdate"), F.lit("M").alias("gen"))
    loc = cust.select(F.col("cst_key").alias("cid"), F.lit("DE").alias("cntry"))
    cats = spark.createDataFrame([("EC_07", "c", "s", "Yes")], SCH.BRONZE["erp_px_cat_g1v2"])
    dp = gold.dim_products(silver.silver_products(prd), cats)
    dc = gold.dim_customers(silver.silver_customers(cust), silver.silver_demographics(demo), silver.silver_locations(loc))
    assert dp.select("product_number").distinct().count() == 3 and dc.select("customer_number").distinct().count() == 3
    assert dc.where("birthdate = DATE '2010-05-05'").count() == 3  # the default reference date is today
    sales = spark.createDataFrame(list(zip(ids, custs)), "p long, c long").select(
        F.lit("SO1").alias("sls_ord_num"), standins.product_number(F.col("p")).alias("sls_prd_key"), F.col("c").alias("sls_cust_id"),
        *[F.lit(None).cast("date").alias(f"sls_{d}_dt") for d in ("order", "ship", "due")],
        *[F.lit(1).alias(f"sls_{x}") for x in ("sales", "quantity", "price")])
    fact = gold.fact_sales(sales, dp, dc)
    assert fact.count() == 3 and fact.where("product_key IS NULL OR customer_key IS NULL").count() == 0


def test_publish_keeps_the_version_before_a_failed_load(spark):
    base = scratch_dir(spark, "pub")
    assert not FS.has_version(spark, base)
    FS.publish(spark.range(3), base)
    with pytest.raises(Exception):
        FS.publish(spark.range(3).select(F.raise_error(F.lit("x")).alias("id")), base)
    assert FS.read_current(spark, base).count() == 3


def test_incremental_loads_and_stable_keys(spark):
    base, keys = scratch_dir(spark, "inc"), scratch_dir(spark, "keys")
    schema = "id long, v string, d date"
    day = lambda n: dt.date(2020, 1, n)
    first = spark.createDataFrame([(1, "a", day(1)), (2, "b", day(2)), (3, "n", None)], schema)
    both = first.union(spark.createDataFrame([(1, "c", day(5)), (0, "z", day(4))], schema))
    INC.load_increment(first, base, ["id"], "d")
    assert INC.watermark(spark, base, "d") == day(2)
    for _ in range(2):  # run again: the same state
        got = {(r.id, r.v) for r in INC.load_increment(both, base, ["id"], "d").collect()}
        assert got == {(0, "z"), (1, "c"), (2, "b"), (3, "n")}
    one = {r.id: r.k for r in INC.assign_keys(first, keys, ["id"], ["id"], "k").collect()}
    two = {r.id: r.k for r in INC.assign_keys(both.dropDuplicates(["id"]), keys, ["id"], ["id"], "k").collect()}
    assert one == {1: 1, 2: 2, 3: 3} and two == {0: 4, **one}


def test_export_json_rows(spark):
    path = scratch_dir(spark, "metrics")
    FS.export_json(spark.createDataFrame([("rows", 3.0)], "name string, value double"), path)
    row = spark.read.json(path).first()
    assert (row["name"], row["value"], row["type"]) == ("rows", 3.0, "double") and row["timestamp"]


def test_write_counted_and_versioned_refresh(spark):
    df = spark.range(25).withColumnRenamed("id", "k")
    assert FS.write_counted(df, scratch_dir(spark, "counted")) == 25
    base = scratch_dir(spark, "versions")
    FS.publish(df.where("k < 5"), base)
    FS.publish(df, base)
    assert FS.read_current(spark, base).count() == 25


def test_layer_schemas_and_tables(spark):
    root = scratch_dir(spark, "catalog")
    FS.create_layer_schemas(spark, root)
    assert {"bronze", "silver", "gold"} <= set(FS.list_schemas(spark))
    df = spark.range(3).withColumnRenamed("id", "k")
    FS.publish_table(df, "silver", "t_demo", f"{root}/silver/t_demo")
    FS.publish_table(df.union(df), "silver", "t_demo", f"{root}/silver/t_demo")
    assert spark.table("silver.t_demo").count() == 6
    listed = [(r.schema_name, r.table_name) for r in FS.list_tables(spark, "silver").collect()]
    assert ("silver", "t_demo") in listed


def test_streaming_ingest_is_exactly_once(spark):
    landing = scratch_dir(spark, "landing")
    target = scratch_dir(spark, "stream-target")
    ckpt = scratch_dir(spark, "stream-ckpt")
    rows = spark.createDataFrame([("AW-1", "DE"), ("AW-2", "US")], SCH.BRONZE["erp_loc_a101"])
    FS.write_bronze_csv(rows, f"{landing}/b1")
    ingest_csv_folder(spark, f"{landing}/*", SCH.BRONZE["erp_loc_a101"], target, ckpt)
    ingest_csv_folder(spark, f"{landing}/*", SCH.BRONZE["erp_loc_a101"], target, ckpt)  # nothing new
    assert spark.read.parquet(target).count() == 2
    FS.write_bronze_csv(rows, f"{landing}/b2")
    ingest_csv_folder(spark, f"{landing}/*", SCH.BRONZE["erp_loc_a101"], target, ckpt)
    assert spark.read.parquet(target).count() == 4


def test_pipeline_run_records_history(spark):
    root = scratch_dir(spark, "wh")
    res = PL.run_pipeline(spark, SF_SMALL, root, run_id=7, as_of="2001-01-01")
    assert res.table_rows[("gold", "dim_customers")] > 0
    assert set(res.layer_seconds) == {"bronze", "silver", "gold"}
    history = PL.read_history(spark, f"{root}/history")
    runs = history["pipeline_runs"].collect()
    assert [(r.id, r.status) for r in runs] == [(7, "COMPLETED")] and runs[0].run_timestamp <= runs[0].created_at
    assert all(s >= 0 for s in res.table_seconds.values()) and set(res.table_seconds) == set(res.table_rows)
    with pytest.raises(Exception):
        PL.run_pipeline(spark, "/nonexistent/folder", root, run_id=9)
    history = PL.read_history(spark, f"{root}/history")
    assert {r.id: r.status for r in history["pipeline_runs"].collect()} == {7: "COMPLETED", 9: "FAILED"}
    assert H.recent_runs(history["pipeline_runs"], 1).first().id == 9
    assert H.history_summary(history["pipeline_runs"], str(runs[0].created_at)).first().success_rate == 50.0
    assert H.latest_run_checks(history["data_quality_checks"], history["pipeline_runs"].where("id = 7")).count() == res.checks.count()
    alerts = spark.read.parquet(f"{root}/history/alerts").collect()  # some checks fail, so the run raises an alert
    assert [(r.run_id, r.metric_name) for r in alerts] == [(7, "error_rate")] and alerts[0].value > alerts[0].threshold == 0.05
    PL.record_run(spark, res, f"{root}/history")  # a retried run replaces its rows
    assert spark.read.parquet(f"{root}/history/alerts").count() == 1
    more = PL.RunResult(11, None, {t: 2 * n for t, n in res.table_rows.items()}, res.table_seconds)
    more.started, more.layer_seconds = res.started, {"bronze": 650.0, "silver": 100.0}
    PL.record_run(spark, more, f"{root}/alerts-only")
    PL.record_run(spark, res, f"{root}/alerts-only")
    raised = {(r.run_id, r.metric_name): r.severity for r in spark.read.parquet(f"{root}/alerts-only/alerts").collect()}
    assert raised[(11, "pipeline_duration")] == "CRITICAL" and raised[(7, "data_volume_change")] == "CRITICAL"
    assert spark.read.parquet(f"{root}/history/pipeline_runs").where("id = 7").count() == 1
    assert spark.read.parquet(f"{root}/history/table_metrics").count() == len(res.table_rows)
    n_checks = spark.read.parquet(f"{root}/history/data_quality_checks").count()
    assert n_checks == res.checks.count() >= 27
    # the customer dedup keeps < 80 % of bronze rows, so a validation-only run fails
    assert PL.validate_only(res.layers, "2001-01-01") == 1
    try:
        PL.run_load("silver.unknown")
    except KeyError:
        pass
    else:
        raise AssertionError("unknown load accepted")


def test_lineage_save_and_load(spark):
    path = scratch_dir(spark, "lineage")
    LN.save_lineage(LN.warehouse_assets(spark), LN.warehouse_transformations(spark), path)
    assets, tr = LN.load_lineage(spark, path)
    assert assets.count() == 15 and LN.edges_from_transformations(tr).count() == 14


def test_quality_edge_cases(spark):
    empty = spark.createDataFrame([], "cst_id int, cst_key string")
    c = {r.check_name: r for r in Q.completeness_checks(empty, "t", ["cst_id"]).collect()}
    assert c["Silver t.cst_id - Completeness"].score == 0.0
    assert not c["Silver t.cst_id - Completeness"].passed

    bronze = {"t": spark.range(2)}
    silver = {"t": spark.range(3)}
    r = Q.retention_checks(bronze, silver).first()
    assert (r.passed, r.score) == (False, 0.0)
    assert r.details == "row count outside 1 to the source count"

    fact = spark.createDataFrame([], "customer_key long")
    dim = spark.createDataFrame([(1,)], "customer_key long")
    i = Q.integrity_checks(fact, {"Customer": (dim, "customer_key")}).first()
    assert (i.passed, i.score) == (True, 1.0)

    sales = spark.createDataFrame([(1,), (-1,), (None,)], "sales_amount int")
    s = Q.sales_amount_check(sales).first()
    assert s.score == 2 / 3 and not s.passed and s.category == "Business Rule"

    d = spark.createDataFrame([(dt.date(1999, 1, 1),), (dt.date(2030, 1, 1),), (dt.date(2000, 6, 1),)],
                              "order_date date")
    assert Q.date_range_check(d, "2001-01-01").first().score == 1 / 3


def test_bucketed_gold_joins_without_shuffle(spark):
    from layerforge.plans import bi

    root = scratch_dir(spark, "wh-bucketed")
    res = PL.run_pipeline(spark, SF_SMALL, root, run_id=8, as_of="2001-01-01", buckets=4)
    fact = spark.table("gold.fact_sales")
    dim = spark.table("gold.dim_customers")
    assert fact.count() == res.table_rows[("gold", "fact_sales")]
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                         "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        plan = bi.top_customers(fact, dim)._jdf.queryExecution().executedPlan().toString()
        joined = fact.join(dim, "customer_key")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "Exchange hashpartitioning" not in joined
    # per-customer pre-aggregation and the join reuse the bucketing: no hash exchange at all
    assert "Exchange hashpartitioning" not in plan
