"""Properties of dedup, SCD-2 intervals and surrogate keys, including a hot key."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from layerforge.operators.sequence import global_row_number, lead_in_group
from layerforge.operators.windows import asof_join, dedup_latest, scd2_intervals


def _hot_rows(spark, n=3000):
    # Key 1 holds a third of all rows; dates repeat so ties need the tie-break.
    rows = []
    for i in range(n):
        key = 1 if i % 3 == 0 else i
        d = None if i % 17 == 0 else dt.date(2020, 1, 1) + dt.timedelta(days=i % 50)
        rows.append((key, d, f"v{i % 7}", i))
    return spark.createDataFrame(rows, "k int, d date, v string, id int")


def test_dedup_latest_matches_row_number(spark):
    df = _hot_rows(spark)
    got = dedup_latest(df, ["k"], "d", tie_break=["v", "id"])
    w = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last(), F.col("v").desc_nulls_last(),
                                        F.col("id").desc_nulls_last())
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(got.collect()) == sorted(ref.select(*got.columns).collect())
    assert got.groupBy("k").count().where("count > 1").count() == 0


def test_dedup_drops_null_keys(spark):
    df = spark.createDataFrame([(None, dt.date(2020, 1, 1)), (1, None), (1, dt.date(2020, 1, 2))], "k int, d date")
    got = dedup_latest(df, ["k"], "d").collect()
    assert [tuple(r) for r in got] == [(1, dt.date(2020, 1, 2))]


def test_dedup_plan_aggregates_before_shuffle(spark):
    df = _hot_rows(spark)
    plan = dedup_latest(df, ["k"], "d")._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the exchange: the hot key is combined map-side
    assert plan.count("Aggregate") >= 2
    assert "Window" not in plan


def test_global_row_number_equals_window_and_ignores_partitioning(spark):
    df = _hot_rows(spark)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(
        F.col("k").asc_nulls_first(), F.col("d").asc_nulls_first(), F.col("id"))))
    expect = sorted((r["id"], r["rn"]) for r in ref.collect())
    for n in (1, 3, 16):
        got = global_row_number(df, ["k", "d", "id"], "rn", num_partitions=n)
        assert sorted((r["id"], r["rn"]) for r in got.collect()) == expect
    keys = [r["rn"] for r in global_row_number(df, ["k", "d", "id"], "rn").collect()]
    assert sorted(keys) == list(range(1, df.count() + 1))


def test_lead_in_group_matches_window_with_hot_key(spark):
    df = _hot_rows(spark).where(F.col("d").isNotNull())
    w = Window.partitionBy("k").orderBy("d", "id")
    ref = df.withColumn("nx", F.lead("d").over(w))
    for n in (2, 7, 16):
        got = lead_in_group(df, ["k"], ["d", "id"], "d", "nx", num_partitions=n)
        assert sorted(got.select("id", "nx").collect()) == sorted(ref.select("id", "nx").collect())


def test_scd2_intervals_do_not_overlap_and_one_is_open(spark):
    rows = [("A", dt.datetime(2020, 1, 1), 1), ("A", dt.datetime(2020, 3, 1), 2), ("A", dt.datetime(2020, 6, 1), 3),
            ("B", dt.datetime(2021, 1, 1), 4)]
    df = spark.createDataFrame(rows, "k string, s timestamp_ntz, id int")
    out = {r["id"]: r["e"] for r in scd2_intervals(df, ["k"], "s", "e", tie_break=["id"]).collect()}
    assert out == {1: dt.date(2020, 2, 29), 2: dt.date(2020, 5, 31), 3: None, 4: None}


def test_asof_join_picks_the_valid_version(spark):
    v = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2020, 1, 31), "a"),
                               (1, dt.date(2020, 2, 1), None, "b")], "vk int, s date, e date, tag string")
    f = spark.createDataFrame([(1, dt.date(2019, 12, 31)), (1, dt.date(2020, 1, 15)), (1, dt.date(2021, 1, 1))],
                              "fk int, d date")
    got = sorted((r["d"], r["tag"]) for r in asof_join(f, v, "fk", "vk", "d", "s", "e").collect())
    assert got == [(dt.date(2019, 12, 31), None), (dt.date(2020, 1, 15), "a"), (dt.date(2021, 1, 1), "b")]


def test_asof_join_equals_a_range_join(spark):
    rng, day = random.Random(3), lambda n: None if n is None else dt.date(2020, 1, 1) + dt.timedelta(n)
    versions = []
    for key in range(6):  # key 0 has a long history, empty intervals and gaps between some
        starts = sorted(rng.sample(range(400), 120 if key == 0 else 3))
        for i, (s, n) in enumerate(zip(starts, [*starts[1:], None])):
            versions.append((key, day(s), day(None if n is None else n - rng.choice((1, 1, 4))), f"{key}-{i}"))
    versions += [(1, None, None, "no start"), (None, day(0), None, "no key")]
    facts = [(rng.choice((0, 0, 1, 2, 3, 9, None)), day(rng.choice((None, *range(-5, 420)))), n // 2) for n in range(900)]
    v = spark.createDataFrame(versions, "k int, s date, e date, tag string")
    f = spark.createDataFrame(facts, "fk int, d date, s int")  # a name that the versions have too
    got = asof_join(f, v, "fk", "k", "d", "s", "e", num_partitions=7).toDF("fk", "d", "n", "vk", "vs", "ve", "tag")
    held = lambda k, d: next((x[3] for x in versions if k is not None and d and x[0] == k and x[1]
                              and x[1] <= d and (x[2] is None or d <= x[2])), None)
    assert sorted(map(repr, ((r.fk, r.d, r.n, r.tag) for r in got.collect()))) == sorted(repr((*x, held(x[0], x[1]))) for x in facts)


def test_no_single_partition_window_in_key_plan(spark):
    df = _hot_rows(spark)
    out = global_row_number(df, ["k", "d", "id"], "rn")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the only un-partitioned window runs over the per-partition offsets table
    lines = plan.splitlines()
    single = [k for k, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single and all("HashAggregate(keys=[_pid" in lines[k + 1] for k in single)
