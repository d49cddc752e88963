"""Commits, expiry, merge-on-read tables, interval tables and snapshot digests."""

import itertools
import os
import random
import threading
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layerforge.operators import quality as Q
from layerforge.operators.extras import group_stats, snapshot_diff
from layerforge.operators.sequence import quantiles_in_group
from layerforge.operators.windows import dedup_latest, scd2_intervals
from layerforge.plans import bi
from layerforge.sources import check_states as CS
from layerforge.sources import dead_letter as DL
from layerforge.sources import files as FS
from layerforge.sources import incremental as INC
from layerforge.sources import interval_table as IT
from layerforge.sources import merge_table as MT
from layerforge.sources import snapshots as SN
from layerforge.sources import versions as V
from layerforge.streaming.ingest import keep_latest, keep_latest_by_state


def _rows(df):
    return Counter(map(tuple, df.collect()))


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


# -- commits ------------------------------------------------------------------

@pytest.mark.parametrize("scheme", ["", "file:"])
def test_one_of_two_writers_gets_a_number(spark, tmp_path, scheme):
    base, wins, gate = f"{scheme}{tmp_path}/t", [], threading.Barrier(8)

    def write(i):
        gate.wait()
        for n in range(1, 21):
            if V.put_if_absent(spark, f"{base}/_versions/{n:020d}", {"published": 0, "entry": {"paths": [str(i)]}}):
                wins.append((n, i))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(n for n, _ in wins) == list(range(1, 21))
    assert all(V.version(spark, base, n).paths == [str(i)] for n, i in wins)  # the winner's content, whole
    assert not [x for x in os.listdir(tmp_path / "t" / "_versions") if x.startswith(".")]


def test_exclusive_rename_of_hadoop_file_systems(spark, tmp_path, monkeypatch):
    class Remote:  # the same local files, under the name of another file system
        def __init__(self, fs):
            self.fs = fs

        def getScheme(self):
            return "remote"

        def __getattr__(self, name):
            return getattr(self.fs, name)

    plain = V._at
    monkeypatch.setattr(V, "_at", lambda s, p: (Remote(plain(s, p)[0]), plain(s, p)[1]))
    path = f"{tmp_path}/t/_versions/{1:020d}"
    assert V.put_if_absent(spark, path, {"published": 1, "entry": {"paths": ["a"]}})
    assert not V.put_if_absent(spark, path, {"published": 2, "entry": {"paths": ["b"]}})
    assert V.version(spark, f"{tmp_path}/t", 1).paths == ["a"]


def test_two_refreshes_at_once_are_both_kept(spark, tmp_path):
    base, gate = str(tmp_path / "t"), threading.Barrier(4)

    def refresh(i):
        gate.wait()
        FS.publish(spark.range(i + 1), base)

    threads = [threading.Thread(target=refresh, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    found = [V.version(spark, base, n) for n in V.numbers(spark, base)]
    assert [v.n for v in found] == [1, 2, 3, 4]
    assert sorted(FS.read_version(spark, base, v).count() for v in found) == [1, 2, 3, 4]
    assert FS.read_current(spark, base).count() == FS.read_version(spark, base, found[-1]).count()


def test_a_dependent_load_learns_of_another_commit(spark, tmp_path):
    base = str(tmp_path / "t")
    FS.publish(spark.range(3), base, 0)
    with pytest.raises(V.CommitConflict):
        FS.publish(spark.range(9), base, 0)
    assert FS.read_current(spark, base).count() == 3 and V.numbers(spark, base) == [1]
    assert len([x for x in os.listdir(base) if x.startswith("v-")]) == 1  # the loser's folder is gone


def test_loads_at_once_lose_no_key(spark, tmp_path):
    base, gate = str(tmp_path / "k"), threading.Barrier(3)

    def give(i):
        gate.wait()
        INC.assign_keys(spark.range(i * 5, i * 5 + 10).toDF("id"), base, ["id"], ["id"], "k").collect()

    threads = [threading.Thread(target=give, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    rows = FS.read_current(spark, base).collect()
    assert sorted(r.id for r in rows) == list(range(20)) and sorted(r.k for r in rows) == list(range(1, 21))


def test_expiry_spares_the_newest_held_shared_and_young(spark, tmp_path):
    base, now = str(tmp_path / "t"), 10 * V.DAY + 1e9
    for i in range(6):
        FS.publish(spark.range(i), base)
    kept = {n: V.version(spark, base, n) for n in V.numbers(spark, base)}
    V.commit(spark, base, {"paths": kept[1].paths + kept[6].paths})  # the newest still uses the first one's folder
    os.makedirs(f"{base}/v-abandoned")
    with V.hold(spark, base, 3) as held:
        assert V.expire(spark, base, keep_last=2, grace=V.DAY) == []  # out of the log first, folders later
        assert V.numbers(spark, base) == [3, 6, 7]
        import time
        removed = V.expire(spark, base, keep_last=2, grace=V.DAY, now=time.time() + 2 * V.DAY, abandoned_after=30 * V.DAY)
        assert sorted(removed) == sorted(kept[n].paths[0] for n in (2, 4, 5))
        assert FS.read_version(spark, base, held).count() == 2
    assert V.expire(spark, base, keep_last=1, older_than=V.DAY) == [] and V.numbers(spark, base) == [3, 6, 7]
    later = time.time() + 20 * V.DAY
    V.expire(spark, base, keep_last=1, now=later, abandoned_after=300 * V.DAY)
    removed = V.expire(spark, base, keep_last=1, now=later + 2 * V.DAY, abandoned_after=10 * V.DAY)
    assert set(removed) == {kept[3].paths[0], "v-abandoned"}  # 1 and 6 are in the newest version
    assert V.numbers(spark, base) == [7] and FS.read_current(spark, base).count() == 5
    assert now and V.expire(spark, base) == []


# -- incremental state --------------------------------------------------------

D = lambda n: date(2020, 1, 1) + timedelta(days=n)
FEED = "a int, b string, d date, v string"


def _feed(rng, n, keys=40):
    return [(rng.choice([None, *range(keys)]), rng.choice(["x", "y", None]), rng.choice([None, *map(D, range(6))]), rng.choice(["p", "q", None, "r"]))
            for _ in range(n)]


def test_late_rows_of_the_watermarks_day_and_null_keys(spark, tmp_path):
    one = [(1, "x", D(3), "old")]
    two = one + [(2, "x", D(3), "late, same day"), (3, None, D(2), "before it"), (None, "x", D(3), "no key")]
    df = lambda rows: spark.createDataFrame(rows, FEED)
    INC.load_increment(df(one), str(tmp_path / "s"), ["a"], "d")
    state = INC.load_increment(df(two), str(tmp_path / "s"), ["a"], "d")
    assert sorted(r.v for r in state.collect()) == ["late, same day", "old"]  # rows without a key have no state, as in a full load
    assert sorted(r.v for r in INC.load_increment(df(two), str(tmp_path / "s"), ["a"], "d", overlap_days=2).collect()) == [
        "before it", "late, same day", "old"]
    keys = str(tmp_path / "k")
    first = {(r.a, r.b): r.k for r in INC.assign_keys(df(two), keys, ["a", "b"], ["a", "b"], "k").collect()}
    again = INC.assign_keys(df(two + [(None, None, None, "n")]), keys, ["a", "b"], ["a", "b"], "k").collect()
    assert len(first) == 4 and {(r.a, r.b): r.k for r in again} == {**first, (None, None): 5}
    assert FS.read_current(spark, keys).count() == 5


def _table(tmp_path, name="m", **kw):
    return MT.MergeTable(str(tmp_path / name), ("a", "b"), "d", **{"buckets": 8, **kw})


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_merge_table_equals_a_full_load(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(MT, "FILTER_ROWS", limit)
    rng, table = random.Random(limit), _table(tmp_path)
    rows, loads = _feed(rng, 300), 5
    df = spark.createDataFrame(rows, FEED)
    for i in range(loads):
        MT.load(spark, table, spark.createDataFrame(rows[i::loads], FEED))
        if i == 2:
            before = V.newest(spark, table.base)
            after = MT.compact(spark, table)
            assert not after.entry["deltas"] and after.n == before.n + 1
    wanted = _rows(dedup_latest(df, ["a", "b"], "d", drop_null_keys=False))
    assert _rows(MT.read(spark, table)) == wanted
    MT.load(spark, table, df)  # all of it again changes nothing
    MT.load(spark, table, df.limit(0))
    assert _rows(MT.read(spark, table)) == wanted
    MT.compact(spark, table)
    assert _rows(MT.read(spark, table)) == wanted and MT.compact(spark, table).n == V.newest(spark, table.base).n
    assert any(k[0] is None for k in wanted) and any(k[1] is None for k in wanted)


def test_merge_table_reads_from_its_watermark(spark, tmp_path):
    table, wanted = _table(tmp_path), []
    feed = [(1, "x", D(1), "p"), (2, "x", D(3), "p"), (3, "x", None, "p")]
    for more in ([], [(4, "x", D(3), "late, same day"), (1, "x", D(2), "older than the watermark")], [(1, "x", D(4), "new"), (None, None, None, "n")], []):
        feed = feed + more
        MT.load_since(spark, table, spark.createDataFrame(feed, FEED))
        wanted.append(V.newest(spark, table.base))
    assert sorted(r.v for r in MT.read(spark, table).collect()) == ["late, same day", "n", "new", "p", "p"]
    assert [sum(map(len, v.entry["deltas"].values())) for v in wanted[:2]] == [0, 1]  # known rows are not written again
    assert wanted[3].n == wanted[2].n  # nothing new: no version
    MT.load_since(spark, table, spark.createDataFrame(feed + [(9, "x", D(3), "a day late")], FEED), overlap_days=2)
    assert "a day late" in {r.v for r in MT.read(spark, table).collect()}


def test_a_small_load_writes_little_and_compaction_only_what_is_due(spark, tmp_path):
    table = _table(tmp_path, buckets=16, deal_by=("b",))
    big = spark.range(200_000).select(F.col("id").cast("int").alias("a"), F.concat(F.lit("b"), F.col("id") % 40).alias("b"),
                                      F.lit(D(1)).alias("d"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    MT.load(spark, table, big)
    base = _size(table.base)
    small = big.where("b = 'b7' and a % 3 = 0").withColumn("d", F.lit(D(2)))  # a hundredth or so, all in one bucket
    share = small.count() / 200_000
    MT.load(spark, table, small)
    grown = _size(table.base) - base
    assert share < 0.02 and grown < 2 * share * base + 20_000
    scanned = lambda df: {p.split("/_bucket=")[1].split("/")[0] for p in _files_read(df)}
    v = V.newest(spark, table.base)
    touched = {b for own in v.entry["deltas"].values() for b in own}
    assert len(touched) == 1 and scanned(MT.read(spark, table, [int(b) for b in touched])) == touched
    untouched = MT.read(spark, table, [b for b in range(16) if str(b) not in touched])
    assert "Aggregate" not in untouched._jdf.queryExecution().optimizedPlan().toString()
    before = _size(table.base)
    MT.compact(spark, table, least_share=0.9)  # nothing is due
    assert _size(table.base) == before
    MT.compact(spark, table)
    assert 0 < _size(table.base) - before < base / 5
    assert MT.read(spark, table).where(F.col("d") == F.lit(D(2))).count() == small.count() and MT.read(spark, table).count() == 200_000
    V.expire(spark, table.base, grace=0.0)
    assert V.expire(spark, table.base, grace=0.0) == [] and MT.read(spark, table).count() == 200_000


def test_loads_and_compaction_at_once(spark, tmp_path):
    rng, table = random.Random(8), _table(tmp_path)
    rows = _feed(rng, 240)
    MT.load(spark, table, spark.createDataFrame(rows[:40], FEED))
    MT.load(spark, table, spark.createDataFrame(rows[40:60], FEED))
    gate, failed = threading.Barrier(4), []

    def run(i):
        gate.wait()
        try:
            MT.compact(spark, table) if i == 3 else MT.load(spark, table, spark.createDataFrame(rows[60 + 60 * i:120 + 60 * i], FEED))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert failed == []
    assert _rows(MT.read(spark, table)) == _rows(dedup_latest(spark.createDataFrame(rows, FEED), ["a", "b"], "d", drop_null_keys=False))


def test_merge_table_refuses_other_columns(spark, tmp_path):
    table = _table(tmp_path)
    with pytest.raises(FileNotFoundError):
        MT.read(spark, table)
    MT.load(spark, table, spark.createDataFrame([(1, "x", None, "p")], FEED))
    with pytest.raises(ValueError):
        MT.load(spark, table, spark.createDataFrame([(1, "x", None, "p")], FEED.replace("v ", "w ")))
    with pytest.raises(ValueError):
        MT.load(spark, table, spark.createDataFrame([(1, "x", None, "p")], FEED.replace("v ", "_bucket ")))


# -- intervals ----------------------------------------------------------------

HISTORY = "k int, start date, nr int, name string"


def test_batches_in_any_order_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3, 4]), D(rng.choice([1, 3, 5, 9, 20])), rng.randint(0, 1), rng.choice(["m", "n", None])) for _ in range(50)]
    best = {}
    for r in rows:
        best[r[:3]] = max(best.get(r[:3], r), r, key=lambda x: (x[3] is not None, x[3] or ""))
    whole = spark.createDataFrame(list(best.values()), HISTORY)
    wanted = _rows(scd2_intervals(whole, ["k"], "start", "until", ["nr"]))
    parts = [rows[:20], rows[20:35], rows[30:]]
    for i, order in enumerate(list(itertools.permutations(parts))[:3]):
        table = IT.IntervalTable(str(tmp_path / f"h{i}"), ("k",), "start", "until", ("nr",), buckets=4)
        for part in order:
            IT.merge_versions(spark, table, spark.createDataFrame(part, HISTORY))
        assert _rows(IT.read_intervals(spark, table).select("k", "start", "nr", "name", "until")) == wanted
    last = V.newest(spark, table.base).n
    IT.merge_versions(spark, table, spark.createDataFrame(rows, HISTORY))  # known versions: nothing is written
    assert V.newest(spark, table.base).n == last


def test_a_late_version_splits_one_interval(spark, tmp_path):
    table = IT.IntervalTable(str(tmp_path / "h"), ("k",), "start", "until", buckets=4)
    put = lambda *rows: IT.merge_versions(spark, table, spark.createDataFrame(rows, "k int, start date, name string"))
    put(*[(k, D(10 * i), f"{k}-{i}") for k in range(30) for i in range(4)])
    v = put((7, D(15), "late"))
    delta = [n for own in v.entry["deltas"].values() for n in own.values()]
    assert sum(delta) == 2  # the new version and the one it closes
    got = sorted((r.start, r.until, r.name) for r in IT.read_intervals(spark, table).where("k = 7").collect())
    assert got == [(D(0), D(9), "7-0"), (D(10), D(14), "7-1"), (D(15), D(19), "late"), (D(20), D(29), "7-2"), (D(30), None, "7-3")] or \
        [(s, u) for s, u, _ in got] == [(D(0), D(9)), (D(10), D(14)), (D(15), D(19)), (D(20), D(29)), (D(30), None)]
    put((7, D(40), "newest"), (99, D(1), "new key"))
    rows = {(r.k, r.start): r.until for r in IT.read_intervals(spark, table).collect()}
    assert rows[(7, D(30))] == D(39) and rows[(7, D(40))] is None and rows[(99, D(1))] is None and len(rows) == 123


def test_batches_at_once_serialise(spark, tmp_path):
    table = IT.IntervalTable(str(tmp_path / "h"), ("k",), "start", "until", buckets=2)
    gate = threading.Barrier(3)

    def run(i):
        gate.wait()
        IT.merge_versions(spark, table, spark.createDataFrame([(1, D(i), f"v{i}"), (2, D(9 - i), "w")], "k int, start date, name string"))

    threads = [threading.Thread(target=run, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    rows = {(r.k, r.start): r.until for r in IT.read_intervals(spark, table).collect()}
    assert rows == {(1, D(0)): D(0), (1, D(1)): D(1), (1, D(2)): None, (2, D(7)): D(7), (2, D(8)): D(8), (2, D(9)): None}


# -- snapshots ----------------------------------------------------------------

def test_snapshot_changes_read_only_differing_leaves(spark, tmp_path):
    base = str(tmp_path / "s")
    rows = [(i, None if i % 7 == 0 else i, f"n{i}") for i in range(400)] + [(None, 1, "no id")]
    new = [r for r in rows if r[0] != 11] + [(1000, 1, "new")]
    new[5], new[6] = (5, 5, None), (6, None, "n6")
    df = lambda r: spark.createDataFrame(r, "id int, x int, name string").repartition(3)
    for r in (rows, new, new[::-1], rows[:0]):
        SN.publish_snapshot(df(r), base, ["id"], leaves=64, fan=4)
    assert _rows(SN.snapshot_changes(spark, base, 1, 2)) == _rows(snapshot_diff(df(rows), df(new), ["id"]))
    assert Counter(r.change_type for r in SN.snapshot_changes(spark, base, 1, 2).collect()) == Counter(INSERT=1, DELETE=1, UPDATE=2)
    leaves = SN.changed_leaves(spark, base, *[V.version(spark, base, n) for n in (1, 2)])
    assert 1 <= len(leaves) <= 4
    plan = SN.snapshot_changes(spark, base, 1, 2)
    read = {p.split("_leaf=")[1].split("/")[0] for p in _files_read(plan)}
    assert read <= {str(x) for x in leaves}
    assert SN.snapshot_changes(spark, base, 2, 3).collect() == []  # the order of rows does not matter
    assert SN.changed_leaves(spark, base, *[V.version(spark, base, n) for n in (2, 3)]) == []
    assert Counter(r.change_type for r in SN.snapshot_changes(spark, base, 2, 4).collect()) == Counter(DELETE=len(new))
    assert _rows(SN.read_snapshot(spark, base, 2)) == _rows(df(new))
    SN.publish_snapshot(df(rows), base, ["id"], leaves=16, fan=4)
    with pytest.raises(ValueError):
        SN.snapshot_changes(spark, base, 1, 5)


def _files_read(df):
    """Files that the scans of the executed plan really open."""
    plan = df._jdf.queryExecution().sparkPlan()
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            parts = node.inputRDD().partitions()
            for p in parts:
                out += [f.filePath().toString() for f in p.files()]
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_moved_nulls_are_a_change(spark, tmp_path):
    base = str(tmp_path / "s")
    for r in ([(1, None, "x")], [(1, "x", None)]):
        SN.publish_snapshot(spark.createDataFrame(r, "id int, a string, b string"), base, ["id"], leaves=4, fan=2)
    assert [r.change_type for r in SN.snapshot_changes(spark, base, 1, 2).collect()] == ["UPDATE"]


# -- check states -------------------------------------------------------------

def test_reports_read_states_not_old_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, "a", "b", " "]), rng.choice([None, -1.5, 0.0, 3.0])) for _ in range(300)]
    df = lambda r: spark.createDataFrame(r, "customer_key int, name string, amount double")
    measures = (Q.complete("name"), Q.rule("Amounts", F.col("amount") <= 0, " bad among "))
    table = CS.CheckedTable(str(tmp_path / "c"), "gold", "fact_sales", measures, ("customer_key", "name", "amount"), ("customer_key",))
    dim = spark.createDataFrame([(i,) for i in range(0, 30, 2)], "customer_key int")
    for part in (rows[:100], rows[100:250], rows[250:250]):
        CS.append_part(spark, table, df(part))
    for v in V.newest(spark, table.base).paths:
        for d, _, names in os.walk(f"{table.base}/{v}/rows"):
            for f in names:
                with open(os.path.join(d, f), "wb") as out:  # not a table any more
                    out.write(b"gone")
    CS.append_part(spark, table, df(rows[250:]))  # reads none of the old parts
    report = CS.report(spark, [table], {"Customer": (table, "customer_key", dim)})
    wanted = Q.checks_of(Q.union_all([Q.measured(df(rows), "gold", "fact_sales", measures), Q.matched(df(rows), dim, "customer_key", "Customer")]))
    drop = lambda frame: Counter(tuple(r[c] for c in r.asDict() if c != "created_at") for r in frame.collect())
    assert drop(report) == drop(wanted) and report.count() == 4
    more = spark.createDataFrame([(i,) for i in range(30)], "customer_key int")  # the dimension grows: old rows find their key
    share = {r.check_name: r.score for r in CS.report(spark, [table], {"Customer": (table, "customer_key", more)}).collect()}
    assert share["Gold - Sales-Customer Integrity"] == sum(r[0] is not None for r in rows) / 300
    profile = {r.column: r for r in CS.column_profile(spark, table).collect()}
    assert (profile["amount"].least, profile["amount"].greatest, profile["amount"].distinct_values) == ("-1.5", "3.0", 3)
    assert profile["customer_key"].distinct_values == 30 and profile["customer_key"].greatest == "29"
    assert profile["name"].non_null == sum(r[1] is not None for r in rows)
    with pytest.raises(ValueError):
        CS.append_part(spark, table, df(rows).withColumn("more", F.lit(1)))
    never = CS.CheckedTable(str(tmp_path / "none"), "gold", "dim", ())
    assert [r.passed for r in CS.report(spark, [never], {}).collect()] == [False]


def test_sketches_of_days_roll_up(spark):
    fact = spark.range(60_000).select((F.col("id") % 9973).alias("customer_key"), F.lit(1).alias("sales_amount"),
                                      F.date_add(F.lit(D(0)), (F.col("id") % 90).cast("int")).alias("order_date"))
    days = bi.daily_customer_sketches(fact)
    assert days.count() == 90
    whole = bi.distinct_from_sketches(days).head()
    assert whole.orders == whole.total_sales == 60_000
    assert abs(whole.distinct_customers - 9973) <= bi.DISTINCT_BOUND * 9973
    assert bi.distinct_from_sketches(days.limit(0)).head().distinct_customers in (0, None)


# -- dead letters -------------------------------------------------------------

def test_rejects_are_replayed_once(spark, tmp_path):
    base = str(tmp_path / "d")
    rows = [(i, None if i % 5 == 0 else i) for i in range(100)]
    reason = F.when(F.col("x").isNull(), "x missing")
    DL.split_load(spark, base, spark.createDataFrame(rows, "id int, x int"), reason, "run-1")
    waiting = DL.rejects(spark, base)
    assert DL.good_rows(spark, base).count() == 80 and waiting.count() == 20
    assert {(r[DL.REASON], r[DL.RUN]) for r in waiting.collect()} == {("x missing", "run-1")}
    ids = [r[DL.REJECT] for r in waiting.collect()]
    assert len(set(ids)) == 20
    mended = spark.createDataFrame([(r.id, None if r.id == 50 else -r.id, r[DL.REJECT]) for r in waiting.collect() if r.id > 20]
                                   + [(7, 7, "no such reject")], f"id int, x int, {DL.REJECT} string")
    DL.replay(spark, base, mended.union(mended), reason, "run-2")
    DL.replay(spark, base, mended, reason, "run-3")  # nothing of it waits any more
    good = DL.good_rows(spark, base)
    wanted = Counter([r for r in rows if r[1] is not None] + [(i, -i) for i in range(25, 100, 5) if i != 50])
    assert _rows(good) == wanted and good.columns == ["id", "x"]
    left = {r.id: r[DL.RUN] for r in DL.rejects(spark, base).collect()}
    assert left == {0: "run-1", 5: "run-1", 10: "run-1", 15: "run-1", 20: "run-1", 50: "run-2"}  # 50 failed again, as a new reject
    assert good.count() + len(left) == 100
    assert {p.split(f"{DL.SIDE}=")[1][0] for p in good.inputFiles()} == {"0"}


def test_a_replay_writes_its_rows_once(spark, tmp_path):
    base, reason = str(tmp_path / "d"), F.when(F.col("x").isNull(), "x")
    DL.split_load(spark, base, spark.createDataFrame([(i, None) for i in range(30)], "id int, x int"), reason, "run-1")
    mended = spark.createDataFrame([(r.id, None if r.id == 3 else 1, r[DL.REJECT]) for r in DL.rejects(spark, base).collect()], f"id int, x int, {DL.REJECT} string")
    v = DL.replay(spark, base, mended.where("id < 10"), reason, "run-2")
    assert not os.path.exists(f"{base}/_drafts") and os.listdir(f"{base}/{v.paths[-1]}") == ["rows"]
    assert {r.id for r in DL.rejects(spark, base).collect()} == {3, *range(10, 30)}
    # A replay of before, whose ids lie in files of their own.
    old = f"load-{'0' * 32}"
    ids = mended.where("id between 10 and 14").select(DL.REJECT)
    DL.V.commit(spark, base, {**v.entry, "paths": [*v.paths, old], "loads": [*v.entry["loads"], old], "replays": [*v.entry["replays"], old]}, v.n)
    ids.write.parquet(f"{base}/{old}/_replayed")
    assert {r.id for r in DL.rejects(spark, base).collect()} == {3, *range(15, 30)}
    DL.replay(spark, base, mended, reason, "run-3")
    assert _rows(DL.good_rows(spark, base)) == Counter((i, 1) for i in range(30) if i != 3 and not 10 <= i < 15)
    assert [r.id for r in DL.rejects(spark, base).collect()] == [3]


def test_replays_at_once(spark, tmp_path):
    base, gate = str(tmp_path / "d"), threading.Barrier(3)
    DL.split_load(spark, base, spark.createDataFrame([(i, None) for i in range(30)], "id int, x int"), F.when(F.col("x").isNull(), "x"), "r")
    mended = spark.createDataFrame([(r.id, 1, r[DL.REJECT]) for r in DL.rejects(spark, base).collect()], f"id int, x int, {DL.REJECT} string")

    def run(i):
        gate.wait()
        DL.replay(spark, base, mended.where(F.col("id") >= 5 * i), F.when(F.col("x").isNull(), "x"), f"r{i}")

    threads = [threading.Thread(target=run, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r.id for r in DL.good_rows(spark, base).collect()) == list(range(30)) and DL.rejects(spark, base).count() == 0


# -- inventory ----------------------------------------------------------------

def test_inventory_names_every_file(spark, tmp_path):
    import __spark_entry__ as E

    for name in ("a", "new one"):
        spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    found = {r.file: r for r in E.queries()["file_inventory_sizes"](spark, str(tmp_path)).collect()}
    assert set(found) == {"a.parquet", "new one.parquet"}
    for name, r in found.items():
        size = _size(f"{tmp_path}/{name}")
        assert r.size_bytes >= size > 0 and r.size_mb == round(r.size_bytes / 1024 / 1024, 2) and r.columns == ["id"] and r.modified is not None


def test_layers_are_built_anew_for_new_files(spark, tmp_path):
    from layerforge.plans.warehouse import _state_of

    spark.range(5).write.parquet(f"{tmp_path}/t.parquet")
    before = _state_of(spark, str(tmp_path))
    assert _state_of(spark, str(tmp_path)) == before
    spark.range(9).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert _state_of(spark, str(tmp_path)) != before


# -- quantiles and streams ----------------------------------------------------

def test_quantiles_by_rank_have_no_group_buffer(spark):
    import numpy as np

    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.randint(-50, 50)) for _ in range(400)] + [("one", 7), ("two", 1), ("two", 2)]
    rows += [("wide", i * 3) for i in range(5000)] + [("same", 4)] * 30
    df = spark.createDataFrame(rows, "g string, x long")
    counts = df.groupBy("g", "x").count()
    shares = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q9": 0.9, "q": 1.0}
    found = quantiles_in_group(counts, "g", "x", "count", shares, num_partitions=7)
    assert "percentile" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.g: tuple(r)[1:] for r in found.collect()}
    for g in {g for g, _ in rows}:
        assert np.allclose(got[g], [np.quantile([x for h, x in rows if h == g], q) for q in shares.values()])
    stats = {r.g: (r.q1, r.q3) for r in group_stats(df, "g", "x").collect()}
    assert stats["wide"] == (3749.25, 11247.75) and stats["same"] == (4.0, 4.0) and None in stats
    assert group_stats(df.limit(0), "g", "x").collect() == []


def test_a_stream_restarts_where_it_failed(spark, tmp_path, monkeypatch):
    rng, table = random.Random(9), MT.MergeTable(str(tmp_path / "t"), ("a", "b"), "d", buckets=4)
    rows = _feed(rng, 200)
    landing, checkpoint = f"{tmp_path}/in", f"{tmp_path}/ck"
    put = lambda i: spark.createDataFrame(rows[i::4], FEED).coalesce(1).write.parquet(f"{landing}/{i}")
    stream = lambda: spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    put(0), put(1)
    load = MT.load

    def fails_after_writing(s, t, batch):
        load(s, t, batch)
        raise OSError("lost after the commit")

    monkeypatch.setattr(MT, "load", fails_after_writing)
    with pytest.raises(Exception):
        keep_latest(stream(), table, checkpoint)
    monkeypatch.setattr(MT, "load", load)
    put(2), put(3)
    keep_latest(stream(), table, checkpoint)  # the first batch is taken again
    assert _rows(MT.read(spark, table)) == _rows(dedup_latest(spark.createDataFrame(rows, FEED), ["a", "b"], "d", drop_null_keys=False))
    n = V.newest(spark, table.base).n
    assert n == 5
    keep_latest(stream(), table, checkpoint)
    assert V.newest(spark, table.base).n == n


def test_a_stream_with_state_drops_only_what_is_too_late(spark, tmp_path, monkeypatch):
    schema = "k long, at timestamp, v long"
    start = datetime(2024, 1, 1)
    at = lambda day, hour=0: start + timedelta(days=day, hours=hour)
    table = MT.MergeTable(str(tmp_path / "t"), ("k",), "at", buckets=4)
    landing, checkpoint = f"{tmp_path}/in", f"{tmp_path}/ck"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    taken = []

    def put(i, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{landing}/{i}")
        taken.extend(rows)

    def same_as_batch():
        assert _rows(MT.read(spark, table)) == _rows(dedup_latest(spark.createDataFrame(taken, schema), ["k"], "at", drop_null_keys=False))

    put(0, [(k, at(0, h), h) for k in (1, 2, None) for h in range(5)] + [(7, None, 1), (7, None, 2)])
    assert keep_latest_by_state(stream(), table, checkpoint) == (0, 3)
    same_as_batch()
    put(1, [(1, at(0, 2), 99), (2, at(6), 5), (3, at(6), 6)])  # the first is outdated but not too late
    load = MT.load

    def fails_after_writing(s, t, batch):
        load(s, t, batch)
        raise OSError("lost after the commit")

    monkeypatch.setattr(MT, "load", fails_after_writing)
    with pytest.raises(Exception):
        keep_latest_by_state(stream(), table, checkpoint)
    monkeypatch.setattr(MT, "load", load)
    run = keep_latest_by_state(stream(), table, checkpoint)  # the batch is taken again, from the state before it
    same_as_batch()
    assert run == (0, 2)  # the first day is behind the watermark and has left the store
    put(2, [(2, at(5), 1), (3, at(7), 8), (1, None, 3)])
    assert keep_latest_by_state(stream(), table, checkpoint).too_late == 0
    same_as_batch()
    spark.createDataFrame([(9, at(1), 1)], schema).coalesce(1).write.parquet(f"{landing}/3")
    assert keep_latest_by_state(stream(), table, checkpoint).too_late == 1
    same_as_batch()  # key 9 is not there
    before = V.newest(spark, table.base).n
    assert keep_latest_by_state(stream(), table, checkpoint).too_late == 0
    assert V.newest(spark, table.base).n == before
