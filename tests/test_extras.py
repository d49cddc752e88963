"""Extras on small fixtures: statistics, diffs, row filter, masking, rejects."""

import datetime as dt

from layerforge.operators import extras as X


def test_group_stats_exact_and_approx(spark):
    rows = [("a", v) for v in [1, 2, 3, 4, 100]] + [("b", 5), ("b", 5)] + [(None, 7)]
    df = spark.createDataFrame(rows, "g string, v int")
    exact = {r.g: r for r in X.group_stats(df, "g", "v").collect()}
    assert (exact["a"].n, exact["a"].q1, exact["a"].q3) == (5, 2.0, 4.0)
    assert exact["a"].iqr_outliers == 1 and exact["b"].stddev == 0.0 and exact["b"].z_outliers == 0
    assert exact[None].n == 1  # rows without a group form their own group
    approx = {r.g: r for r in X.group_stats(df, "g", "v", exact=False).collect()}
    assert approx["a"].q1 in (1.0, 2.0, 3.0) and approx["a"].n == 5


def test_snapshot_diff_kinds(spark):
    old = spark.createDataFrame([(1, "x", None), (2, "y", 5), (3, "z", 1)], "k int, a string, b int")
    new = spark.createDataFrame([(1, "x", 7), (2, "y", 5), (4, "w", 0)], "k int, a string, b int")
    got = {(r.k, r.change_type, r.b) for r in X.snapshot_diff(old, new, ["k"]).collect()}
    assert got == {(1, "UPDATE", 7), (3, "DELETE", 1), (4, "INSERT", 0)}


def test_row_filter_never_duplicates(spark):
    rows = spark.createDataFrame([(1, "DE"), (2, "FR"), (3, "DE")], "id int, country string")
    grants = spark.createDataFrame([("p", "DE"), ("p", "DE"), ("q", "FR")], "principal string, country string")
    assert sorted(r.id for r in X.row_filter(rows, grants, "p", "country").collect()) == [1, 3]


def test_mask_columns(spark):
    df = spark.createDataFrame([("Ann Lee", dt.date(1980, 7, 9))], "name string, bdate date")
    r = X.mask_columns(df, ["name"], ["bdate"]).first()
    assert len(r.name) == 64 and r.name != "Ann Lee" and r.bdate == dt.date(1980, 1, 1)


def test_reject_reasons(spark):
    day = 20101229
    sales = spark.createDataFrame([
        ("A", 20101399, day, day, 10, 2, 5),    # invalid order date
        ("B", 0, day, day, 10, 0, None),        # missing date, quantity 0, price unrepairable
        ("C", day, day, day, 10, 2, 5),         # clean
        ("D", day, 0, 20110231, 10, 2, 5),      # no ship date, invalid due date
        ("E", day, day, None, None, 2, None),   # no due date, amounts beyond repair
        ("F", day, day, day, 0, 2, 0),          # would load with a price of 0
    ], "sls_ord_num string, sls_order_dt int, sls_ship_dt int, sls_due_dt int, sls_sales int, sls_quantity int, sls_price int")
    got = {r.sls_ord_num: r.reject_reason for r in X.reject_rows(sales).collect()}
    assert got == {"A": "order_date_invalid",
                   "B": "order_date_missing;quantity_not_positive;price_unrepairable",
                   "D": "ship_date_missing;due_date_invalid",
                   "E": "due_date_missing;price_unrepairable;sales_unrepairable",
                   "F": "price_not_positive"}


def test_profile_by_sketch(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS k", "CASE WHEN id % 2 = 0 THEN 'x' END AS s")
    exact, sketch = ({r.column_name: r for r in X.profile(df, exact=e).collect()} for e in (True, False))
    for c in df.columns:
        assert exact[c].asDict() | {"distinct_values": 0} == sketch[c].asDict() | {"distinct_values": 0}
        assert abs(exact[c].distinct_values - sketch[c].distinct_values) <= 0.1 * exact[c].distinct_values
