"""Goldens for the column rules, including every sales-repair edge case."""

import datetime as dt


from layerforge.functions import cleanse as C


def _one(spark, schema, rows, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_map_codes_trims_uppercases_and_defaults(spark):
    got = _one(spark, "c string", [("s",), (" M ",), ("",), (None,), ("x",)],
               C.map_codes("c", C.MARITAL_CODES))
    assert got == ["Single", "Married", "n/a", "n/a", "n/a"]


def test_map_code_lists(spark):
    got = _one(spark, "c string", [("F",), ("Female",), (" male",), ("",), (None,)],
               C.map_code_lists("c", C.GENDER_WORDS))
    assert got == ["Female", "Female", "Male", "n/a", "n/a"]


def test_map_country_is_case_sensitive_after_trim(spark):
    got = _one(spark, "c string", [("DE",), ("US",), ("USA",), (" France ",), ("",), (None,), ("de",)],
               C.map_country("c"))
    assert got == ["Germany", "United States", "United States", "France", "n/a", "n/a", "de"]


def test_strip_prefix_and_normalize_id(spark):
    assert _one(spark, "c string", [("NASAW001",), ("AW002",), ("nasAW3",)], C.strip_prefix("c")) == \
        ["AW001", "AW002", "nasAW3"]
    assert _one(spark, "c string", [("AW-0001",), ("A-B-C",)], C.normalize_id("c")) == ["AW0001", "ABC"]


def test_split_key(spark):
    df = spark.createDataFrame([("CO-RF-FR-R92B-58",), ("AB",)], "k string")
    cat, key = C.split_key("k")
    assert [tuple(r) for r in df.select(cat, key).collect()] == [("CO_RF", "FR-R92B-58"), ("AB", "")]


def test_parse_int_date(spark):
    got = _one(spark, "d int", [(20101229,), (0,), (2010122,), (20101399,), (-2010101,), (None,)],
               C.parse_int_date("d"))
    assert got == [dt.date(2010, 12, 29), None, None, None, None, None]
    rej = _one(spark, "d int", [(20101229,), (0,), (2010122,), (20101399,), (-2010101,)],
               C.int_date_rejected("d"))
    assert rej == [False, False, False, True, True]


def test_null_future_dates(spark):
    got = _one(spark, "d date", [(dt.date(2000, 1, 1),), (dt.date(2030, 1, 1),), (None,)],
               C.null_future_dates("d", "2001-01-01"))
    assert got == [dt.date(2000, 1, 1), None, None]


def test_coalesce_sources(spark):
    df = spark.createDataFrame([("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male")],
                               "a string, b string")
    assert [r[0] for r in df.select(C.coalesce_sources("a", "b")).collect()] == ["Male", "Female", "n/a", "Male"]


def test_repair_amounts_edge_cases(spark):
    # (sales, qty, price) -> (repaired sales, repaired price); the eight cases of the repair rule.
    cases = [
        ((10, 2, 5), (10, 5)),        # consistent: kept
        ((None, 2, 5), (10, 5)),      # 1. NULL sales -> qty*|price|
        ((12, 2, None), (12, 6)),     # 2. NULL price, sales > 0: sales kept, price = sales / qty
        ((7, 2, 0), (0, 3)),          # 4. price 0: sales = 0, price from original sales, truncating
        ((None, 2, None), (None, None)),   # 5. both NULL
        ((-4, 2, None), (None, -2)),  # 5. NULL price, sales <= 0: sales NULL, price <= 0
        ((10, 0, -3), (0, None)),     # 6. qty 0 -> price NULL through NULLIF
        ((-7, 2, -1), (2, -3)),       # 6. truncation toward zero: -7 div 2 = -3
        ((None, 2, -5), (10, None)),  # 7. NULL sales, negative price: price NULL
        ((10, 2, -5), (10, 5)),       # 7. negative price, correct sales: price = sales / qty
    ]
    df = spark.createDataFrame([c[0] for c in cases], "s int, q int, p int")
    s, p = C.repair_amounts("s", "q", "p")
    got = [tuple(r) for r in df.select(s, p).collect()]
    assert got == [c[1] for c in cases]


def test_rules_are_idempotent(spark):
    df = spark.createDataFrame([(" m ",), ("S",), (None,)], "c string")
    once = df.select(C.map_codes("c", C.MARITAL_CODES).alias("c"))
    twice = once.select(C.map_codes("c", {"SINGLE": "Single", "MARRIED": "Married"}).alias("c"))
    assert once.collect() == twice.collect()
    assert "pythonUDF" not in df.select(C.map_codes("c", C.MARITAL_CODES))._jdf.queryExecution().toString()


def test_int_div(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(C.int_div("a", "b")).collect()] == [3, -3, None]
