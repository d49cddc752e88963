"""Property tests: column rules against plain-Python statements of the same rules."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from layerforge.functions import cleanse as C

ints = st.one_of(st.none(), st.integers(min_value=-50, max_value=50))


def _div(a, b):
    """SQL integer division: truncates toward zero; NULL in, NULL out."""
    if a is None or b is None:
        return None
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def _repair(s, q, p):
    expected = None if q is None or p is None else q * abs(p)
    bad_sales = s is None or s <= 0 or (expected is not None and s != expected)
    new_s = expected if bad_sales else s
    bad_price = p is None or p <= 0
    new_p = _div(s, None if q == 0 else q) if bad_price else p
    return new_s, new_p


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(ints, ints, ints), min_size=1, max_size=40))
def test_repair_amounts_matches_rule(spark, rows):
    df = spark.createDataFrame(rows, "s int, q int, p int")
    s, p = C.repair_amounts("s", "q", "p")
    got = [tuple(r) for r in df.select(s, p).collect()]
    assert got == [_repair(*r) for r in rows]


def _parse(n):
    if n is None or n == 0 or len(str(n)) != 8:
        return None
    try:
        return dt.datetime.strptime(str(n), "%Y%m%d").date()
    except ValueError:
        return None


dates = st.one_of(st.none(), st.integers(min_value=-99999999, max_value=99999999),
                  st.dates(min_value=dt.date(1000, 1, 1), max_value=dt.date(9999, 12, 31)).map(
                      lambda d: d.year * 10000 + d.month * 100 + d.day))


@settings(max_examples=30, deadline=None)
@given(st.lists(dates, min_size=1, max_size=60))
def test_parse_int_date_matches_calendar(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n int")
    got = [r[0] for r in df.select(C.parse_int_date("n")).collect()]
    assert got == [_parse(v) for v in values]


codes = st.one_of(st.none(), st.sampled_from(["s", "S", " m ", "M", "", "x", " S", "married"]))


@settings(max_examples=20, deadline=None)
@given(st.lists(codes, min_size=1, max_size=20))
def test_map_codes_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [r[0] for r in df.select(C.map_codes("c", C.MARITAL_CODES)).collect()]
    want = [{"S": "Single", "M": "Married"}.get((v or "").strip(" ").upper(), "n/a") for v in values]
    assert got == want
