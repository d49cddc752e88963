"""Column-level cleansing rules of the silver layer.

Every function returns a Column built from Spark built-ins, so the rules stay
inside whole-stage codegen and can be combined in a single ``select``.
Codes are compared after ``upper(trim(x))``; NULL and unknown codes fall to
the default label.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Code maps of the silver layer (must match the source rules).
# ---------------------------------------------------------------------------
MARITAL_CODES = {"S": "Single", "M": "Married"}
GENDER_CODES = {"F": "Female", "M": "Male"}
PRODUCT_LINE_CODES = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
GENDER_WORDS = {"Female": ["F", "FEMALE"], "Male": ["M", "MALE"]}
COUNTRY_CODES = {"DE": "Germany", "US": "United States", "USA": "United States"}
NOT_AVAILABLE = "n/a"
CUSTOMER_ID_PREFIX = "NAS"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_code(c: ColumnOrName) -> Column:
    """``upper(trim(c))``: trim strips the blank only, like the source rules."""
    return F.upper(F.trim(_col(c)))


def map_codes(c: ColumnOrName, mapping: Mapping[str, str], default: str = NOT_AVAILABLE) -> Column:
    """Code -> label; NULL, blank and unknown codes -> ``default``.

    A short map becomes a ``CASE`` chain.  For a map with thousands of entries
    join a broadcast two-column table instead.
    """
    key = norm_code(c)
    out = None
    for code, label in mapping.items():
        cond = key == F.lit(code.upper())
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def map_code_lists(c: ColumnOrName, mapping: Mapping[str, Sequence[str]],
                   default: str = NOT_AVAILABLE) -> Column:
    """Label for the first list that holds ``upper(trim(c))`` (IN-list form)."""
    key = norm_code(c)
    out = None
    for label, codes in mapping.items():
        cond = key.isin([x.upper() for x in codes])
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def map_country(c: ColumnOrName) -> Column:
    """Country repair: trimmed code looked up case-sensitively; blank/NULL -> n/a."""
    t = F.trim(_col(c))
    out = None
    for code, name in COUNTRY_CODES.items():
        cond = t == F.lit(code)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.when((t == F.lit("")) | t.isNull(), F.lit(NOT_AVAILABLE)).otherwise(t)


def strip_prefix(c: ColumnOrName, prefix: str = CUSTOMER_ID_PREFIX) -> Column:
    """Drop a leading ``prefix`` (case-sensitive, like ``LIKE 'NAS%'``)."""
    col = _col(c)
    return F.when(col.startswith(prefix), F.substring(col, len(prefix) + 1, 1 << 30)).otherwise(col)


def normalize_id(c: ColumnOrName, remove: str = "-", replace_with: str = "") -> Column:
    """Replace every ``remove`` in the id (``'AW-00011000'`` -> ``'AW00011000'``)."""
    return F.replace(_col(c), F.lit(remove), F.lit(replace_with))


def split_key(c: ColumnOrName, head_len: int = 5) -> tuple[Column, Column]:
    """Compound key -> (category id, product key).

    Category id: first ``head_len`` characters with ``'-'`` turned into ``'_'``.
    Product key: everything after the separator at position ``head_len + 1``.
    """
    col = _col(c)
    head = F.replace(F.substring(col, 1, head_len), F.lit("-"), F.lit("_"))
    tail = F.substring(col, head_len + 2, 1 << 30)
    return head, tail


def _int_date_parts(col: Column) -> tuple[Column, Column]:
    """(date, valid) for a yyyymmdd integer, by arithmetic only (no string parsing).

    ``valid`` holds for a positive 8-digit value naming a calendar day.  The
    month is clamped before ``make_date`` so no invalid date is ever built.
    """
    n = col.cast("int")
    y = F.call_function("div", n, F.lit(10000))
    m = F.call_function("div", n, F.lit(100)) % 100
    d = n % 100
    first = F.make_date(y.cast("int"), F.greatest(F.least(m, F.lit(12)), F.lit(1)).cast("int"), F.lit(1))
    valid = (n.between(10000000, 99999999) & m.between(1, 12) & (d >= 1)
             & (d <= F.dayofmonth(F.last_day(first))))
    return F.date_add(first, (d - 1).cast("int")), valid


def parse_int_date(c: ColumnOrName) -> Column:
    """yyyymmdd integer -> date; 0, not 8 characters, or no valid date -> NULL.

    An 8-character value that is no calendar date (``20101399``) or a negative
    one (``-2010101``) raises in the source system; here it becomes NULL and
    ``int_date_rejected`` reports it.
    """
    date, valid = _int_date_parts(_col(c))
    return F.when(valid, date).otherwise(F.lit(None).cast("date"))


#: Bit m is set if month m has 31 days.
LONG_MONTHS = sum(1 << m for m in (1, 3, 5, 7, 8, 10, 12))


def int_date_rejected(c: ColumnOrName) -> Column:
    """True when the value has 8 characters but is no valid yyyymmdd date."""
    n = _col(c).cast("int")
    m, d, y = F.call_function("div", n, F.lit(100)) % 100, n % 100, F.call_function("div", n, F.lit(10000))
    # Days of the month from its number alone: no date is built, which keeps the generated code small.
    long_month = F.call_function("shiftright", F.lit(LONG_MONTHS), m.cast("int")).bitwiseAND(1)
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    days = F.when(m != 2, 30 + long_month).when(leap, 29).otherwise(28)
    return F.when(n.between(10000000, 99999999), ~(m.between(1, 12) & d.between(1, days))).otherwise(n.between(-9999999, -1000000))


def null_future_dates(c: ColumnOrName, as_of: Column | str | None = None) -> Column:
    """Dates after ``as_of`` (default: today) become NULL."""
    col = _col(c)
    ref = F.current_date() if as_of is None else (F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of)
    return F.when(col > ref, F.lit(None).cast("date")).otherwise(col)


def fill_nulls(c: ColumnOrName, value) -> Column:
    """``ISNULL(c, value)``."""
    return F.coalesce(_col(c), F.lit(value))


def coalesce_sources(primary: ColumnOrName, fallback: ColumnOrName,
                     unknown: str = NOT_AVAILABLE) -> Column:
    """Primary unless it is the unknown label; else fallback, else unknown.

    A NULL primary compares unknown and falls through, as in SQL.
    """
    p = _col(primary)
    return F.when(p != F.lit(unknown), p).otherwise(F.coalesce(_col(fallback), F.lit(unknown)))


def repair_amounts(sales: ColumnOrName, quantity: ColumnOrName,
                   price: ColumnOrName) -> tuple[Column, Column]:
    """(repaired sales, repaired price), both read from the *original* columns.

    sales := quantity * |price| when sales is NULL, <= 0 or differs from it.
    price := sales / NULLIF(quantity, 0) (integer division, truncating) when
    price is NULL or <= 0.  Three-valued logic: a NULL comparison is not true,
    so e.g. a NULL price with positive sales keeps the sales value.
    """
    s, q, p = _col(sales), _col(quantity), _col(price)
    expected = q * F.abs(p)
    new_sales = F.when(s.isNull() | (s <= 0) | (s != expected), expected).otherwise(s)
    q_nz = F.when(q == 0, F.lit(None)).otherwise(q)
    new_price = F.when(p.isNull() | (p <= 0), int_div(s, q_nz)).otherwise(p)
    return new_sales.cast("int"), new_price.cast("int")


def int_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integer division truncating toward zero (``7 div 2 = 3``, ``-7 div 2 = -3``).

    NULL on either side gives NULL; callers turn a zero divisor into NULL first.
    """
    return F.call_function("div", _col(a).cast("long"), _col(b).cast("long"))
