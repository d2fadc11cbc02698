"""Unit rows of every column function."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clearledger.functions import codes, parsing, text

HALF_TEN = datetime(2016, 3, 15, 10, 30)
MIDNIGHT = datetime(2016, 3, 15)


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2016-03-15 10:30:00", HALF_TEN),
        ("03/15/2016 10:30", HALF_TEN),
        ("15-03-2016 10:30:00", HALF_TEN),
        ("2016-03-15T10:30:00.000Z", HALF_TEN),
        ("2016/03/15", MIDNIGHT),
        ("2016-03-15", MIDNIGHT),
        ("03/15/2016", MIDNIGHT),
        ("15/03/2016", MIDNIGHT),
        ("12/11/1980", datetime(1980, 12, 11)),
        ("15-03-2016", None),
        ("3/5/1980", None),
        ("13/13/2016", None),
        (" 2016-03-15 ", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(column_of, raw, want):
    assert column_of(parsing.parse_timestamp, [raw]) == [want]


def test_parse_date(column_of):
    rows = {
        "1980-05-03": date(1980, 5, 3),
        "03/05/1980": date(1980, 5, 3),
        "05/23/1980": date(1980, 5, 23),
        "12/11/1980": date(1980, 11, 12),
        "1980/05/23": date(1980, 5, 23),
        "3/5/1980": None,
        "5/23/1980": None,
        "1980-02-30": None,
    }
    assert column_of(parsing.parse_date, list(rows)) == list(rows.values())


def test_signed_years_with_zeros(column_of):
    """As Spark reads them."""
    rows = {"29/05/+012016": "+12016-05-29", "+0000002016-05-29": "2016-05-29", "-000044/03/15": "-0044-03-15", "+2016-05-29": None, "-0000-05-29": None, "0000-05-29": "0000-05-29"}
    assert column_of(lambda c: parsing.parse_date(c).cast("string"), list(rows)) == list(rows.values())


@pytest.mark.parametrize(
    "fmt, shapes",
    [
        ("yyyy-MM-dd", ["9999-99-99"]),
        ("dd.MM.yyyy HH:mm", ["99.99.9999 99:99"]),
        ("yyyy-MM-dd'T'HH:mm:ss.SS'Z'", ["9999-99-99T99:99:99.9Z", "9999-99-99T99:99:99.99Z"]),
        ("yyyyMMdd", []),
        ("M/d/yyyy", []),
        ("yyyy-MM", []),
        ("yyyy-MM-dd mm", []),
        ("yyyy-MM-dd 'at' HH", []),
        ("d MMM yyyy", []),
    ],
)
def test_layouts(fmt, shapes):
    assert [x.shape for x in parsing.layouts(fmt)] == shapes


def test_formats_that_share_a_shape_or_have_none_keep_their_order(column_of):
    texts = ["03/04/2016", "13/04/2016", "3/4/2016", "04/13/2016", "2016.04.03 07:08", "20160403", "2016.04.03"]
    formats = ("MM/dd/yyyy", "M/d/yyyy", "dd/MM/yyyy", "yyyy.MM.dd HH:mm", "yyyyMMdd")
    plain = lambda c: F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])
    assert column_of(lambda c: parsing.parse_timestamp(c, formats), texts) == column_of(plain, texts)
    twice = ("MM/dd/yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd HH:mm")
    dated = lambda c: F.coalesce(*[F.try_to_date(c, f) for f in twice])
    more = [*texts, "2016-04-03 07:08", "2016-04-03 24:08"]
    assert column_of(lambda c: parsing.parse_date(c, twice), more) == column_of(dated, more)


def test_years_out_of_range_are_null(column_of):
    """Spark's own try_to_timestamp fails the whole job on these."""
    huge = ["+300000-01-01", "-290309-01-01 00:00:00", "01/01/+999999999", "+294247-01-01", "-290308/12/31"]
    assert column_of(parsing.parse_timestamp, huge) == [None] * 5
    assert column_of(parsing.parse_date, huge) == [None] * 5
    as_text = lambda c: parsing.parse_timestamp(c).cast("string")
    last = ["+289999-01-01", "+290000-01-01", "+294246-12-31", "-290307-01-01", "-100000-06-01"]
    assert column_of(as_text, last) == [f"{t} 00:00:00" for t in last]
    assert column_of(lambda c: parsing.parse_date(c).cast("string"), last) == last
    assert column_of(as_text, ["290000-01-01", "+12016/03/15", "0099-01-02"]) == [
        None,
        "+12016-03-15 00:00:00",
        "0099-01-02 00:00:00",
    ]


def test_further_formats_are_a_parameter(column_of):
    read = lambda c: parsing.parse_date(c, (*parsing.DATE_FORMATS, "M/d/yyyy", "d MMM yyyy"))
    assert column_of(read, ["3/25/1980", "3 Feb 1980", "x"]) == [date(1980, 3, 25), date(1980, 2, 3), None]


def test_to_decimal(column_of):
    money = column_of(lambda c: parsing.to_decimal(c, 18, 2), ["12.345", "-12.345", "abc", "1e20", None])
    assert money == [Decimal("12.35"), Decimal("-12.35"), None, None, None]
    assert column_of(lambda c: parsing.to_decimal(c, 10, 4), ["5e-05"]) == [Decimal("0.0001")]


def test_text(column_of):
    assert column_of(text.proper_case, ["sint-niklaas DE smedt", " o'neil bnp-paribas liège "]) == [
        "Sint-niklaas De Smedt",
        "O'neil Bnp-paribas Liège",
    ]
    assert column_of(text.trimmed, ["  \ta b  "]) == ["\ta b"]
    assert column_of(text.normalize_email, [" Jan@X.be "]) == ["jan@x.be"]
    assert column_of(text.normalize_currency, [" eur ", None]) == ["EUR", None]


def test_full_name(spark):
    rows = [(" jan PEETERS ", "x", "y"), (None, "jan", "DE smedt"), (None, None, "maes"), (None, None, None)]
    df = spark.createDataFrame(rows, "f string, a string, b string").coalesce(1)
    got = df.select(text.derive_full_name(F.col("f"), F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == ["Jan Peeters", "Jan De Smedt", "Maes", ""]


def test_boolean(column_of):
    rows = {" Y ": True, "active": True, "closed": False, "N": False, "open": None, "maybe": None, "": None}
    assert column_of(codes.normalize_boolean, [*rows, None]) == [*rows.values(), None]


def test_status(spark):
    from clearledger.operators.reshape import with_status_labels

    texts = [" Open ", "dormant", "matured", "y", "n", "???", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string").coalesce(1)
    got = with_status_labels(df.select(codes.resolve_state(F.col("c")).alias("statecode")))
    active, inactive = (0, "Active", 1, "Active"), (1, "Inactive", 2, "Inactive")
    assert [tuple(r) for r in got.collect()] == [active, inactive, inactive, active, active, active, active]


def test_labels_of_unlisted_codes(spark):
    df = spark.createDataFrame([(7,), (None,)], "c int").coalesce(1)
    c = F.col("c")
    got = df.select(codes.state_label(c), codes.status_of_state(c), codes.status_label(c), codes.holding_type_label(c))
    assert {tuple(r) for r in got.collect()} == {("Unknown", 1, "Unknown", "Unknown")}


def test_country(column_of):
    rows = {"belgium": "BE", " BEL ": "BE", "united kingdom": "GB", "USA": "US", " at ": "AT"}
    assert column_of(codes.normalize_country, [*rows, None]) == [*rows.values(), None]


def test_account_type(column_of):
    got = column_of(codes.resolve_account_type, [" CHECKING ", "money market", None])
    assert got == ["Checking", "Money Market", None]


def test_holding_type(column_of):
    texts = ["credit_line", "Term Deposit", "LOAN", "crypto", None]
    assert column_of(codes.resolve_holding_type, texts) == [104800004, 104800006, 104800003, 104800000, 104800000]
    label = lambda c: codes.holding_type_label(codes.resolve_holding_type(c))
    assert column_of(label, texts[:1]) == ["Line of Credit"]


def test_is_listed(column_of):
    assert column_of(lambda c: codes.is_listed(c, codes.STATES), [" OPEN ", "y", None]) == [True, False, False]


def test_codes_are_one_constant_lookup(spark, column_of):
    """No chain of branches, whatever the number of synonyms; the first code of a word counts."""
    df = spark.createDataFrame([(" LOAN ",)], "c string").select(codes.resolve_holding_type(F.col("c")).alias("code"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in plan and "INSET" not in plan.upper() and df.first().code == 104800003
    twice = {"a": ("x", "y"), "b": ("y", "z")}
    assert column_of(lambda c: codes.resolve_codes(c, twice, "none"), ["x", "Y ", "z", "w", None]) == ["a", "a", "b", "none", "none"]
    assert column_of(lambda c: codes.resolve_codes(c, {}, "none"), ["x"]) == ["none"]
