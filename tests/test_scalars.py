from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardloom.functions import scalars as S
from wardloom.functions.keys import match_key, normalise_id
from wardloom.functions.predicates import n_or_null, one_of, wall_clock


def apply(spark, values, data_type, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {data_type}")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_codes_in_predicates(spark):
    got = apply(spark, ["A ", "a", "b", " a", None], "string", one_of("v", ["A"]), n_or_null("v"))
    assert [g[0] for g in got] == [True, True, False, False, None]
    assert [g[0] for g in apply(spark, ["N ", "n", "Y", None], "string", n_or_null("v"))] == [True, True, False, True]
    codes = {"U": "0", "M": "1"}
    assert apply(spark, ["m ", "U", "x"], "string", S.recode("v", codes, "9")) == [("1",), ("0",), ("9",)]


def test_wall_clock_is_that_of_the_zone(spark):
    apart = spark.range(1).select(
        F.timestamp_diff("MINUTE", wall_clock("UTC"), wall_clock("Asia/Kolkata")).alias("m")
    )
    assert apart.first()[0] == 330


def test_number_too_large_for_a_range_raises(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        apply(spark, ["99999999999999{5"], "string", *S.parse_reference_range("v"))


def test_recode_sends_null_and_unknown_to_default(spark):
    codes = {"U": "0", "M": "1", "F": "2"}
    got = apply(spark, ["M", "F", "U", "X", None], "string", S.recode("v", codes, "9"))
    assert got == [("1",), ("2",), ("0",), ("9",), ("9",)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1.5{2", ("1.50000", "2.00000")),
        ("{2", (None, "2.00000")),
        ("5{", ("5.00000", None)),
        ("5{abc", ("5.00000", None)),
        ("<3{4", (None, "4.00000")),
        ("{", (None, None)),
        ("1e5{2", (None, "2.00000")),
        ("-1{+.5", ("-1.00000", "0.50000")),
        (" 1 { 2. ", ("1.00000", "2.00000")),
        ("1{2{3", ("1.00000", None)),
        ("12", (None, None)),
        (None, (None, None)),
        ("0.123456{0.123454", ("0.12346", "0.12345")),
    ],
)
def test_reference_range(spark, text, expected):
    got = apply(spark, [text], "string", *S.parse_reference_range("v"))[0]
    assert got == tuple(None if e is None else Decimal(e) for e in expected)


def test_hhmm(spark):
    df = spark.createDataFrame(
        [(0, "0930"), (1, ""), (2, None), (3, "2359"), (4, "07")], "i int, t string"
    ).withColumn("d", F.lit("2020-03-01").cast("date"))
    got = [r[0] for r in df.orderBy("i").select(S.hhmm_to_timestamp("d", "t")).collect()]
    day = datetime(2020, 3, 1)
    assert got == [day.replace(hour=9, minute=30), day, None, day.replace(hour=23, minute=59), day.replace(hour=7)]


def test_hhmm_without_day(spark):
    df = spark.createDataFrame([("0930",)], "t string").withColumn("d", S.null_of("date"))
    assert df.select(S.hhmm_to_timestamp("d", "t")).first()[0] is None


@pytest.mark.parametrize(
    "born, on, years",
    [
        (date(1996, 2, 29), date(2021, 2, 28), 24),
        (date(1996, 2, 29), date(2021, 3, 1), 25),
        (date(2000, 6, 15), date(2020, 6, 15), 20),
        (date(2000, 6, 15), date(2020, 6, 14), 19),
    ],
)
def test_age(spark, born, on, years):
    df = spark.createDataFrame([(born, on)], "b date, o date")
    assert df.select(S.age_at("b", "o")).first()[0] == years


def test_outcodes(spark):
    codes = ["QX1 1AA", "QX10 1AA", "QX101AA", None, "", "LONGER 1"]
    live = apply(spark, codes, "string", S.outcode_live("v"), S.has_short_outcode("v"))
    assert live == [("QX1 ", True), ("QX10 ", False), ("", True), (" ", True), ("", True), ("LONGER ", False)]
    legacy = apply(spark, codes, "string", S.outcode_legacy("v"))
    assert legacy == [("QX1",), ("QX10",), ("",), ("",), ("",), ("",)]


def test_keys(spark):
    got = apply(spark, ["ab ", "AB", " ab", None], "string", match_key("v"))
    assert got == [("AB",), ("AB",), (" AB",), (None,)]
    assert apply(spark, ["1 : 23", "1:2 3", None], "string", normalise_id("v")) == [("123",), ("123",), (None,)]


def test_texts(spark):
    assert apply(spark, ["** Many * ", None], "string", S.clean_quantity("v")) == [("Many",), (None,)]
    assert apply(spark, [1, None], "int", S.blank_if_null("v")) == [("1",), ("",)]
    got = apply(spark, ["SARS-CoV-2", "a cov b", None], "string", S.contains_text("v", "CoV", True))
    assert got == [(True,), (True,), (None,)]
    got = apply(spark, ["SARS-CoV-2", "a cov b"], "string", S.contains_text("v", "CoV", False))
    assert got == [(True,), (False,)]


def test_as_timestamp(spark):
    df = spark.createDataFrame([("20200105", date(2020, 1, 5))], "t string, d date")
    got = df.select(S.as_timestamp(df, "t"), S.as_timestamp(df, "d")).first()
    assert tuple(got) == (datetime(2020, 1, 5),) * 2
