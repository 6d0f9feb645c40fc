from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wardloom.functions import predicates as P
from wardloom.operators import joins, quality, reshape, timeline

DAY = datetime(2021, 6, 30)


def test_start_and_cutoff(spark):
    times = [DAY - timedelta(seconds=1), DAY, DAY + timedelta(hours=10), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t timestamp_ntz")

    def kept(condition):
        return [r.i for r in df.filter(condition).orderBy("i").collect()]

    assert kept(P.after("t", DAY)) == [2]
    assert kept(P.from_start("t", DAY)) == [1, 2]
    assert kept(P.until("t", DAY)) == [0]
    assert kept(P.until("t", None)) == [0, 1, 2]
    # later on the cut-off day is outside, a missing date is not
    assert kept(P.within_cutoff("t", DAY)) == [0, 1, 3]


def test_cohort_does_not_multiply_and_ignores_case(spark):
    people = spark.createDataFrame([("ab ", 1), ("CD", 2), (None, 3), ("EF", 4)], "k string, n int")
    cohort = spark.createDataFrame([("AB",), ("ab",), ("cd  ",), (None,)], "UHL_System_Number string")
    assert rows(joins.in_cohort(people, "k", cohort).select("n")) == [(1,), (2,)]
    known = cohort.filter("UHL_System_Number is not null")
    assert rows(joins.missing_on_key(people, "k", known, "UHL_System_Number").select("n")) == [(3,), (4,)]


def test_deleted_code_under_left_and_inner_join(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "i int, code string")
    codes = spark.createDataFrame(
        [("a", "A", 0), ("b", "B", 1), ("a", "A2", 1)], "CODE string, NAME string, LOGICALLY_DELETED_FLAG int"
    )
    left = joins.left_lookup(facts, joins.current(codes), "code", "CODE", name="NAME")
    assert rows(left.select("i", "name")) == [(1, "A"), (2, None), (3, None), (4, None)]
    inner = joins.inner_lookup(facts, joins.current(codes), "code", "CODE", name="NAME")
    assert rows(inner.select("i", "name")) == [(1, "A")]


def test_left_lookup_without_outputs_repeats_rows(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "z")], "i int, code string")
    codes = spark.createDataFrame([("a",), ("a",)], "CODE string")
    assert rows(joins.left_lookup(facts, codes, "code", "CODE").select("i")) == [(1,), (1,), (2,)]


def test_latest_per_key_ranks_null_dates_first(spark):
    df = spark.createDataFrame(
        [("p", None, 9, "x"), ("p", DAY, 1, "y"), ("p", DAY, 2, "w"), ("q", None, 1, "a"), ("q", None, 1, "b")],
        "k string, d timestamp_ntz, n int, code string",
    )
    got = timeline.latest_per_key(df, F.col("k"), "code", ["d", "n", "code"], "last")
    assert rows(got) == [("p", "w"), ("q", "b")]


def _events(spark, n=3000):
    """One group holds a third of the rows; many rows share their time; some have none."""
    data = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else f"g{i % 97}" if i % 7 else None
        time = None if i % 11 == 0 else DAY + timedelta(hours=(i * 37) % 500)
        data.append((group, time, f"id{i:05d}"))
    return data, spark.createDataFrame(data, "g string, t timestamp_ntz, id string").repartition(5)


@pytest.mark.parametrize("every", ["DAY", "MONTH", "YEAR"])
def test_sequence_against_brute_force(spark, every):
    data, df = _events(spark)
    expected = []
    for group in {d[0] for d in data}:
        members = sorted(
            (d for d in data if d[0] == group), key=lambda d: (d[1] is not None, d[1] or DAY, d[2])
        )
        expected += [(*d, n) for n, d in enumerate(members, 1)]
    got = timeline.sequence_in_group(df, ["g"], ["t", "id"], "n", every=every)
    assert got.columns == ["g", "t", "id", "n"]
    assert dict(got.dtypes)["n"] == "bigint"
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("every", ["DAY", "MONTH", "YEAR"])
def test_next_event_against_brute_force(spark, every):
    data, df = _events(spark, 1500)
    data = [d for d in data if d[0] is not None]
    expected = set()
    for group in {d[0] for d in data}:
        times = sorted({d[1] for d in data if d[0] == group and d[1] is not None})
        expected |= {(group, a, b) for a, b in zip(times, times[1:])}
    got = timeline.next_event_times(df.filter("g is not null"), ["g"], "t", "next", every=every)
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("every", ["HOUR", "YEAR"])
def test_rows_with_their_next_events(spark, every):
    data, df = _events(spark, 1800)
    data = [(g, t, i, i[-1]) for g, t, i in data]
    df = df.withColumn("v", F.substring("id", -1, 1)).withColumn("v", F.when(F.col("v") != "4", F.col("v")))
    expected = []
    for g, t, i, v in data:
        later = sorted(x[1] for x in data if x[0] == g and x[1] is not None and t is not None and x[1] > t)
        if later:
            ends = [None if x[3] == "4" else x[3] for x in data if x[0] == g and x[1] == later[0]]
            expected += [(g, t, i, None if v == "4" else v, later[0], e) for e in ends]
    got = timeline.with_next_events(df, ["g"], "t", "v", "next", "end", every=every)
    assert got.columns == ["g", "t", "id", "v", "next", "end"]
    assert rows(got) == sorted(expected, key=repr)
    assert len(expected) > len({x[:3] for x in expected})


def test_a_month_of_one_group_is_spread(spark):
    data = [("hot", DAY + timedelta(minutes=20 * k), f"id{k:05d}") for k in range(2000)]
    df = spark.createDataFrame(data, "g string, t timestamp_ntz, id string")
    sizes = timeline._dealt(df, ["g"], "t", timeline.SLICE).groupBy(F.pmod(F.hash("_at"), F.lit(4))).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 900
    got = timeline.sequence_in_group(df, ["g"], ["t", "id"], "n")
    assert [r.n for r in got.orderBy("id").collect()] == list(range(1, 2001))


def test_measures_need_a_value_column():
    columns = ["Pulse", "Pulse_units", "Pulse_EWS", "Temp", "Temp_units", "temp_ews", "lost_ews", "Only"]
    assert reshape.find_measures(columns) == ["Pulse"]


def test_unpivot(spark):
    df = spark.createDataFrame(
        [(1, 60, "bpm", 36.5, "C"), (2, None, "bpm", 37.0, None), (3, None, None, None, "C")],
        "id int, `Heart Rate` int, `Heart Rate_units` string, Temp double, Temp_units string",
    )
    got = reshape.unpivot_measures(df, ["id"], ["Heart Rate", "Temp"], "name", "value", "unit")
    assert rows(got) == [(1, "Heart Rate", "60", "bpm"), (1, "Temp", "36.5", "C"), (2, "Temp", "37.0", None)]
    none = reshape.unpivot_measures(df, ["id"], [], "name", "value", "unit")
    assert rows(none) == [] and none.columns == ["id", "name", "value", "unit"]
    with pytest.raises(AnalysisException):
        reshape.unpivot_measures(df.drop("Temp_units"), ["id"], ["Temp"], "name", "value", "unit").collect()


def test_checks(spark):
    df = spark.createDataFrame([("a", "x"), ("A ", "yy  "), (None, "z")], "k string, t string")
    assert rows(quality.duplicate_keys(df, "k")) == []
    assert rows(quality.duplicate_patients(df, "k")) == [("A", 2)]
    assert rows(quality.null_keys(df, "k", "t")) == [("k", 1), ("t", 0)]
    assert rows(quality.over_length(df, {"t": 1})) == [("t", 2, 1)]
    with pytest.raises(quality.QualityError, match="not unique"):
        quality.require_unique_patients(df, "k", "table")
    with pytest.raises(quality.QualityError, match="missing in 1"):
        quality.require_target(df, "k", {}, [], "table")
    kept = df.filter("k is not null")
    with pytest.raises(quality.QualityError, match="over its limit"):
        quality.require_target(kept, "k", {"t": 1}, [], "table")
    quality.require_target(kept, "k", {"t": 2}, ["t"], "table")
    shown = kept.withColumn("t", F.upper("k"))
    with pytest.warns(UserWarning, match="show the patient key"):
        quality.require_target(shown, "k", {}, ["t"], "table")
    with pytest.raises(quality.QualityError, match="v is missing in 1"):
        quality.require_target(kept.withColumn("v", F.nullif("k", F.lit("a"))), "k", {}, [], "table", ["v"])


def test_codes_compare_without_padding_and_case(spark):
    facts = spark.createDataFrame([("D1 ",), ("d1",), ("D1",), (" D1",), (None,)], "code string")
    codes = spark.createDataFrame([("D1  ", "one")], "c string, name string")
    assert rows(joins.inner_lookup(facts, codes, "code", "c", name="name")) == [("D1 ", "one"), ("D1", "one"), ("d1", "one")]
    assert joins.left_lookup(facts, codes, "code", "c", name="name").filter("name is null").count() == 2
    numbers = spark.createDataFrame([(1, "x")], "c int, name string")
    assert joins.inner_lookup(spark.range(3).withColumnRenamed("id", "n"), numbers, "n", "c", name="name").count() == 1
