"""Shape of the physical plans."""

import pytest

from adapter import clinic
from adapter.queries import JOBS, all_queries, export, extract, movement_next_event, row_number_episode
from wardloom.plans.views import VIEWS
from wardloom.session import SETTINGS

SMALL = "/root/testdata/sf0.01"
QUERIES = all_queries()
CHECKED = [n for n in QUERIES if n.startswith(("extract_", "view_"))] + ["export_bloods", "export_demographics"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def only_small_broadcasts(spark):
    """Broadcast code lists only, as would be the case with large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40000")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", CHECKED)
def test_no_cross_join_and_no_python(spark, only_small_broadcasts, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert node not in text


@pytest.mark.parametrize("job", [j for j in JOBS if j not in ("bloods", "demographics")])
def test_cohort_is_a_semi_join(spark, job):
    assert "LeftSemi" in plan(extract(job, clinic.warehouse(spark, SMALL)))


def test_building_a_plan_runs_nothing(spark):
    warehouse, legacy = clinic.warehouse(spark, SMALL), clinic.legacy(spark, SMALL)
    built = [
        lambda: extract("episodes", warehouse),
        lambda: export("episodes", warehouse),
        lambda: row_number_episode(warehouse),
        lambda: VIEWS["movement_export"](legacy, clinic.PARAMS),
        lambda: movement_next_event(legacy),
    ]
    for build in built:  # files are opened for their schemas once
        build()
    spark.sparkContext.setJobGroup("building", "building")
    for build in built:
        build()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_a_group_is_numbered_in_slices(spark, only_small_broadcasts):
    """No window over rows has a whole group for its partition."""
    text = plan(QUERIES["row_number_episode"](spark, SMALL))
    (numbering,) = [x for x in text.splitlines() if "row_number()" in x and "Window" in x]
    assert "_at" in numbering


@pytest.mark.parametrize(
    ("name", "table"), [("row_number_episode", "lineitem"), ("movement_next_event", "lineitem"), ("view_movement", "lineitem")]
)
def test_rows_are_read_once(spark, name, table):
    """Numbers and next events come from one shuffle, which both their uses share."""
    df = QUERIES[name](spark, SMALL)
    df.collect()
    ran = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in ran
    assert sum("FileScan" in x and f"{table}.parquet" in x for x in ran.splitlines()) == 1


def test_movements_are_shuffled_once_where_nothing_is_broadcast(spark):
    """The join with the next events takes the shuffle they are made from."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        df = QUERIES["view_movement"](spark, SMALL)
        df.collect()
    finally:
        for name in names:
            spark.conf.unset(name)
    ran = plan(df).split("== Initial Plan ==")[0]
    assert sum("FileScan" in x and "lineitem.parquet" in x for x in ran.splitlines()) == 1
    assert "SortAggregate" not in ran


def test_scans_read_few_columns_and_filter_early(spark):
    text = plan(QUERIES["view_demographics_filtered"](spark, SMALL))
    (scan,) = [x for x in text.splitlines() if "FileScan" in x and "orders" in x]
    assert "o_totalprice" not in scan
    text = plan(QUERIES["half_open_interval"](spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_unpivot_reads_its_table_once(spark):
    assert plan(QUERIES["unpivot_observations"](spark, SMALL)).count("FileScan") == 1


def test_no_broadcast_hints(spark):
    df = QUERIES["extract_prescribing"](spark, SMALL)
    assert "hint" not in df._jdf.queryExecution().logical().toString().lower()
    assert SETTINGS["spark.sql.adaptive.skewJoin.enabled"] == "true"
