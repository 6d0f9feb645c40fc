"""Results on data in which one spell, patient and product each hold a third of the rows.

Joins are shuffled, as they would be with large tables.
"""

import compare
import pytest
from conftest import SMALL

from adapter import queries
from oracle.queries import all_queries
from wardloom.operators import joins

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "5000",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "5000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}
HOT_COLUMNS = {
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey",
    "lineitem": "CASE WHEN (l_orderkey * 7 + l_linenumber) % 3 = 0 THEN 44 ELSE l_orderkey END AS l_orderkey,"
    " CASE WHEN l_suppkey % 3 = 1 THEN 13 ELSE l_partkey END AS l_partkey",
    "events": "CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id",
}
QUERIES = [
    "extract_episodes",
    "extract_demographics",
    "extract_diagnoses",
    "extract_bloods",
    "extract_virology",
    "extract_administration",
    "extract_icu_medication",
    "extract_icu_procedures",
    "extract_observations",
    "export_episodes",
    "export_transfers",
    "row_number_episode",
    "movement_next_event",
    "view_movement",
    "view_episode",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = compare.connect(SMALL)
    for table in compare.TABLES:
        hot = HOT_COLUMNS.get(table)
        columns = f"* REPLACE ({hot})" if hot else "*"
        con.execute(f"COPY (SELECT {columns} FROM {table}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture
def shuffled(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name in SETTINGS:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", QUERIES)
def test_result(spark, skewed, shuffled, name):
    df = queries.all_queries()[name](spark, skewed)
    assert compare.difference(df, compare.connect(skewed), all_queries()[name]) is None


def test_hot_join_key_is_split(spark, tmp_path, shuffled):
    facts = spark.range(60000).selectExpr("id", "case when id % 3 = 0 then 1 else id % 5000 end as k")
    facts.repartition(8).write.parquet(f"{tmp_path}/facts")
    spark.range(5000).selectExpr("id as code", "cast(id as string) as name").write.parquet(f"{tmp_path}/codes")
    facts, codes = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("facts", "codes"))
    df = joins.left_lookup(facts, codes, "k", "code", name="name")
    assert len(df.collect()) == 60000
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
