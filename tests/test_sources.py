from datetime import datetime

import pytest
from conftest import SMALL, rows
from pyspark.sql import types as T

from adapter import clinic
from wardloom.params import Params
from wardloom.plans.extracts import observations
from wardloom.sources.catalog import Catalog
from wardloom.sources.legacy_tables import LEGACY_SCHEMAS, legacy_schema
from wardloom.sources.lookup import check_code_list, concat_by_code, read_code_list
from wardloom.sources.tables import missing_columns


def test_catalog_resolves_once_and_can_be_overlaid(spark):
    calls = []

    def load():
        calls.append(1)
        return spark.range(3)

    catalog = Catalog({"a": load})
    assert catalog["a"] is catalog["a"] and calls == [1]
    overlaid = catalog.with_tables(b=spark.range(1))
    assert overlaid.names() == ["a", "b"] and "b" not in catalog
    with pytest.raises(KeyError, match="no table named 'c'"):
        catalog["c"]


def test_catalog_sources(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/t")
    assert Catalog.from_parquet(spark, str(tmp_path), ["t"])["t"].count() == 2
    spark.range(4).createOrReplaceTempView("some_table")
    assert Catalog.from_metastore(spark, {"t": "some_table"})["t"].count() == 4


def test_measures_of_later_files_are_found(spark, tmp_path):
    folder = f"{tmp_path}/ObsExport"
    first = "ObsId int, `System Number > Patient ID` string, Timestamp timestamp_ntz, Pulse int, Pulse_units string, Pulse_EWS int"
    at = datetime(2021, 1, 1)
    spark.createDataFrame([(1, "S1", at, 60, "bpm", 0)], first).write.parquet(folder)
    later = first.replace("Pulse", "Temp")
    spark.createDataFrame([(2, "S1", at, 37, "C", 1)], later).write.mode("append").parquet(folder)
    catalog = Catalog.from_parquet(spark, str(tmp_path), ["ObsExport"])
    cohort = spark.createDataFrame([("S1",)], "UHL_System_Number string")
    got = observations.build(catalog.with_tables(all_suspected_covid=cohort), Params())
    assert sorted((r.observation_id, r.observation_code, r.observation_result) for r in got.collect()) == [(1, "Pulse", "60"), (2, "Temp", "37")]
    clash = first.replace("Pulse int", "Pulse string")
    spark.createDataFrame([(3, "S1", at, "60", "bpm", 0)], clash).write.mode("append").parquet(folder)
    with pytest.raises(Exception, match="(?i)merge"):
        Catalog.from_parquet(spark, str(tmp_path), ["ObsExport"])["ObsExport"].count()


def test_jdbc_tables_are_partitioned_or_said_to_be_small(spark):
    with pytest.raises(ValueError, match="partitionColumn"):
        Catalog.from_jdbc(spark, "jdbc:none:", {"facts": {"dbtable": "facts"}})
    assert "codes" in Catalog.from_jdbc(spark, "jdbc:none:", {"codes": {"dbtable": "codes", "small": "true"}})


def test_code_list_positions(spark, tmp_path):
    lines = [f"C{i // 2},\"Factor {i}, wide\"" for i in range(4000)]
    (tmp_path / "one.csv").write_text("\n".join(["ICD10,Risk_Factor", *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = read_code_list(spark, f"{tmp_path}/one.csv")
        assert got.rdd.getNumPartitions() > 1
        assert [tuple(r) for r in got.orderBy("line_no").collect()] == [
            (f"C{i // 2}", f"Factor {i}, wide", i + 1) for i in range(4000)
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_codes_join_in_file_order(spark, tmp_path):
    (tmp_path / "codes.csv").write_text('ICD10,Risk_Factor\nA1,renal\nA1,"b, c"\nB2,z\nB2,a\nC3,q\n')
    codes = concat_by_code(read_code_list(spark, f"{tmp_path}/codes.csv"))
    assert rows(codes.select("icd10", "description")) == [("A1", "renal, b, c"), ("B2", "z, a"), ("C3", "q")]
    check_code_list(codes)


def test_code_that_comes_back_is_rejected(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("ICD10,Risk_Factor\nA1,x\nB2,y\nA1,z\n")
    with pytest.raises(ValueError, match="A1"):
        check_code_list(concat_by_code(read_code_list(spark, f"{tmp_path}/codes.csv")))


def test_adapter_has_every_source_column(warehouse):
    assert missing_columns(warehouse) == {}
    assert missing_columns(Catalog({}))["PATIENT"]


def test_adapter_legacy_types(spark):
    catalog = clinic.legacy(spark, SMALL)
    assert set(catalog.names()) == set(LEGACY_SCHEMAS)
    for table in LEGACY_SCHEMAS:
        declared = {f.name: f.dataType for f in legacy_schema(table)}
        for field in catalog[table].schema:
            # ids and small numbers may be wider than declared
            same = declared[field.name] == field.dataType
            assert same or isinstance(field.dataType, (T.LongType, T.IntegerType)), (table, field)
