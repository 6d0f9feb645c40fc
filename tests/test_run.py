"""The whole suite from source tables to export files."""

import glob

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from adapter import clinic
from wardloom.__main__ import main
from wardloom.operators.quality import QualityError
from wardloom.plans.exports import EXPORTS
from wardloom.plans.extracts import EXTRACTS
from wardloom.plans import registry
from wardloom.plans.registry import KEY, SCHEMA, check_new, check_registry
from wardloom.plans.run import export_all, exported, refresh_all, update_registry
from wardloom.plans.spells import SPELL_EPISODES
from wardloom.sinks.delimited import current_export
from wardloom.sinks import targets
from wardloom.sinks.targets import PATIENT, ConflictError, TargetStore


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = TargetStore(spark, str(tmp_path_factory.mktemp("store")))
    refresh_all(clinic.warehouse(spark, SMALL), store, clinic.PARAMS, at_once=3)
    return store


def test_targets_equal_the_jobs_on_their_own(spark, store, warehouse):
    assert SPELL_EPISODES in store
    for name in ("diagnosis", "episodes", "transfer", "icu_procedures", "riskfactors", "demographics", "blood_test"):
        assert rows(store.read(name)) == rows(EXTRACTS[name](warehouse, clinic.PARAMS)), name


def test_registry_is_filled_once(spark, store, warehouse):
    before = rows(store.read_appended("participant", SCHEMA))
    assert len(before) == store.read("demographics").count()
    refresh_all(warehouse, store, clinic.PARAMS, ["demographics"])
    assert rows(store.read_appended("participant", SCHEMA)) == before


def test_two_runs_that_add_to_the_registry(spark, tmp_path, monkeypatch):
    """The second to finish finds the first one's identifiers and gives only the rest."""
    store = TargetStore(spark, str(tmp_path))
    people = {k: spark.createDataFrame([(f"S{i}",) for i in ids], f"{KEY} string") for k, ids in {"one": (1, 2), "two": (2, 3)}.items()}
    staged = []

    def slow(new, known):
        check_new(new, known)
        staged.append(new.count())
        if len(staged) == 1:  # the other run comes in between
            other = TargetStore(spark, store.root)
            update_registry(people["one"], other, clinic.PARAMS)

    monkeypatch.setattr(registry, "check_new", slow)
    update_registry(people["two"], store, clinic.PARAMS)
    assert staged == [2, 2, 1] and store.version("participant") == 2
    found = store.read_appended("participant", SCHEMA)
    check_registry(found)
    assert {r[KEY] for r in found.collect()} == {"S1", "S2", "S3"}


def test_registry_gives_up_after_some_tries(spark, tmp_path, monkeypatch):
    store = TargetStore(spark, str(tmp_path))
    people = spark.createDataFrame([("S1",)], f"{KEY} string")
    monkeypatch.setattr(store, "version", lambda table: 0)
    store.append("participant", spark.createDataFrame([("X", "S9")], SCHEMA), 0)
    with pytest.raises(ConflictError):
        update_registry(people, store, clinic.PARAMS, tries=2)


def test_new_identifiers_are_checked_against_the_registry(spark):
    known = spark.createDataFrame([("A1", "S1"), ("A2", "S2")], SCHEMA)
    check_new(spark.createDataFrame([("A3", "S3")], SCHEMA), known)
    for row in (("A2", "S3"), ("A3", "s1 ")):
        with pytest.raises(QualityError):
            check_new(spark.createDataFrame([row], SCHEMA), known)
    with pytest.raises(QualityError):
        check_new(spark.createDataFrame([("A3", "S3"), ("A3", "S4")], SCHEMA), known)


def test_repeated_result_stops_the_blood_tests(spark, store, warehouse):
    before = store.path("blood_test")
    results = warehouse["HAEM_RESULTS_FILE"]
    doubled = warehouse.with_tables(HAEM_RESULTS_FILE=results.union(results))
    with pytest.raises(QualityError, match="blood test patient results"):
        refresh_all(doubled, store, clinic.PARAMS, ["blood_test"])
    assert store.path("blood_test") == before


def test_code_that_comes_back_stops_the_risk_factors(store, warehouse):
    lines = warehouse["risk_factor_codes"]
    doubled = lines.union(lines.withColumn("line_no", F.col("line_no") + 10**6))
    with pytest.raises(ValueError, match="repeated apart"):
        refresh_all(warehouse.with_tables(risk_factor_codes=doubled), store, clinic.PARAMS, ["riskfactors"])


def test_export_files(spark, store, tmp_path):
    export_all(store, str(tmp_path), clinic.PARAMS, single_file=True, at_once=3)
    keys = {r.uhl_system_number for r in store.read("demographics").collect()}
    for name, export in EXPORTS.items():
        (part,) = glob.glob(f"{current_export(spark, f'{tmp_path}/{name}.csv')}/part-*")
        text = open(part).read()
        assert text.splitlines()[0] == "|".join([export.subject, *export.columns, "brc_name"])
        assert not any(key in text for key in keys)


@pytest.fixture
def no_broadcast(spark):
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    yield
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)


def test_exports_shuffle_nothing(spark, store, no_broadcast, tmp_path):
    export_all(store, str(tmp_path), clinic.PARAMS, ["orders"])
    for name in EXPORTS:
        text = exported(name, store, clinic.PARAMS)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text, name


def test_layout_is_found_again(spark, store, no_broadcast, tmp_path):
    export_all(store, str(tmp_path), clinic.PARAMS, ["orders"])
    before = rows(exported("orders", store, clinic.PARAMS))
    for table in spark.catalog.listTables():
        if table.name.startswith("wardloom_"):
            spark.sql(f"DROP TABLE {table.name}")
    assert rows(exported("orders", TargetStore(spark, store.root), clinic.PARAMS)) == before
    assert PATIENT not in store.read("orders").columns


def test_hot_patient_is_not_read_by_one_task(spark, tmp_path, monkeypatch, no_broadcast):
    monkeypatch.setattr(targets, "SMALL_BUCKET", 0)
    monkeypatch.setattr(targets, "UNEVEN", 2)
    store = TargetStore(spark, str(tmp_path))
    even = spark.range(4000).select(F.col("id").cast("string").alias(KEY), "id")
    store.replace("even", even, patient=F.col(KEY))
    hot = even.withColumn(KEY, F.when(F.col("id") % 4 != 0, "7").otherwise(F.col(KEY)))
    store.replace("hot", hot, patient=F.col(KEY))
    assert rows(store.read("hot")) == rows(hot)

    def plan(left, right):
        joined = store.read_by_patient(left).join(store.read_by_patient(right).select(PATIENT, F.col("id").alias("other")), PATIENT)
        return joined._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in plan("even", "even") and "Exchange" in plan("hot", "even")


def test_command_line(spark, tmp_path, capsys):
    source, store, out = f"{tmp_path}/source", f"{tmp_path}/store", f"{tmp_path}/out"
    catalog = clinic.warehouse(spark, SMALL)
    for name in ("all_suspected_covid", "ObsExport", "F_PAT_PRESENT"):
        catalog[name].write.parquet(f"{source}/{name}")
    common = ["--parquet", source, "--store", store, "--study-start", "2024-01-05"]
    main(["refresh", *common, "--tables", "emergency", "observations"])
    got = TargetStore(spark, store).read("emergency")
    assert rows(got) == rows(EXTRACTS["emergency"](catalog, clinic.EVENT_PARAMS))
    main(["refresh", *common, "--tables", "emergency", "--prune"])
    main(["refresh", *common, "--tables", "emergency", "--prune"])
    assert len(glob.glob(f"{store}/emergency/*/")) == 2
    capsys.readouterr()
    main(["check", *common])
    lacking = capsys.readouterr().out
    assert "PATIENT: ID" in lacking and "ObsExport" not in lacking
    with pytest.raises(SystemExit):
        main(["export", "--store", store, "--out", out, "--names", "unknown"])
