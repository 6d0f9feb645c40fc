import csv
import glob
import io
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardloom.operators.quality import QualityError
from wardloom.sinks import delimited, files
from wardloom.sinks.delimited import ExportError, current_export, read_export, verify_export, write_delimited
from wardloom.sinks.targets import ConflictError, TargetStore

VALUES = [
    ("plain", 1, Decimal("1.50000"), datetime(2020, 1, 1), date(2020, 1, 2), 0.5),
    ("pipe | in", 2, None, datetime(2020, 1, 1, 10, 0, 0, 120), None, 12345678.0),
    ('quote " in', 3, Decimal("-0.10000"), None, None, 1e16),
    (" spaces ", 4, None, datetime(2020, 1, 1, 1, 2, 3, 500000), None, 0.00012),
    ("line\nbreak", 5, None, None, None, 1.5e-05),
    ("", 6, None, None, None, -123456789.125),
    (None, 7, None, None, None, None),
    ("carriage\rreturn", 9, None, None, None, 100.0),
    ("#hash", 10, None, None, None, 0.001),
    ('back\\slash\\"', 11, None, None, None, -0.0),
    ("tab\t", 12, None, None, None, 1e22),
    ('"', 13, None, None, None, 9999999.5),
    ("0", 8, None, None, None, 1234567.0),
]
SCHEMA = "t string, i int, d decimal(18,5), at timestamp_ntz, on date, f double"


def test_delimited_bytes(spark, tmp_path):
    """The same bytes as Python's csv writer gives, but for the line feeds."""
    write_delimited(spark.createDataFrame(VALUES, SCHEMA).coalesce(1), f"{tmp_path}/x.csv", single_file=True)
    (part,) = glob.glob(f"{current_export(spark, f'{tmp_path}/x.csv')}/part-*")
    expected = io.StringIO()
    writer = csv.writer(expected, delimiter="|", quotechar='"', lineterminator="\n")
    writer.writerow(["t", "i", "d", "at", "on", "f"])
    writer.writerows(VALUES)
    got = open(part, newline="").read()
    assert sorted(got.split("\n")) == sorted(expected.getvalue().split("\n"))


def test_booleans_and_single_floats(spark, tmp_path):
    df = spark.createDataFrame([(1, True, 0.1), (2, False, 2.5), (3, None, None)], "i int, b boolean, r float")
    write_delimited(df.coalesce(1), f"{tmp_path}/x.csv", single_file=True)
    (part,) = glob.glob(f"{current_export(spark, f'{tmp_path}/x.csv')}/part-*")
    assert sorted(open(part).read().split()) == ["1|True|0.10000000149011612", "2|False|2.5", "3||", "i|b|r"]


@pytest.mark.parametrize("step", ["rows", "describe_parts", "verify_export", "write_text", "point"])
def test_failed_export_leaves_the_old_one(spark, tmp_path, monkeypatch, step):
    path = f"{tmp_path}/x.csv"
    with pytest.raises(KeyError):
        current_export(spark, path)
    write_delimited(spark.range(3), path)
    new = spark.range(5)
    if step == "rows":
        new = new.select(F.raise_error(F.lit("no such luck")).cast("int").alias("id"))

    def fail(*_):
        raise OSError("no such luck")

    with monkeypatch.context() as patched:
        if step != "rows":
            patched.setattr(files if step in ("write_text", "point") else delimited, step, fail)
        with pytest.raises(Exception, match="no such luck"):
            write_delimited(new, path)
    assert verify_export(spark, current_export(spark, path))["rows"] == 3
    assert rows(read_export(spark, path)) == [("0",), ("1",), ("2",)]
    write_delimited(spark.range(5), path)
    assert read_export(spark, path).count() == 5


def test_old_runs_go(spark, tmp_path):
    path = f"{tmp_path}/x.csv"
    for n in range(4):
        write_delimited(spark.range(n), path)
    assert len(glob.glob(f"{path}/run-*")) == 2
    write_delimited(spark.range(9), path, keep=0)
    assert len(glob.glob(f"{path}/run-*")) == 1 and read_export(spark, path).count() == 9


@pytest.mark.parametrize("damage", ["lost", "changed", "added"])
def test_damaged_export_is_found(spark, tmp_path, damage):
    path = f"{tmp_path}/x.csv"
    run = write_delimited(spark.range(40).repartition(2), path)
    assert verify_export(spark, run)["columns"] == ["id"]
    part = sorted(glob.glob(f"{run}/part-*"))[0]
    for crc in glob.glob(f"{run}/.part-*.crc"):
        os.remove(crc)
    if damage == "lost":
        os.remove(part)
    elif damage == "changed":
        text = open(part).read()
        open(part, "w").write(text.replace("7", "8"))
        if open(part).read() == text:
            open(part, "w").write(text.replace("1", "2"))
    else:
        open(f"{run}/part-99999.csv", "w").write("id\n1\n")
    with pytest.raises(ExportError):
        verify_export(spark, run)


def test_exported_line_breaks_come_back(spark, tmp_path):
    path = f"{tmp_path}/x.csv"
    write_delimited(spark.createDataFrame(VALUES, SCHEMA), path)
    got = {r.i: r.t for r in read_export(spark, path).collect()}
    assert got == {str(v[1]): v[0] or None for v in VALUES}


def test_every_part_has_a_header(spark, tmp_path):
    write_delimited(spark.createDataFrame(VALUES, SCHEMA).repartition(3, "i"), f"{tmp_path}/x.csv")
    parts = glob.glob(f"{current_export(spark, f'{tmp_path}/x.csv')}/part-*")
    assert all(open(p).readline() == "t|i|d|at|on|f\n" for p in parts)


def test_replace_and_failed_replace(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path))
    assert "t" not in store
    with pytest.raises(KeyError):
        store.read("t")
    store.replace("t", spark.range(3))
    store.replace("t", spark.range(5))
    assert store.read("t").count() == 5

    def fail(_):
        raise QualityError("no")

    with pytest.raises(QualityError):
        store.replace("t", spark.range(7), check=fail)
    assert store.read("t").count() == 5
    assert len(glob.glob(f"{tmp_path}/t/*/")) == 3
    store.prune("t")
    assert len(glob.glob(f"{tmp_path}/t/*/")) == 2
    store.prune("t", keep=0)
    assert len(glob.glob(f"{tmp_path}/t/*/")) == 1 and store.read("t").count() == 5


def test_append(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path))
    schema = "a string, b string"
    assert store.version("r") == 0 and rows(store.read_appended("r", schema)) == []
    assert store.append("r", spark.createDataFrame([("1", "x")], schema)) == 1
    assert store.append("r", spark.createDataFrame([("2", "y")], schema), 1) == 2
    assert rows(store.read_appended("r", schema)) == [("1", "x"), ("2", "y")]
    assert rows(store.read_appended("r", schema, 1)) == [("1", "x")]


def test_second_writer_of_a_version_is_refused(spark, tmp_path):
    store = TargetStore(spark, str(tmp_path))
    schema = "a string"
    store.append("r", spark.createDataFrame([("1",)], schema), 0)
    with pytest.raises(ConflictError):
        store.append("r", spark.createDataFrame([("2",)], schema), 0)
    assert rows(store.read_appended("r", schema)) == [("1",)]
    # without a version the rows are added to what is there
    assert store.append("r", spark.createDataFrame([("3",)], schema)) == 2


def test_only_one_creates_a_file(spark, tmp_path):
    path = f"{tmp_path}/f/1"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: files.create_once(spark, path, str(k) * 1000), range(8)))
    assert made.count(True) == 1 and files.read_text(spark, path) == str(made.index(True)) * 1000
    assert [x for x in os.listdir(f"{tmp_path}/f") if not x.endswith(".crc")] == ["1"]
