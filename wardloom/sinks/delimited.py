"""Pipe-delimited export files.

Text is quoted only where needed, quotes are doubled, and a missing value is
empty.  Rows end in a line feed: Spark would also rewrite line breaks inside
quoted text if another row ending were set.

An export is a folder with one folder per run, each with a manifest of its
files, and a pointer to the run that counts.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardloom.sinks import files

MANIFEST = "MANIFEST.json"


class ExportError(ValueError):
    """The files of an export are not those that were written."""

OPTIONS = {
    "sep": "|",
    "header": True,
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    # otherwise a first value that starts with "#" is quoted
    "comment": "\u0001",
}


def timestamp_text(value: Column) -> Column:
    """A timestamp with its fraction only where there is one, in six digits."""
    return F.regexp_replace(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")


def float_text(value: Column) -> Column:
    """The shortest text of a float, in plain digits from 0.0001 up to 10^16."""
    text = value.cast("string")
    size = F.abs(value)
    wide = F.regexp_replace(value.cast("decimal(38,10)").cast("string"), r"0+$", "")
    wide = F.when(wide.endswith("."), F.concat(wide, F.lit("0"))).otherwise(wide)
    exponent = F.regexp_extract(text, r"E(-?)(\d+)$", 2)
    scientific = F.concat(
        F.regexp_replace(F.regexp_extract(text, r"^(.*)E", 1), r"\.0$", ""),
        F.when(F.regexp_extract(text, r"E(-?)", 1) == "-", "e-").otherwise("e+"),
        F.lpad(exponent, F.greatest(F.length(exponent), F.lit(2)), F.lit("0")),
    )
    return (
        F.when(F.isnan(value), "nan")
        .when(text.isin("Infinity", "-Infinity"), F.replace(F.lower(text), F.lit("infinity"), F.lit("inf")))
        .when(~text.contains("E"), text)
        .when((size >= 1e7) & (size < 1e16), wide)
        .when((size >= 1e-4) & (size < 1e-3), _small_text(text))
        .otherwise(scientific)
    )


def _small_text(text: Column) -> Column:
    """``d.dddE-4`` in plain digits."""
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?(.*)E", 1), r"\.0$", "")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    return F.concat(sign, F.lit("0.000"), F.replace(digits, F.lit("."), F.lit("")))


def as_text(rows: DataFrame) -> DataFrame:
    """Columns in the form in which they are written."""

    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            return timestamp_text(value).alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return float_text(value).alias(field.name)
        if isinstance(field.dataType, T.FloatType):
            # the exact value, as a double
            return float_text(value.cast("double")).alias(field.name)
        if isinstance(field.dataType, T.BooleanType):
            return F.when(value, "True").when(~value, "False").alias(field.name)
        return value

    return rows.select(*[column(f) for f in rows.schema.fields])


def write_delimited(rows: DataFrame, path: str, single_file: bool = False, keep: int = 1) -> str:
    """Write a run of files, each with a header, and point ``path`` at it; return its folder.

    The new run is complete, described and compared with its description before
    the pointer moves in one step, so a reader who asks ``current_export`` gets
    a whole export whatever fails.  Of earlier runs the last ``keep`` stay, for
    readers that are at them.  ``single_file`` puts all rows in one file through
    one task; leave it off for large exports.
    """
    text = as_text(rows)
    if single_file:
        text = text.repartition(1)
    spark, path = rows.sparkSession, path.rstrip("/")
    run = f"{path}/run-{uuid.uuid4().hex}"
    written = Observation()
    text.observe(written, F.count(F.lit(1)).alias("rows")).write.options(**OPTIONS).csv(run)
    parts = describe_parts(spark, run)
    manifest = {"columns": text.columns, "rows": written.get["rows"], "parts": parts}
    files.write_text(spark, f"{run}/{MANIFEST}", json.dumps(manifest, indent=1))
    verify_export(spark, run)
    files.point(spark, path, run)
    _prune(spark, path, run, keep)
    return run


def describe_parts(spark: SparkSession, run: str) -> dict[str, dict]:
    """Size, lines and a checksum of each file of a run.

    The checksum does not depend on the order of lines, so that Spark can read a large file in pieces.
    """
    fs, folder = files.file_system(spark, run)
    sizes = {s.getPath().getName(): s.getLen() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")}
    if not sizes:
        return {}
    lines = spark.read.text([f"{run}/{name}" for name in sizes], lineSep="\n").select(F.col("_metadata.file_name").alias("name"), "value")
    sums = (F.count(F.lit(1)).alias("lines"), F.bit_xor(F.xxhash64("value")).alias("xor"), F.sum(F.pmod(F.xxhash64("value"), F.lit(1 << 31))).alias("sum"))
    seen = {r["name"]: r for r in lines.groupBy("name").agg(*sums).collect()}
    none = {"lines": 0, "xor": 0, "sum": 0}
    return {
        name: {"bytes": size, "lines": (seen.get(name) or none)["lines"], "checksum": [(seen.get(name) or none)[k] for k in ("xor", "sum")]}
        for name, size in sorted(sizes.items())
    }


def verify_export(spark: SparkSession, run: str) -> dict:
    """The manifest of a run, whose files have to be the ones that it lists."""
    manifest = json.loads(files.read_text(spark, f"{run}/{MANIFEST}"))
    if describe_parts(spark, run) != manifest["parts"]:
        raise ExportError(f"{run} does not hold the files of its manifest")
    # a row may span lines, but never less than one, and each file has a header
    if sum(p["lines"] - 1 for p in manifest["parts"].values()) < manifest["rows"]:
        raise ExportError(f"{run} lacks rows")
    return manifest


def current_export(spark: SparkSession, path: str) -> str:
    """The folder of the run that counts."""
    run = files.pointed_at(spark, path.rstrip("/"))
    if run is None:
        raise KeyError(f"nothing has been exported to {path}")
    return run


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an export, all columns as text."""
    run = current_export(spark, path)
    columns = json.loads(files.read_text(spark, f"{run}/{MANIFEST}"))["columns"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).options(**OPTIONS, multiLine=True).csv(f"{run}/part-*")


def _prune(spark: SparkSession, path: str, current: str, keep: int) -> None:
    fs, folder = files.file_system(spark, path)
    runs = [s for s in fs.listStatus(folder) if s.getPath().getName().startswith("run-")]
    old = [s for s in runs if s.getPath().getName() != current.rsplit("/", 1)[1]]
    old.sort(key=lambda s: s.getModificationTime(), reverse=True)
    for status in old[keep:]:
        fs.delete(status.getPath(), True)
