"""Target tables that are replaced whole, and the registry that only grows."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from wardloom.sinks import files

VERSIONS, PARTS = "versions", "parts"

#: the column by which a table is laid out, and the file that says how
PATIENT, LAYOUT = "_patient", "_LAYOUT.json"
BUCKET_FILE = re.compile(r"_(\d+)(?:\..*)?$")
#: buckets are read one per task unless the largest is so many times the mean, and not small anyway
UNEVEN, SMALL_BUCKET = 5, 32 << 20


class ConflictError(RuntimeError):
    """Someone else has added to a table since it was read."""


def _table_name(path: str) -> str:
    """The name under which the session knows a run that is laid out by patient."""
    return f"wardloom_{path.rsplit('/', 1)[-1]}"


class TargetStore:
    """Target tables under one folder of a file system Spark can reach.

    Every refresh writes a new folder ``<root>/<table>/<run>``.  Once it has
    been checked, ``<root>/<table>/CURRENT`` is pointed at it, so a reader
    sees the old table or the new one and a failed run changes nothing.

    A table that only grows has its rows in ``parts`` and, for each version, a
    file in ``versions`` that lists the parts.  A version can be created only
    once, so of two writers who have read the same one, one gets a
    ``ConflictError`` and has to look at the table again.

    Tables may be laid out by patient: their files are buckets of a column with
    the key as it is compared, so that two of them join without a shuffle.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """``buckets`` of tables laid out by patient: as many as a shuffle has partitions, unless given."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _file_system(self, path: str):
        return files.file_system(self.spark, path)

    def path(self, table: str) -> str | None:
        """The folder that holds the published table."""
        return files.pointed_at(self.spark, f"{self.root}/{table}")

    def __contains__(self, table: str) -> bool:
        return self.path(table) is not None

    def _published(self, table: str) -> str:
        path = self.path(table)
        if path is None:
            raise KeyError(f"target table {table!r} has not been refreshed")
        return path

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self._published(table)).drop(PATIENT)

    def read_by_patient(self, table: str) -> DataFrame:
        """The table with ``PATIENT``, the key as it is compared, and without a shuffle by it where that is as well.

        One task reads a bucket, so if one of them is far larger than the others the files are read as they come, and a
        join splits the hot key.
        """
        path = self._published(table)
        layout = json.loads(files.read_text(self.spark, f"{path}/{LAYOUT}"))
        if not layout["even"]:
            return self.spark.read.parquet(path)
        name = _table_name(path)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} ({layout['columns']}) USING parquet CLUSTERED BY ({PATIENT})"
                f" SORTED BY ({PATIENT}) INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(name)

    def replace(
        self,
        table: str,
        rows: DataFrame,
        check: Callable[[DataFrame], None] | None = None,
        order: Sequence[str] = (),
        patient: Column | None = None,
    ) -> DataFrame:
        """Write, check, publish; return the published table.

        ``order`` sorts the rows of each file, not the table as a whole.  With
        ``patient``, the key as it is compared, the table is laid out by it.
        """
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        if patient is not None:
            self._write_by_patient(rows, path, order, patient)
        else:
            if order:
                rows = rows.sortWithinPartitions(*order)
            rows.write.parquet(path)
        written = self.spark.read.parquet(path).drop(PATIENT)
        if check:
            check(written)
        files.point(self.spark, f"{self.root}/{table}", path)
        return written

    def _write_by_patient(self, rows: DataFrame, path: str, order: Sequence[str], patient: Column) -> None:
        # rebalancing brings the rows of a bucket together, and splits what is too much for one task
        laid = rows.withColumn(PATIENT, patient).hint("rebalance", PATIENT)
        writer = laid.write.format("parquet").bucketBy(self.buckets, PATIENT).sortBy(PATIENT, *order)
        writer.option("path", path).saveAsTable(_table_name(path))
        fs, folder = self._file_system(path)
        sizes = [0] * self.buckets
        for status in fs.listStatus(folder):
            if bucket := BUCKET_FILE.search(status.getPath().getName()):
                sizes[int(bucket[1])] += status.getLen()
        even = max(sizes) <= max(UNEVEN * sum(sizes) // self.buckets, SMALL_BUCKET)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in laid.schema.fields)
        layout = {"buckets": self.buckets, "columns": columns, "even": even}
        files.write_text(self.spark, f"{path}/{LAYOUT}", json.dumps(layout))

    def prune(self, table: str, keep: int = 1) -> None:
        """Delete runs that are no longer published, but for the latest ``keep`` of them.

        Readers that started on an earlier run may still need it.
        """
        current = self.path(table)
        fs, folder = self._file_system(f"{self.root}/{table}")
        runs = [s for s in fs.listStatus(folder) if s.isDirectory()]
        old = [s for s in runs if current is None or s.getPath().getName() != current.rsplit("/", 1)[1]]
        old.sort(key=lambda s: s.getModificationTime(), reverse=True)
        for status in old[keep:]:
            self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(status.getPath().getName())}")
            fs.delete(status.getPath(), True)

    def version(self, table: str) -> int:
        """The number of times rows have been added to a table that only grows."""
        fs, folder = self._file_system(f"{self.root}/{table}/{VERSIONS}")
        if not fs.exists(folder):
            return 0
        return max((int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()), default=0)

    def _parts(self, table: str, version: int) -> list[str]:
        if version == 0:
            return []
        return json.loads(files.read_text(self.spark, f"{self.root}/{table}/{VERSIONS}/{version:012d}"))

    def append(self, table: str, rows: DataFrame, read: int | None = None) -> int:
        """Add rows to a table that is never replaced; return its new version.

        ``read`` is the version that the rows were made from.  If there is a
        later one by now, nothing is added and ``ConflictError`` is raised.
        Without it the rows are added to whatever is there.
        """
        part = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/{table}/{PARTS}/{part}")
        while True:
            last = self.version(table) if read is None else read
            listed = json.dumps([*self._parts(table, last), part])
            if files.create_once(self.spark, f"{self.root}/{table}/{VERSIONS}/{last + 1:012d}", listed):
                return last + 1
            if read is not None:
                raise ConflictError(f"{table} has a later version than {read}")

    def read_appended(self, table: str, schema: str, version: int | None = None) -> DataFrame:
        """The table as of a version, the last one unless given."""
        parts = self._parts(table, self.version(table) if version is None else version)
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/{PARTS}/{p}" for p in parts])
