"""Logical table names, resolved to DataFrames on first use."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

Loader = Callable[[], DataFrame]

#: tables whose columns are discovered: a later file may bring a new measure
WIDE = ("ObsExport",)


class Catalog:
    """A read-only mapping from logical table name to DataFrame.

    Each name has its own loader, so one catalog can mix parquet folders,
    metastore tables and JDBC sources.  Nothing is read until a job asks for a
    table, and each table is resolved once.
    """

    def __init__(self, loaders: Mapping[str, Loader | DataFrame] | None = None):
        self._loaders = dict(loaders or {})
        self._loaded: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaded:
            try:
                source = self._loaders[name]
            except KeyError:
                raise KeyError(f"no table named {name!r} in the catalog") from None
            self._loaded[name] = source if isinstance(source, DataFrame) else source()
        return self._loaded[name]

    def __contains__(self, name: str) -> bool:
        return name in self._loaders

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def with_tables(self, **tables: Loader | DataFrame) -> Catalog:
        """A new catalog in which the given tables are added or replaced."""
        return Catalog({**self._loaders, **tables})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: list[str], merged: Collection[str] = WIDE) -> Catalog:
        """One parquet folder (or file) per table under ``root``.

        A folder has the columns of one of its files, but for those in ``merged``: they have the columns of all, and a
        file lacks values where it lacks a column.  A column of different types in two files is an error.
        """

        def loader(name: str) -> Loader:
            return lambda: spark.read.option("mergeSchema", name in merged).parquet(f"{root}/{name}")

        return cls({name: loader(name) for name in names})

    @classmethod
    def from_metastore(cls, spark: SparkSession, tables: Mapping[str, str]) -> Catalog:
        """Logical name -> qualified table name."""

        def loader(table: str) -> Loader:
            return lambda: spark.table(table)

        return cls({name: loader(table) for name, table in tables.items()})

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        tables: Mapping[str, Mapping[str, str]],
        **connection: str,
    ) -> Catalog:
        """Logical name -> JDBC read options.

        Without ``partitionColumn``, ``lowerBound``, ``upperBound`` and
        ``numPartitions`` one task reads the whole table, so they have to be
        given, or ``"small": "true"`` for a code list or the like.
        """
        parts = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")

        def loader(options: Mapping[str, str]) -> Loader:
            options = dict(options)
            small = str(options.pop("small", "false")).lower() == "true"
            if not small and not all(p in options for p in parts):
                raise ValueError(f"{options.get('dbtable')}: give {', '.join(parts)}, or say that the table is small")
            return lambda: (
                spark.read.format("jdbc").options(url=url, **connection).options(**options).load()
            )

        return cls({name: loader(options) for name, options in tables.items()})
