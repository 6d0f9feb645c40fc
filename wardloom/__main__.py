"""Command line: ``python -m wardloom {check,refresh,export,views}``."""

from __future__ import annotations

import argparse
import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import SparkSession

from wardloom.params import Params
from wardloom.plans.exports import EXPORTS
from wardloom.plans.extracts import EXTRACTS
from wardloom.plans.run import STAGED, export_all, refresh_all
from wardloom.plans.views import VIEWS, publish_views
from wardloom.session import build_session
from wardloom.sinks.targets import TargetStore
from wardloom.sources.catalog import Catalog
from wardloom.sources.legacy_tables import LEGACY_SCHEMAS, legacy_schema
from wardloom.sources.lookup import read_code_list
from wardloom.sources.tables import SOURCE_TABLES, missing_columns


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wardloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=text)
        command.add_argument("--cutoff", type=datetime.fromisoformat)
        command.add_argument("--provenance")
        command.add_argument("--at-once", type=int, default=1, help="jobs to run side by side")
        return command

    for name, text in (
        ("check", "list source columns that are missing"),
        ("refresh", "replace target tables"),
    ):
        command = add(name, text)
        source = command.add_mutually_exclusive_group(required=True)
        source.add_argument("--parquet", help="folder with one parquet folder per source table")
        source.add_argument("--metastore", help="JSON file: logical name -> table")
        source.add_argument("--jdbc", help="JSON file: url, connection options, tables with read options")
        command.add_argument("--code-list", help="CSV with ICD10 and Risk_Factor")
        command.add_argument("--store", help="folder of the target tables", required=name == "refresh")
        command.add_argument("--study-start", type=datetime.fromisoformat)
        command.add_argument("--as-of", type=datetime.fromisoformat)
        command.add_argument("--salt-file", help="file with the secret salt of the registry")
        command.add_argument("--prune", action="store_true", help="delete runs before the previous one")
        command.add_argument("--tables", nargs="*", choices=list(EXTRACTS))

    command = add("views", "write the views over the older tables")
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--parquet", help="folder with one parquet folder per older table")
    source.add_argument("--metastore", help="JSON file: logical name -> table")
    command.add_argument("--out", required=True, help="folder for one parquet folder per view")
    command.add_argument("--names", nargs="*", choices=list(VIEWS))

    command = add("export", "write export files")
    command.add_argument("--store", required=True)
    command.add_argument("--out", required=True)
    command.add_argument("--names", nargs="*", choices=list(EXPORTS))
    command.add_argument("--single-file", action="store_true")
    return parser


def _catalog(spark: SparkSession, args: argparse.Namespace) -> Catalog:
    if args.parquet:
        catalog = Catalog.from_parquet(spark, args.parquet, [t for t in SOURCE_TABLES if t != "risk_factor_codes"])
    elif args.metastore:
        catalog = Catalog.from_metastore(spark, json.loads(Path(args.metastore).read_text()))
    else:
        settings = json.loads(Path(args.jdbc).read_text())
        catalog = Catalog.from_jdbc(
            spark, settings["url"], settings["tables"], **settings.get("connection", {})
        )
    if args.code_list:
        catalog = catalog.with_tables(risk_factor_codes=lambda: read_code_list(spark, args.code_list))
    return catalog


def _legacy_catalog(spark: SparkSession, args: argparse.Namespace) -> Catalog:
    """The older tables; those that a column is missing from are an error."""
    if args.parquet:
        catalog = Catalog.from_parquet(spark, args.parquet, list(LEGACY_SCHEMAS))
    else:
        catalog = Catalog.from_metastore(spark, json.loads(Path(args.metastore).read_text()))
    for name in LEGACY_SCHEMAS:
        if name in catalog and (lacking := set(legacy_schema(name).names) - set(catalog[name].columns)):
            raise ValueError(f"{name} lacks {', '.join(sorted(lacking))}")
    return catalog


def _params(args: argparse.Namespace) -> Params:
    given = {
        name: value
        for name in ("study_start", "cutoff", "as_of", "provenance")
        if (value := getattr(args, name, None)) is not None
    }
    if getattr(args, "salt_file", None):
        given["salt"] = Path(args.salt_file).read_text().strip()
    return Params(**given)


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session()
    params = _params(args)
    if args.command == "views":
        catalog = _legacy_catalog(spark, args)
        for name in publish_views(catalog, params):
            if args.names is None or name in args.names:
                spark.table(name).write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    elif args.command == "check":
        for table, columns in missing_columns(_catalog(spark, args)).items():
            print(f"{table}: {', '.join(columns)}")
    elif args.command == "refresh":
        store = TargetStore(spark, args.store)
        refresh_all(_catalog(spark, args), store, params, args.tables, args.at_once)
        if args.prune:
            for table in (t for t in [*EXTRACTS, *STAGED] if t in store):
                store.prune(table)
    else:
        store = TargetStore(spark, args.store)
        export_all(store, args.out, params, args.names, args.single_file, args.at_once)


if __name__ == "__main__":
    main()
