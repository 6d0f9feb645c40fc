"""Compare a Spark result with the oracle's, row by row and without order."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of_oracle(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(repr(r[i]) for i in order) for r in result.fetchall())


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = df.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(repr(r[i]) for i in order) for r in df.collect())


def difference(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    spark_names, spark_rows = rows_of_spark(df)
    names, rows = rows_of_oracle(con, sql)
    if spark_names != names:
        return f"columns {spark_names} against {names}"
    if spark_rows != rows:
        extra, missing = spark_rows - rows, rows - spark_rows
        return (
            f"{spark_rows.total()} rows against {rows.total()};"
            f" only in Spark {list(extra)[:2]}, only in the oracle {list(missing)[:2]}"
        )
    return None
