"""Checks on keys and lengths, each as a DataFrame of offending values."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.functions.keys import match_key


class QualityError(ValueError):
    """A table broke one of its constraints and was not published."""


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Keys found more than once, with their number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_patients(rows: DataFrame, key: str) -> DataFrame:
    """As ``duplicate_keys``, for a patient key."""
    return duplicate_keys(rows.select(match_key(key).alias(key)), key)


def null_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Number of rows without a value, per key column."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in key])
    return counts.select(
        F.stack(F.lit(len(key)), *[x for c in key for x in (F.lit(c), F.col(c))]).alias("column_name", "nulls")
    )


def over_length(rows: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Longest text per column against its limit, trailing spaces not counted."""
    longest = rows.agg(*[F.max(F.length(F.rtrim(F.col(c)))).alias(c) for c in limits])
    triples = [x for c, n in limits.items() for x in (F.lit(c), F.col(c), F.lit(n))]
    return longest.select(
        F.stack(F.lit(len(limits)), *triples).alias("column_name", "longest", "allowed")
    )


def exposes_key(rows: DataFrame, key: str, columns: Sequence[str]) -> Column:
    """Whether one of the columns to be exported holds the patient key itself."""
    types = dict(rows.dtypes)
    return reduce(
        lambda a, b: a | b,
        [F.coalesce(match_key(c) == match_key(key), F.lit(False)) for c in columns if types[c] == "string"],
        F.lit(False),
    )


def require_unique(rows: DataFrame, *key: str, table: str) -> None:
    found = duplicate_keys(rows, *key).head(1)
    if found:
        raise QualityError(f"{table}: {', '.join(key)} is not unique")


def require_unique_patients(rows: DataFrame, key: str, table: str) -> None:
    if duplicate_patients(rows, key).head(1):
        raise QualityError(f"{table}: {key} is not unique")


def require_target(
    rows: DataFrame,
    key: str,
    limits: Mapping[str, int],
    exported: Sequence[str],
    table: str,
    required: Sequence[str] = (),
) -> None:
    """Key and ``required`` columns present, and texts within their limits, in one pass.

    Rows of which an exported column equals the patient key are reported by a
    warning: identifiers of other things may coincide with it.
    """
    needed = list(dict.fromkeys([key, *required]))
    checked = rows.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{c}") for c in needed],
        F.count_if(exposes_key(rows, key, exported)).alias("_exposed"),
        *[F.max(F.length(F.rtrim(F.col(c)))).alias(c) for c in limits],
    ).first()
    for c in needed:
        if checked[f"_nulls_{c}"]:
            raise QualityError(f"{table}: {c} is missing in {checked[f'_nulls_{c}']} rows")
    if checked["_exposed"]:
        warnings.warn(f"{table}: {checked['_exposed']} rows show the patient key in an exported column", stacklevel=2)
    too_long = {c: checked[c] for c, n in limits.items() if (checked[c] or 0) > n}
    if too_long:
        raise QualityError(f"{table}: text over its limit: {too_long}")
