"""Join shapes the jobs are made of.

No join carries a broadcast hint.  Spark broadcasts a side when its estimated
or measured size is under the session's threshold and shuffles both sides
otherwise, where a hot key is split at run time (``session.SETTINGS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardloom.functions.keys import match_key, match_text

COHORT_KEY = "UHL_System_Number"


def in_cohort(rows: DataFrame, key: Column | str, cohort: DataFrame) -> DataFrame:
    """Rows whose patient is in the cohort; repeats in the cohort do not multiply rows."""
    return semi_on_key(rows, key, cohort, COHORT_KEY)


def semi_on_key(rows: DataFrame, key: Column | str, members: DataFrame, member: str) -> DataFrame:
    members = members.select(match_key(member).alias("_member"))
    return rows.join(members, match_key(key) == F.col("_member"), "left_semi")


def missing_on_key(rows: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose key is not among the known ones, which are never NULL."""
    known = known.select(match_key(known_key).alias("_known"))
    return rows.join(known, match_key(key) == F.col("_known"), "left_anti")


def current(dimension: DataFrame) -> DataFrame:
    """The rows of a master file that have not been deleted.

    Filtering before the join keeps a fact row with a deleted code under a
    left join and drops it under an inner join.
    """
    return dimension.filter(F.col("LOGICALLY_DELETED_FLAG") == 0)


def _same_code(rows: DataFrame, on: str, looked_up: DataFrame) -> Column:
    """Texts are compared as codes are, without trailing spaces and case; numbers as they are."""
    texts = all(isinstance(df.schema[c].dataType, T.StringType) for df, c in ((rows, on), (looked_up, "_code")))
    return match_text(on) == match_text("_code") if texts else F.col(on) == F.col("_code")


def left_lookup(
    rows: DataFrame, dimension: DataFrame, on: str, code: str, **outputs: str
) -> DataFrame:
    """Left join ``rows.on`` to ``dimension.code``; ``outputs`` maps new column -> dimension column.

    Without outputs the join still repeats a row for every match.
    """
    looked_up = dimension.select(
        F.col(code).alias("_code"), *[F.col(c).alias(name) for name, c in outputs.items()]
    )
    return rows.join(looked_up, _same_code(rows, on, looked_up), "left").drop("_code")


def inner_lookup(
    rows: DataFrame, dimension: DataFrame, on: str, code: str, **outputs: str
) -> DataFrame:
    """As ``left_lookup``, dropping rows without a match."""
    looked_up = dimension.select(
        F.col(code).alias("_code"), *[F.col(c).alias(name) for name, c in outputs.items()]
    )
    return rows.join(looked_up, _same_code(rows, on, looked_up)).drop("_code")
