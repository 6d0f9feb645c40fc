"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCORE_SUFFIX = "_ews"
UNIT_SUFFIX = "_units"


def find_measures(columns: Sequence[str]) -> list[str]:
    """Measures of a wide observation table: columns that also have a score column.

    The score column is the measure's name with ``_ews`` in any case.
    """
    prefixes = [c[: -len(SCORE_SUFFIX)] for c in columns if c.lower().endswith(SCORE_SUFFIX)]
    return [p for p in prefixes if p in columns]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unpivot_measures(
    rows: DataFrame, keep: Sequence[str], measures: Sequence[str], name: str, value: str, unit: str
) -> DataFrame:
    """One row per measure that has a value: its name, value and unit as text.

    One pass over the rows, whatever the number of measures.  A measure
    without a unit column is an error.
    """
    if not measures:
        empty = [F.lit(None).cast("string").alias(c) for c in (name, value, unit)]
        return rows.select(*keep, *empty).limit(0)
    triples = chain.from_iterable(
        (F.lit(m), F.col(_quoted(m)).cast("string"), F.col(_quoted(m + UNIT_SUFFIX)).cast("string"))
        for m in measures
    )
    stacked = F.stack(F.lit(len(measures)), *triples).alias(name, value, unit)
    return rows.select(*keep, stacked).filter(F.col(value).isNotNull())
