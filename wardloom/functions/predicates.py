"""Row filters shared by the jobs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardloom.functions.keys import match_text
from wardloom.functions.scalars import as_column


def timestamp(value: datetime) -> Column:
    """A wall-clock literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def after(value: Column | str, start: datetime) -> Column:
    return as_column(value) > timestamp(start)


def from_start(value: Column | str, start: datetime) -> Column:
    return as_column(value) >= timestamp(start)


def wall_clock(time_zone: str) -> Column:
    """The time of the query on a clock in ``time_zone``, whatever the session's own zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit(time_zone), F.localtimestamp())


def until(value: Column | str, end: datetime | None, time_zone: str = "UTC") -> Column:
    """Strictly before ``end``, or before the time of the query in ``time_zone`` when that is not given."""
    limit = wall_clock(time_zone) if end is None else timestamp(end)
    return as_column(value) < limit


def one_of(value: Column | str, codes: Iterable[str]) -> Column:
    """Whether a code is one of ``codes``, trailing spaces and case aside."""
    return match_text(value).isin([code.rstrip(" ").upper() for code in codes])


def within_cutoff(value: Column | str, cutoff: datetime) -> Column:
    """Not after the cut-off; a missing date passes."""
    value = as_column(value)
    return value.isNull() | (value <= timestamp(cutoff))


def n_or_null(flag: Column | str) -> Column:
    return one_of(flag, ["N"]) | as_column(flag).isNull()
