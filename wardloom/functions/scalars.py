"""Scalar building blocks of the jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: what counts as a plain number (fixed value): no exponent, no separators
PLAIN_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"
RANGE_TYPE = "decimal(18,5)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_of(data_type: str) -> Column:
    """A typed NULL placeholder."""
    return F.lit(None).cast(data_type)


def as_timestamp(rows: DataFrame, column: str) -> Column:
    """A date column as a timestamp; text is read as YYYYMMDD."""
    if dict(rows.dtypes)[column] == "string":
        return F.to_timestamp_ntz(column, F.lit("yyyyMMdd"))
    return F.col(column).cast("timestamp_ntz")


def recode(value: Column | str, codes: Mapping[str, str], default: str) -> Column:
    """Replace a code, compared as codes are; NULL and unlisted codes become ``default``."""
    value = F.upper(F.rtrim(as_column(value)))
    result = None
    for code, meaning in codes.items():
        condition = value == F.lit(code.rstrip(" ").upper())
        result = F.when(condition, meaning) if result is None else result.when(condition, meaning)
    return F.lit(default) if result is None else result.otherwise(default)


def plain_decimal(text: Column | str) -> Column:
    """Text as DECIMAL(18,5) where it is a plain number, else NULL; a number too large for that raises."""
    text = as_column(text)
    return F.when(text.rlike(PLAIN_NUMBER), F.trim(text).cast(RANGE_TYPE))


def parse_reference_range(text: Column | str) -> tuple[Column, Column]:
    """Lower and upper bound of ``lower{upper``; NULL where a side is not a number."""
    text = as_column(text)
    split_at = F.instr(text, "{")
    lower = F.substring(text, F.lit(1), split_at - 1)
    upper = F.substring(text, split_at + 1, F.length(text))
    found = split_at > 0
    return F.when(found, plain_decimal(lower)), F.when(found, plain_decimal(upper))


def hhmm_to_timestamp(day: Column | str, hhmm: Column | str) -> Column:
    """A day plus a clock time written HHMM; blank parts count as zero, NULL stays NULL."""
    hhmm = as_column(hhmm)

    def part(start: int) -> Column:
        digits = F.trim(F.substring(hhmm, start, 2))
        return F.when(digits == "", F.lit(0)).otherwise(digits.cast("int"))

    start_of_day = as_column(day).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", part(3), F.timestamp_add("HOUR", part(1), start_of_day))


def age_at(born: Column | str, on: Column | str) -> Column:
    """Completed years; somebody born on 29 February ages on 1 March in a common year."""
    born, on = as_column(born), as_column(on)

    def month_day(c: Column) -> Column:
        return F.month(c) * 100 + F.dayofmonth(c)

    return F.year(on) - F.year(born) - (month_day(on) < month_day(born)).cast("int")


def outcode_live(postcode: Column | str) -> Column:
    """The postcode up to and including its first space.

    No space gives an empty text, and a missing postcode a single space.
    """
    text = F.coalesce(as_column(postcode), F.lit(" "))
    return F.substring(text, F.lit(1), F.instr(text, " "))


def has_short_outcode(postcode: Column | str) -> Column:
    """Whether the first space comes before the fifth character (or not at all)."""
    return F.instr(F.coalesce(as_column(postcode), F.lit("")), " ") < 5


def outcode_legacy(postcode: Column | str) -> Column:
    """The postcode before its first space, or an empty text if that is over four bytes."""
    head = F.substring_index(F.coalesce(as_column(postcode), F.lit("")), " ", 1)
    return F.when(F.octet_length(head) < 5, head).otherwise("")


def clean_quantity(text: Column | str) -> Column:
    """A quantity description without asterisks and outer spaces."""
    return F.trim(F.replace(as_column(text), F.lit("*"), F.lit("")))


def blank_if_null(value: Column | str) -> Column:
    """Any value as text, NULL as an empty text."""
    return F.coalesce(as_column(value).cast("string"), F.lit(""))


def contains_text(value: Column | str, text: str, ignore_case: bool) -> Column:
    value = as_column(value)
    pattern = f"%{text}%"
    return value.ilike(pattern) if ignore_case else value.like(pattern)
