"""Comparison of keys and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardloom.functions.scalars import as_column


def match_key(key: Column | str) -> Column:
    """The form in which patient keys are compared: without case or trailing spaces."""
    return F.upper(F.rtrim(as_column(key)))


def match_text(text: Column | str, ignore_case: bool = True) -> Column:
    """The form in which codes are compared: without trailing spaces, and without case unless that counts."""
    text = F.rtrim(as_column(text))
    return F.upper(text) if ignore_case else text


def normalise_id(value: Column | str) -> Column:
    """An encounter id without its spaces and colons."""
    return F.translate(as_column(value), " :", "")
