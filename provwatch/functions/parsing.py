"""Tolerant text-to-value conversions: bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_number(text: Column, precision: int = 38, scale: int = 0) -> Column:
    """Parse a decimal; surplus fraction digits are rounded half away from zero.

    Blanks are told first: as input that is no number, each would cost an exception with its stack trace.
    """
    return F.when(text.cast("string") != "", text.try_cast(f"decimal({precision},{scale})"))


def try_money(text: Column) -> Column:
    return try_number(text, 18, 2)


def try_percent(text: Column) -> Column:
    return try_number(text, 18, 4)


def try_count(text: Column) -> Column:
    """Parse a count. It goes through a decimal first so that ``'12.7'`` gives 13 rather than NULL."""
    return try_number(text).try_cast("bigint")


def try_date(text: Column, layout: str) -> Column:
    return F.try_to_date(text, layout)


# Date layouts of the public files (fixed values).
COMPACT_DATE = "yyyyMMdd"
ISO_DATE = "yyyy-MM-dd"
US_DATE = "MM/dd/yyyy"
