"""Filters, constants and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions.text import present


def select_renamed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Projection given as ``{new name: source column}``."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def with_constant(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def null_as(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def filter_present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(present(F.col(column)))


def filter_true(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column))


def filter_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def _escape(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def like_any(columns: Sequence[Column], pattern: str, ignore_case: bool = False) -> Column:
    text = _escape(pattern)
    tests = [c.ilike(text) if ignore_case else c.like(text) for c in columns]
    return reduce(lambda a, b: a | b, tests)


def filter_like(
    df: DataFrame, columns: Sequence[str], pattern: str, ignore_case: bool = False
) -> DataFrame:
    """Rows in which any of the columns matches a LIKE pattern."""
    return df.filter(like_any([F.col(c) for c in columns], pattern, ignore_case))


def apply_filters(df: DataFrame, **wanted: object) -> DataFrame:
    """Add one predicate per parameter that is set; a list means membership, a scalar equality."""
    for column, value in wanted.items():
        several = isinstance(value, (list, tuple, set, frozenset))
        if value is None or (several and not value):
            continue
        if several:
            df = df.filter(F.col(column).isin(*value))
        else:
            df = df.filter(F.col(column) == value)
    return df


def having(grouped: DataFrame, condition: Column) -> DataFrame:
    return grouped.filter(condition)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns absent from a branch are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
