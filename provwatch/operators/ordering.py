"""Sorts, limits and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions.categories import order_index

_PLACEMENT = {
    ("asc", "last"): lambda c: c.asc_nulls_last(),
    ("asc", "first"): lambda c: c.asc_nulls_first(),
    ("desc", "last"): lambda c: c.desc_nulls_last(),
    ("desc", "first"): lambda c: c.desc_nulls_first(),
}


def sort_column(name: str, direction: str = "asc", nulls: str | None = None) -> Column:
    """Sort key. Unless stated, NULL counts as the largest value (last ascending, first descending)."""
    placement = nulls or ("last" if direction == "asc" else "first")
    return _PLACEMENT[direction, placement](F.col(name))


def nulls_last(name: str, direction: str = "desc") -> Column:
    return sort_column(name, direction, "last")


def order(df: DataFrame, keys: Sequence[tuple]) -> DataFrame:
    return df.orderBy(*[sort_column(*key) for key in keys])


def top_k(df: DataFrame, keys: Sequence[tuple], n: int) -> DataFrame:
    """First ``n`` rows of an order; each task keeps only its own ``n`` candidates."""
    return order(df, keys).limit(n)


def limit(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """Any ``n`` rows, made repeatable by ordering on ``keys``."""
    return top_k(df, [(key,) for key in keys], n)


def order_by_category(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Sort by a custom label order; rows with other labels are left out."""
    position = order_index(F.col(column), labels)
    return df.filter(F.col(column).isin(*labels)).orderBy(position)
