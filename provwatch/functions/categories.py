"""CASE ladders and code tables."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {">=": operator.ge, ">": operator.gt, "<": operator.lt, "<=": operator.le}


def ladder(steps: Sequence[tuple[Column, object]], default: object) -> Column:
    """First condition that holds decides; NULL conditions fall through to the default."""
    column = None
    for condition, label in steps:
        column = F.when(condition, label) if column is None else column.when(condition, label)
    return F.lit(default) if column is None else column.otherwise(default)


def tier(value: Column, steps: Sequence[tuple[int, str]], default: str, compare: str = ">=") -> Column:
    test = _COMPARE[compare]
    return ladder([(test(value, F.lit(bound)), label) for bound, label in steps], default)


def code_lookup(code: Column, table: Mapping[str, str], default: str) -> Column:
    return ladder([(code == key, text) for key, text in table.items()], default)


def order_index(value: Column, labels: Sequence[str]) -> Column:
    """Position of a label in a custom category order, NULL for labels that are not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(label) for label in labels]), value), F.lit(0))
