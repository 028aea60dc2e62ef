"""Aggregate expressions and grouped operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(value: Column, condition: Column, otherwise: object | None = None) -> Column:
    """Conditional sum; without ``otherwise`` it is NULL if no row meets the condition."""
    picked = F.when(condition, value)
    return F.sum(picked if otherwise is None else picked.otherwise(otherwise))


def any_true(flag: Column) -> Column:
    """Whether any row has the flag set; false rather than NULL if none is known."""
    return F.coalesce(F.bool_or(flag), F.lit(False))


def mean(value: Column) -> Column:
    """Mean as a double, from an exact sum, so that it does not depend on the order of the rows."""
    return F.sum(value).cast("double") / F.count(value)


def distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def two_stage(
    df: DataFrame,
    inner_keys: Sequence[str],
    inner: Sequence[Column],
    outer_keys: Sequence[str],
    outer: Sequence[Column],
) -> DataFrame:
    """Aggregate of an aggregate: the inner step collapses hot outer keys before they meet in one task."""
    return df.groupBy(*inner_keys).agg(*inner).groupBy(*outer_keys).agg(*outer)


def group_by_bucket(df: DataFrame, name: str, bucket: Column, measures: Sequence[Column]) -> DataFrame:
    return df.groupBy(bucket.alias(name)).agg(*measures)


def rollup_summary(summary: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate a small summary again, over fewer keys."""
    return summary.groupBy(*keys).agg(*[column.alias(name) for name, column in measures.items()])


def hhi(df: DataFrame, entity: str, category: str, weight: str, name: str = "HHI") -> DataFrame:
    """Herfindahl index (0 to 10000) of ``weight`` over the categories of each entity.

    The squared shares share one denominator, so it is the sum of squares over the squared sum: both are
    plain sums, combined on the map side, and no entity's categories are ever gathered in one place.
    """
    return (
        df.groupBy(entity, category)
        .agg(F.sum(weight).alias("__weight"))
        .groupBy(entity)
        .agg(hhi_of_weights(F.col("__weight")).alias(name))
    )


def hhi_of_weights(weight: Column) -> Column:
    """Herfindahl index over rows that already hold one category each; NULL for a zero total."""
    exact = weight.cast("decimal(18,2)")
    squares = F.sum(exact * exact).cast("double")
    total = F.sum(weight).cast("double")
    return F.try_divide(squares * F.lit(10000.0), total * total)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value; empty bins are left out.

    Integers and decimals are counted in units of their own last digit, so that bin limits are exact; floating-point
    values are taken as they are. The limits come from a one-row aggregate used as a scalar subquery.
    """
    kind = df.schema[column].dataType
    digits = kind.scale if isinstance(kind, T.DecimalType) else 0
    factor = 10**digits
    floating = isinstance(kind, (T.DoubleType, T.FloatType))
    value = F.col(column).cast("double") if floating else (F.col(column) * F.lit(factor)).cast("decimal(38,0)")
    values = df.select(value.alias("__v")).filter(F.col("__v").isNotNull())
    if floating:
        values = values.filter(~F.isnan("__v"))
    limits = values.agg(F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    low, high = limits.select("lo").scalar(), limits.select("hi").scalar()
    bounded = values.select("__v", low.alias("__lo"), high.alias("__hi"))
    position = F.expr(f"cast(floor((__v - __lo) * {bins} / (__hi - __lo)) as bigint)" if floating else f"(__v - __lo) * {bins} div (__hi - __lo)")
    index = F.when(F.col("__hi") == F.col("__lo"), F.lit(1)).otherwise(
        F.least(position, F.lit(bins - 1)) + F.lit(1)
    )
    edge = (F.col("__hi") - F.col("__lo")).cast("double") / F.lit(float(bins * factor))
    start = F.col("__lo").cast("double") / F.lit(float(factor))
    return (
        bounded.groupBy(index.cast("int").alias("BIN"), "__lo", "__hi")
        .agg(F.count("*").alias("COUNT"))
        .select(
            "BIN",
            (start + (F.col("BIN") - 1) * edge).alias("BIN_START"),
            (start + F.col("BIN") * edge).alias("BIN_END"),
            "COUNT",
        )
    )
