"""Positions and running totals along an order, without a task that sees all rows.

A global window gives every row of a table to one task. Here a table is cut into ranges of its order: rows are
numbered inside their range and the ranges' sizes added up, and running totals are taken inside blocks of positions
and the blocks' totals added up. What one task sees is a range, a block, or one row per range or block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 1 << 14
_PART, _BLOCK, _AT = "__part", "__block", "__at"
_BITS = 33  # monotonically_increasing_id: the partition above them, the row in it below

_FOLD = {"sum": F.sum, "max": F.max, "bit_xor": F.bit_xor}
_JOIN = {
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "max": F.greatest,
    "bit_xor": lambda a, b: F.coalesce(a, F.lit(0)).bitwiseXOR(F.coalesce(b, F.lit(0))),
}


def numbered(df: DataFrame, keys: Sequence[Column], path: str, name: str = "position") -> DataFrame:
    """``df`` with each row's place in the order of ``keys``, from 0, without gaps; written to ``path``.

    Rows of equal keys get their places in any order, but keep them, as the table is written. They are one range, so
    keys should tell hot rows apart. The table that is broadcast has a row for each range.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranges.withColumn(_AT, F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(_AT, T.LongType())])
    placed = spark.read.schema(schema).parquet(path).withColumn(_PART, F.shiftright(_AT, _BITS))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(_PART).agg(F.count("*").alias("__rows"))
    starts = sizes.select(_PART, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    place = F.col("__start") + F.col(_AT).bitwiseAND(F.lit((1 << _BITS) - 1))
    return placed.join(F.broadcast(starts), _PART).withColumn(name, place).drop(_PART, _AT, "__start")


def _block(position: str, size: int) -> Column:
    return F.expr(f"`{position}` div {size}")


def running(
    df: DataFrame,
    position: str,
    totals: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    size: int = BLOCK,
) -> DataFrame:
    """Add running totals up to and including each row, by ``position``, within ``keys`` if given.

    ``totals`` names each new column with its kind (sum, max, bit_xor) and the column it takes; nulls count for
    nothing. Positions are distinct within the keys and keys are not null. A key of any size is cut into blocks of
    ``size`` positions.
    """
    names = list(keys)
    rows = df.withColumns({_BLOCK: _block(position, size), **{f"__v_{n}": c for n, (_, c) in totals.items()}})
    inside = Window.partitionBy(*names, _BLOCK).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*names).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*names, _BLOCK).agg(*(_FOLD[kind](f"__v_{n}").alias(f"__t_{n}") for n, (kind, _) in totals.items()))
    carried = sums.select(*names, _BLOCK, *(_FOLD[kind](f"__t_{n}").over(before).alias(f"__c_{n}") for n, (kind, _) in totals.items()))
    joined = rows.join(carried, [*names, _BLOCK])
    found = {n: _JOIN[kind](F.col(f"__c_{n}"), _FOLD[kind](f"__v_{n}").over(inside)) for n, (kind, _) in totals.items()}
    return joined.withColumns(found).select(*df.columns, *totals)


def following(df: DataFrame, position: str, columns: Mapping[str, str], size: int = BLOCK) -> DataFrame:
    """Add columns of the row at the next position (``columns``: new name to column); null at the end.

    Positions are those of ``numbered``: without gaps.
    """
    rows = df.withColumn(_BLOCK, _block(position, size))
    inside = Window.partitionBy(_BLOCK).orderBy(position)
    firsts = rows.where(F.col(position) % size == 0)
    firsts = firsts.select((F.col(_BLOCK) - 1).alias(_BLOCK), *(F.col(c).alias(f"__f_{n}") for n, c in columns.items()))
    joined = rows.join(firsts, _BLOCK, "left")
    last = F.col(position) % size == size - 1
    found = {n: F.when(last, F.col(f"__f_{n}")).otherwise(F.lead(c).over(inside)) for n, c in columns.items()}
    return joined.withColumns(found).select(*df.columns, *columns)
