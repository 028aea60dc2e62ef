"""Exact distinct counts that can be rolled up.

Values get numbers without gaps; the numbers of a group become bitmaps of 4 KB for each 32,768 numbers that it touches. A
group's count is the sum of its bits, and coarser groups are the union of finer ones' bitmaps, without another look at
the rows. A group of any size is spread over as many tasks as it has bitmaps. Worth it for groups of many values: a
group of one value costs a whole bitmap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.operators.scans import numbered

_NUMBER = "__number"


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], column: str, path: str) -> DataFrame:
    """Rows (keys, BUCKET, IDS) with the bitmaps of each group's values; the values' numbers are written to ``path``.

    Null keys are groups, too. Null values are not counted, but a group of nothing else stays, with an empty bitmap.
    """
    pairs = df.select(*keys, column).distinct()
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    numbers = numbered(values, [F.col(column)], path, _NUMBER)
    placed = pairs.join(numbers, column, "left")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(_NUMBER))
    return placed.groupBy(*keys, F.bitmap_bucket_number(_NUMBER).alias("BUCKET")).agg(bits.alias("IDS"))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct values per group, by some or all (or none) of the keys that the bitmaps were made for."""
    united = bitmaps.groupBy(*keys, "BUCKET").agg(F.bitmap_or_agg("IDS").alias("IDS"))
    return united.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("IDS")), F.lit(0)).cast("long").alias(name))
