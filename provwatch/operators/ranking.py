"""Exact percent ranks and medians without gathering a group in one task.

A window ordered over a whole group sorts that group in a single task, which fails when one group holds a third of
all rows. Here ranks come from counts instead:

1. rows are counted per (measure, group, value), so equal values collapse before the shuffle;
2. the counts are cut into ranges of (measure, group, value) by the values that are there, and written with the
   number of their range; a group of any distribution is spread over as many ranges as it needs;
3. counts accumulate inside each (range, group), and the totals of these parts, at most one per range and group,
   accumulate over the group.

The sum of both is the number of smaller rows in the group, from which rank and median follow. Values are compared as
they are: decimals and integers as decimals wide enough for all measures, or doubles if one of them is a double.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.sources.sinks import work_folder, write_table

_HOT_SHARE = 1000
_VALUE, _METRIC, _RANGE = "__value", "__metric", "__range"


def _common_type(df: DataFrame, measures: Sequence[str]) -> T.DataType:
    """A type that holds every measure without rounding."""
    kinds = [df.schema[m].dataType for m in measures]
    if any(isinstance(k, (T.DoubleType, T.FloatType, T.StringType)) for k in kinds):
        return T.DoubleType()
    return T.DecimalType(38, max((k.scale for k in kinds if isinstance(k, T.DecimalType)), default=0))


def _group_keys(groups: Sequence[str]) -> list[str]:
    return [f"__group{i}" for i in range(len(groups))]


def _long_form(df: DataFrame, carried: Sequence[str], groups: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per input row and measure.

    Group columns become text keys that are never NULL, since NULLs form a group but do not join.
    """
    keys = [
        F.when(F.col(g).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(g).cast("string"))).alias(k)
        for g, k in zip(groups, _group_keys(groups))
    ]
    kind = _common_type(df, measures)
    entries = [F.struct(F.lit(i).alias(_METRIC), F.col(m).cast(kind).alias(_VALUE)) for i, m in enumerate(measures)]
    return df.select(*carried, *keys, F.inline(F.array(*entries)))


def cumulative_cells(rows: DataFrame, keys: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, value): its count ``__n``, ``__below`` smaller rows and ``__size`` rows in the whole group.

    ``carried`` columns depend on the keys. The rows are read once; what follows reads two written tables of counts.
    """
    folder = work_folder(rows.sparkSession, "ranks")
    counts = write_table(rows.groupBy(*keys, *carried, _VALUE).agg(F.count("*").alias("__n")), f"{folder}/counts")
    ranged = counts.repartitionByRange(*keys, _VALUE).withColumn(_RANGE, F.spark_partition_id())
    ranged = write_table(ranged, f"{folder}/ranges")
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(_RANGE, *keys).orderBy(_VALUE).rowsBetween(*earlier)
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(*earlier)
    parts = (
        ranged.groupBy(*keys, _RANGE)
        .agg(F.sum("__n").alias("__part_n"))
        .withColumn("__before", F.coalesce(F.sum("__part_n").over(before), F.lit(0)))
        .withColumn("__size", F.sum("__part_n").over(Window.partitionBy(*keys)))
        .drop("__part_n")
    )
    return (
        ranged.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
        .join(parts, [*keys, _RANGE])
        .withColumn("__below", F.col("__before") + F.col("__inside"))
        .drop(_RANGE, "__before", "__inside")
    )


def _lookup_by_value(rows: DataFrame, cells: DataFrame, keys: Sequence[str], answer: str, spread: str) -> DataFrame:
    """Give each row the answer of its cell (by keys and value), with hot cells shared by several tasks.

    A cell with at least one row in a thousand is hot; there can be no more than a thousand of them, which
    bounds the broadcast that tells rows of hot cells in how many parts their cell is split. The cell
    itself is repeated once per part. All other rows and cells have the single part 0.
    """
    names = [*keys, _VALUE]
    total = cells.agg(F.sum("__n")).scalar()
    parts = (F.floor(F.col("__n") * F.lit(_HOT_SHARE) / total) + F.lit(1)).cast("int")
    hot = cells.filter(F.col("__n") * F.lit(_HOT_SHARE) >= total).select(*names, parts.alias("__parts"))
    routed = rows.join(F.broadcast(hot), names, "left").withColumn(
        "__part", F.pmod(F.xxhash64(spread), F.coalesce(F.col("__parts"), F.lit(1))).cast("int")
    )
    copies = cells.select(*names, answer, F.explode(F.sequence(F.lit(0), parts - F.lit(1))).alias("__part"))
    return routed.join(copies, [*names, "__part"], "left").drop("__parts", "__part")


def percentile_ranks(df: DataFrame, key: str, groups: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """``percent_rank * 100`` of several measures inside each group, one row per ``key``.

    ``measures`` maps output names to columns without NULLs. The input is read twice: once to count its values, once to
    give each row its rank.
    """
    rows = _long_form(df, [key], groups, list(measures.values()))
    keys = [_METRIC, *_group_keys(groups)]
    percent = F.when(
        F.col("__size") > 1,
        F.col("__below").cast("double") / (F.col("__size") - 1).cast("double") * F.lit(100.0),
    ).otherwise(F.lit(0.0))
    cells = cumulative_cells(rows, keys).select(*keys, _VALUE, "__n", percent.alias("__percent"))
    cells = write_table(cells, f"{work_folder(df.sparkSession, 'ranks')}/cells")
    ranked = _lookup_by_value(rows, cells, keys, "__percent", key)
    return ranked.groupBy(key).agg(
        *[F.max(F.when(F.col(_METRIC) == i, F.col("__percent"))).alias(name) for i, name in enumerate(measures)]
    )


def exact_medians(df: DataFrame, groups: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Exact medians of several measures per group, as doubles; NULL values are left out."""
    rows = _long_form(df, groups, groups, list(measures.values())).filter(F.col(_VALUE).isNotNull())
    keys = [_METRIC, *groups, *_group_keys(groups)]
    cells = cumulative_cells(rows, [_METRIC, *_group_keys(groups)], carried=groups)
    reached = F.col("__below") + F.col("__n")
    lower = F.floor((F.col("__size") + 1) / 2)
    upper = F.floor((F.col("__size") + 2) / 2)
    middles = cells.groupBy(*keys).agg(
        F.min(F.when(reached >= lower, F.col(_VALUE))).alias("__low"),
        F.min(F.when(reached >= upper, F.col(_VALUE))).alias("__high"),
    )
    median = (F.col("__low") + F.col("__high")).cast("double") / F.lit(2.0)
    return middles.groupBy(*groups).agg(
        *[F.max(F.when(F.col(_METRIC) == i, median)).alias(name) for i, name in enumerate(measures)]
    )
