"""Deduplication and ranking inside groups.

All row-number filters keep a fixed number of rows per key. Spark turns such a filter into a group limit
that also runs before the shuffle, so a key that holds a large part of the table sends only a few
candidates per map task to the reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provwatch.functions.numeric import quotient
from provwatch.sources.sinks import work_folder, write_table

_RANK, _HASH = "__rank", "__key_hash"
_FEW = 1_000_000  # repeated keys up to which their hashes are broadcast
LARGE = 1_000_000  # rows from which it pays to read a table twice rather than to shuffle it
_HOT_SHARE = 1000


def rank_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, name: str = _RANK
) -> DataFrame:
    """The first ``limit`` rows of each group, numbered from 1 in column ``name``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= limit)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return rank_in_group(df, keys, order, 1).drop(_RANK)


def keep_first_of_repeated(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], large: int = LARGE
) -> DataFrame | None:
    """``keep_first`` where few keys repeat: all rows but those of repeated keys stay in their tasks, unsorted.

    ``df`` is read twice, so it should come from a written table. Keys are told apart by a 64-bit hash; two keys of one
    hash count as repeated, which sorts their rows and changes nothing else. None: ``df`` has fewer than ``large``
    rows, or more than a million repeated keys; all rows are to be dealt by their keys then.
    """
    number = F.xxhash64(*keys)
    counts = df.groupBy(number.alias(_HASH)).agg(F.count("*").alias("n"))
    counts = write_table(
        counts.groupBy((F.col("n") > 1).alias("more"), F.when(F.col("n") > 1, F.col(_HASH)).alias(_HASH)).agg(F.sum("n").alias("n")),
        work_folder(df.sparkSession, "repeated-keys"),
    )
    repeated = counts.where("more").select(_HASH)
    if (counts.agg(F.sum("n")).first()[0] or 0) < large or repeated.count() > _FEW:
        return None
    if repeated.isEmpty():
        return df
    hashed, repeated = df.withColumn(_HASH, number), F.broadcast(repeated)
    single = hashed.join(repeated, _HASH, "left_anti").drop(_HASH)
    several = hashed.join(repeated, _HASH, "left_semi").drop(_HASH)
    return single.unionByName(keep_first(several, keys, order))


def _latest_order(
    df: DataFrame, keys: Sequence[str], newest: Column, ties: Sequence[str] | None = None
) -> list[Column]:
    names = [c for c in df.columns if c not in keys] if ties is None else ties
    return [newest, *[F.col(f"`{c}`").asc_nulls_last() for c in names]]


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest: Column,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, newest first; ties go to the smallest remaining values, NULLs last."""
    return keep_first(df, keys, _latest_order(df, keys, newest, ties))


def keep_latest_of_repeated(df: DataFrame, keys: Sequence[str], newest: Column, large: int = LARGE) -> DataFrame:
    """``keep_latest`` for a large written table in which few keys repeat (``keep_first_of_repeated``)."""
    order = _latest_order(df, keys, newest)
    found = keep_first_of_repeated(df, keys, order, large)
    return keep_first(df, keys, order) if found is None else found


def keep_by_priority(
    df: DataFrame, keys: Sequence[str], priority: Column, ties: Sequence[Column]
) -> DataFrame:
    """One row per key with the lowest priority number."""
    return keep_first(df, keys, [priority.asc_nulls_last(), *ties])


def partition_total(
    df: DataFrame, keys: Sequence[str], measure: str, name: str, spread: Sequence[str]
) -> DataFrame:
    """Add the total of a measure over the row's group.

    A window would gather each group in one task; the total is aggregated and joined back instead. A group with at
    least one row in a thousand is joined in as many parts as it has thousandths; there are at most a thousand such
    groups, which bounds the broadcast that names them. All other groups have one part, so nothing is copied for them.
    """
    # As a struct the key also matches where parts of it are NULL, as rows of one window partition do.
    keyed = df.withColumn("__key", F.struct(*keys))
    totals = keyed.groupBy("__key").agg(F.sum(measure).alias(name), F.count("*").alias("__n"))
    rows = totals.agg(F.sum("__n")).scalar()
    parts = (F.floor(F.col("__n") * F.lit(_HOT_SHARE) / rows) + F.lit(1)).cast("int")
    hot = totals.filter(F.col("__n") * F.lit(_HOT_SHARE) >= rows).select("__key", parts.alias("__parts"))
    part = F.pmod(F.xxhash64(*spread), F.coalesce(F.col("__parts"), F.lit(1))).cast("int")
    routed = keyed.join(F.broadcast(hot), "__key", "left").withColumn("__part", part)
    copies = totals.select("__key", name, F.explode(F.sequence(F.lit(0), parts - F.lit(1))).alias("__part"))
    return routed.join(copies, ["__key", "__part"], "left").drop("__key", "__part", "__parts")


def top_sums(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    ties: Sequence[str],
    sizes: Sequence[int],
    prefix: str = "TOP_",
) -> DataFrame:
    """Per key, the sum of the ``k`` largest measures for each k in ``sizes``.

    A NULL measure ranks before all others (NULL counts as the largest value) and adds nothing, so a key
    with one NULL entry has 0 as its top-1 sum.
    """
    order = [F.col(measure).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in ties]]
    ranked = rank_in_group(df, keys, order, max(sizes))
    sums = [
        F.sum(F.when(F.col(_RANK) <= k, F.coalesce(F.col(measure), F.lit(0))).otherwise(F.lit(0))).alias(
            f"{prefix}{k}"
        )
        for k in sizes
    ]
    return ranked.groupBy(*keys).agg(*sums)


def top_k_share(
    df: DataFrame, entity: str, category: str, weight: str, sizes: Sequence[int], prefix: str = "TOP_"
) -> DataFrame:
    """Per entity, the percentage of its total weight that its k largest categories hold."""
    weights = df.groupBy(entity, category).agg(F.sum(weight).alias("__weight"))
    totals = weights.groupBy(entity).agg(F.sum("__weight").alias("__total"))
    leaders = top_sums(weights, [entity], "__weight", [category], sizes, prefix)
    shares = [quotient(F.col(f"{prefix}{k}"), F.col("__total"), 100).alias(f"{prefix}{k}_PCT") for k in sizes]
    return totals.join(leaders, entity, "left").select(entity, *shares)
