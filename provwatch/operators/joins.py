"""Joins.

Spark compares the size of each side with ``spark.sql.autoBroadcastJoinThreshold`` (and again at run
time, under AQE) and falls back to a shuffled join beyond it. What the library adds is protection
against hot keys in that fallback. Only ``flag_member`` asks for a broadcast: of bare keys, if they are few.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000  # a key with at least one row in so many is hot
SENT_KEYS = 1_000_000  # members up to which their keys are broadcast
_TRACKED = 8192  # entries of the sketch: it misses no key with one row in 6,000
_SALT, _HASH, _PARTS = "__salt", "__hash", "__parts"


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def left_join(df: DataFrame, dim: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return df.join(dim, _as_list(keys), "left")


def inner_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return left.join(right, _as_list(keys), "inner")


def semi_join(df: DataFrame, dim: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key exists in ``dim``; never multiplies rows."""
    return df.join(dim.select(*_as_list(keys)), _as_list(keys), "left_semi")


def anti_join(child: DataFrame, parent: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``child`` without a counterpart in ``parent``."""
    return child.join(parent.select(*_as_list(keys)), _as_list(keys), "left_anti")


def star_join(dim: DataFrame, summaries: Sequence[DataFrame], keys: str | Sequence[str]) -> DataFrame:
    """Left-join one-row-per-key summaries onto a dimension; all share one partitioning by the key."""
    return reduce(lambda left, right: left_join(left, right, keys), summaries, dim)


def hot_keys(df: DataFrame, keys: Sequence[str]) -> list[tuple[int, int]]:
    """Hashes of the keys that hold at least one row in ``HOT_SHARE``, with how many such shares each holds.

    One pass over the key columns with a heavy-hitter sketch, which each task fills for its own rows; at most
    ``HOT_SHARE`` keys come back. Counts of the sketch are close, not exact: they decide how rows are dealt, not what
    they join. NULL counts as a key, since rows without one are dealt by a hash, too.
    """
    rows = df.select(F.xxhash64(*keys).alias(_HASH))
    sketch = F.expr(f"approx_top_k({_HASH}, {HOT_SHARE}, {_TRACKED})")
    found = rows.agg(sketch.alias("top"), F.count("*").alias("n")).first()
    shares = ((item["item"], item["count"] * HOT_SHARE // max(found["n"], 1)) for item in found["top"] or [])
    return [(key, share + 1) for key, share in shares if share >= 1]


def salted_left_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: str | Sequence[str],
    spread: Sequence[str],
    hot: Sequence[tuple[int, int]] | None = None,
) -> DataFrame:
    """Left join a narrow lookup whose keys may be very frequent in ``df``.

    The hot keys are measured (``hot_keys``, or given as ``hot``). Without any this is a plain join. Rows of a hot key
    are dealt to as many parts as its share asks, by a hash of their ``spread`` columns, and only the lookup rows of
    hot keys are repeated, once per part: two thousand copies at most. A part comes from row content, so a task that is
    run again after losing an executor assigns the same one. NULL keys match NULL keys neither here nor in SQL.
    """
    names = _as_list(keys)
    hot = hot_keys(df, names) if hot is None else list(hot)
    if not hot:
        return left_join(df, lookup, names)
    # at most HOT_SHARE rows
    parts = F.broadcast(df.sparkSession.createDataFrame(hot, f"{_HASH} long, {_PARTS} int"))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    part = F.pmod(F.xxhash64(*spread), F.coalesce(_PARTS, F.lit(1))).cast("int")
    dealt = df.withColumn(_HASH, F.xxhash64(*names)).join(parts, _HASH, "left").withColumn(_SALT, part)
    keyed = lookup.withColumn(_HASH, F.xxhash64(*(F.col(n).cast(kinds[n]) for n in names))).join(parts, _HASH, "left")
    copies = keyed.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_PARTS, F.lit(1)) - 1)))
    return dealt.drop(_HASH, _PARTS).join(copies.drop(_HASH, _PARTS), [*names, _SALT], "left").drop(_SALT)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct, non-empty key values."""
    return df.select(key).filter(F.col(key).isNotNull() & (F.col(key) != "")).distinct()


def flag_member(
    df: DataFrame,
    members: DataFrame,
    key: str,
    flag: str,
    spread: Sequence[str],
    sent: int = SENT_KEYS,
) -> DataFrame:
    """Add a boolean column telling whether the key occurs in ``members``.

    Members are reduced to distinct keys first, so rows are never multiplied. Up to ``sent`` of them go to all tasks,
    and the rows stay where they are. Beyond that blank keys can match nothing, but they still pass through the join:
    they are dealt to many tasks like any other hot key.
    """
    marked = distinct_keys(members, key).withColumn(flag, F.lit(True))
    few = marked.limit(sent + 1).count() <= sent
    joined = left_join(df, F.broadcast(marked), key) if few else salted_left_join(df, marked, key, spread)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def is_matched(column: str) -> Column:
    """Existence flag after a left join: the joined side had a row."""
    return F.col(column).isNotNull()
