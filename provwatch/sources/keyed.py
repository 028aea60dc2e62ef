"""Tables for lookups by key: rows dealt to folders by the key's hash, sorted by key, with Bloom filters on it.

A lookup lists and opens one folder per key, and reads there the row groups whose range and filter may hold the key. The
number of folders is part of the name of the column that numbers them, so no reader can take another one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.sources.layout import groups_read

BUCKETS = 64
FEW = 10  # equalities of one list that Spark hands on to the Parquet reader
_PREFIX = "bucket_of_"


def bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _folders(table: DataFrame) -> tuple[str, int]:
    name = next(c for c in table.columns if c.startswith(_PREFIX))
    return name, int(name.removeprefix(_PREFIX))


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, row_group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` for lookups by ``key`` and read it back; it should be a written table, as it is sampled for ranges.

    Rows are ranged by folder, key and a hash of the row, so a key of very many rows is written by several tasks. Rows
    without a key are kept, but no lookup finds them. Columns must not be maps.
    """
    name = f"{_PREFIX}{buckets}"
    ranged = df.withColumn(name, bucket(F.col(key), buckets)).repartitionByRange(name, key, F.xxhash64(*df.columns))
    options = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    ranged.sortWithinPartitions(name, key).write.mode("overwrite").options(**options).partitionBy(name).parquet(path)
    spark = df.sparkSession  # a table without rows would have no folder, and no columns
    spark.createDataFrame([], df.schema).write.mode("append").parquet(f"{path}/{name}=0")
    return spark.read.parquet(path)


def _folder_of(table: DataFrame, values: Sequence) -> Column:
    name, buckets = _folders(table)
    return F.col(name).isin(*[bucket(F.lit(v), buckets) for v in values])


def rows_of(table: DataFrame, key: str, *values: object) -> DataFrame:
    """Rows of the given keys; null is no key."""
    known = [v for v in values if v is not None]
    name, _ = _folders(table)
    found = table.where(_folder_of(table, known) & F.col(key).isin(*known)) if known else table.where(F.lit(False))
    return found.drop(name)


def rows_of_keys(table: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is in ``keys``, a written table of one column; only folders that hold such keys are read.

    A few keys are looked up one by one, more are joined.
    """
    first = [r[key] for r in keys.limit(FEW + 1).collect()]
    if len(first) <= FEW:
        return rows_of(table, key, *first)
    name, buckets = _folders(table)
    used = keys.where(F.col(key).isNotNull()).select(bucket(F.col(key), buckets).alias("b")).distinct()
    numbers = [r["b"] for r in used.collect()]  # as many as there are folders, at most
    return table.where(F.col(name).isin(*numbers)).join(keys, key, "left_semi").drop(name)


def groups_to_read(table: DataFrame, key: str, value: str) -> DataFrame:
    """Row groups that a lookup of one text key has to read, by their ranges, and all in its folder (COLUMN, READ, GROUPS)."""
    return groups_read(table.where(_folder_of(table, [value])), {key: value})
