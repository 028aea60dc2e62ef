"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_IDS = 1_000_000


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and go on from the written table: a lost executor costs a few tasks, not the plan above."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_small(ids: DataFrame) -> DataFrame:
    """A written table of numbers, marked for broadcast if it has at most ``BROADCAST_IDS`` rows.

    Beyond that the join stays a shuffled one. It spares a shuffle of whole texts where few rows are wanted.
    """
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def most_frequent(df: DataFrame, count: str, limit: int) -> DataFrame:
    """Rows of the largest counts, at most ``limit``: whole classes of about equal counts, as many as fit.

    A limit after a sort would send ``limit`` rows of every partition to the driver; here it gets one number for each
    class (counts within two per cent, some two thousand classes at most).
    """
    number = F.floor(F.log(F.col(count)) * 50)
    sizes = sorted(df.groupBy(number.alias("k")).agg(F.count("*").alias("n")).collect(), reverse=True)
    least, taken = None, 0
    for k, n in sizes:
        taken += n
        if taken > limit:
            break
        least = k
    return df.where(F.lit(False)) if least is None else df.where(number >= least)
