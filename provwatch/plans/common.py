"""Pieces shared by the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Add ``_loaded_at``; pass a value for reproducible output."""
    return df.withColumn("_loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)


def pick(source: str, **renamed: str) -> list[Column]:
    """Columns named in a blank-separated list, then renamed ones as ``new=old``."""
    plain = [F.col(name) for name in source.split()]
    return plain + [F.col(old).alias(new) for new, old in renamed.items()]
