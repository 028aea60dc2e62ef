"""Session settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes reducers, splits skewed join partitions and switches to broadcast joins by
# the sizes it has measured. Splitting is wanted even where it costs one more shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("provwatch")
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
