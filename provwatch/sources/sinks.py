"""Writers, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provwatch.sources.layout import z_value
from provwatch.sources.readers import read_csv_strings


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables that cut lineage, below the folder the cluster names for checkpoints.

    Only a local session may lack that setting; it then gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="provwatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has been committed."""
    files, place = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of written rows; its commit mark goes first, so that no reader takes a part of it for all."""
    files, mark = _file_system(spark, f"{path}/_SUCCESS")
    files.delete(mark, False)
    files.delete(mark.getParent(), True)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Full refresh: replace the table at ``path`` and read it back."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    max_records_per_file: int | None = None,
    missing: str | None = "",
) -> DataFrame:
    """Convert CSV to Parquet as strings; splits of the input are converted in parallel."""
    writer = read_csv_strings(spark, source, missing=missing).write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(target)
    return spark.read.parquet(target)


def write_versioned(df: DataFrame, directory: str, name: str, version: str, file_format: str = "parquet") -> DataFrame:
    """Keep a copy under its version and make it the latest one.

    The plan runs once: the latest copy is made from the versioned one.
    """
    spark = df.sparkSession
    kept, latest = (f"{directory}/{name}_{tag}.{file_format}" for tag in (version, "LATEST"))
    options = {"header": "true", "quote": '"', "escape": '"'} if file_format == "csv" else {}
    df.write.format(file_format).options(**options).mode("overwrite").save(kept)
    copy = spark.read.format(file_format).options(**options).load(kept)
    copy.write.format(file_format).options(**options).mode("overwrite").save(latest)
    return spark.read.format(file_format).options(**options).load(latest)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], partitions: int | None = None, spread: Sequence[str] = ()
) -> DataFrame:
    """Write in Z-order of ``columns``, so that a search by any of them can skip row groups by their statistics.

    The plan runs once: it is written beside the table as it comes, and ordered from there. ``spread`` columns extend
    the range key: a hot value is then cut into several ranges and files.
    """
    draft = write_table(df, f"{path}-draft")
    ordered = draft.withColumn("__z", z_value(draft, columns))
    ranges = [F.col("__z"), F.xxhash64(*spread)] if spread else [F.col("__z")]
    layout = ordered.repartitionByRange(partitions, *ranges) if partitions else ordered.repartitionByRange(*ranges)
    table = write_table(layout.sortWithinPartitions("__z", *columns).drop("__z"), path)
    remove_folder(df.sparkSession, f"{path}-draft")
    return table


def next_version(spark: SparkSession, path: str) -> str:
    """A folder below ``path`` that is not used yet and sorts behind all others."""
    used = _versions(spark, path)
    return f"{path}/{int(used[-1].rsplit('/', 1)[-1]) + 1 if used else 1:08d}"


def current_version(spark: SparkSession, path: str) -> str | None:
    """The newest folder below ``path`` whose write was committed."""
    written = [v for v in _versions(spark, path) if is_written(spark, v)]
    return written[-1] if written else None


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` committed folders, and what lost writers have left before them."""
    versions = _versions(spark, path)
    written = [v for v in versions if is_written(spark, v)]
    for version in [v for v in versions if len(written) >= keep and v < written[-keep]]:
        remove_folder(spark, version)


def _versions(spark: SparkSession, path: str) -> list[str]:
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(f"{path}/{n}" for n in names if n.isdigit())


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
