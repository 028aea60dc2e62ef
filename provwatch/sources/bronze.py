"""Landing: raw files to all-string tables, and staging on top of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.sources.readers import read_latest, with_load_timestamp, with_source_file
from provwatch.sources.schemas import LOAD_TIMESTAMP, SOURCE_FILE, bronze_columns, landed_name


def header_mapping(df: DataFrame, table: str) -> dict[str, str]:
    """Raw header of each landed column found in the file, as ``{landed: raw}``."""
    wanted = set(bronze_columns(table))
    found = {landed_name(header): header for header in df.columns}
    return {landed: raw for landed, raw in found.items() if landed in wanted}


def to_bronze(df: DataFrame, mapping: dict[str, str], columns: list[str] | None = None) -> DataFrame:
    """Rename raw headers, cast to string; listed columns the file lacks become NULL."""
    names = columns or list(mapping)
    return df.select(
        *[
            F.col(f"`{mapping[name]}`").cast("string").alias(name)
            if name in mapping
            else F.lit(None).cast("string").alias(name)
            for name in names
        ]
    )


def load_bronze(spark: SparkSession, directory: str, table: str, tolerant: bool = False) -> DataFrame:
    """Latest file of a source, shaped to the landed table with its two audit columns."""
    raw = with_source_file(read_latest(spark, directory, tolerant), SOURCE_FILE)
    shaped = to_bronze(raw, {**header_mapping(raw, table), SOURCE_FILE: SOURCE_FILE}, [*bronze_columns(table), SOURCE_FILE])
    stamped = with_load_timestamp(shaped, LOAD_TIMESTAMP)
    return stamped.select(*bronze_columns(table), LOAD_TIMESTAMP, SOURCE_FILE)


def align_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match columns to a schema by name, ignoring case; missing ones become NULL, others are dropped."""
    by_name = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{by_name[f.name.lower()]}`") if f.name.lower() in by_name else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def stage(df: DataFrame, active_only: bool = False, stamped: bool = True) -> DataFrame:
    """Staging view: all columns plus ``_loaded_at``; registry sources keep active rows only."""
    kept = df.filter(F.col("IS_ACTIVE")) if active_only else df
    return kept.withColumn("_loaded_at", F.current_timestamp()) if stamped else kept


def expect_non_empty(df: DataFrame, what: str = "source") -> DataFrame:
    """Fail on an empty input; reads at most one row. It runs a job: use it where the plan's next step is a write."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def load_metrics(df: DataFrame, required: str | None = None) -> DataFrame:
    """Row and column count of a loaded table; with ``required`` (its name) an empty one fails in the same job."""
    rows = F.count("*")
    if required is not None:
        rows = F.when(rows > 0, rows).otherwise(F.raise_error(F.lit(f"{required} is empty")).cast("bigint"))
    return df.agg(rows.alias("ROW_COUNT")).withColumn("COLUMN_COUNT", F.lit(len(df.columns)))
