"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_inferred(
    spark: SparkSession, path: str, tolerant: bool = False, multi_line: bool = False
) -> DataFrame:
    """CSV with types inferred. Inference reads the data twice and drops leading zeros."""
    return _csv(spark, path, tolerant, multi_line, inferSchema=True)


def read_csv_strings(
    spark: SparkSession,
    path: str,
    tolerant: bool = False,
    multi_line: bool = False,
    missing: str | None = "",
) -> DataFrame:
    """CSV with every column a string; empty fields become ``missing`` (None keeps them NULL)."""
    df = _csv(spark, path, tolerant, multi_line)
    return df if missing is None else df.na.fill(missing)


def _csv(spark: SparkSession, path: str, tolerant: bool, multi_line: bool, **options) -> DataFrame:
    """RFC 4180 quoting. Line breaks inside fields need ``multi_line``, which makes files unsplittable.

    Every column is parsed, so that rows dropped as malformed are the same whatever is selected.
    """
    return spark.read.options(
        header=True,
        mode="DROPMALFORMED" if tolerant else "FAILFAST",
        quote='"',
        escape='"',
        multiLine=multi_line,
        columnPruning=not tolerant,
        **options,
    ).csv(path)


def split_malformed(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """CSV rows that fit the schema, and the malformed ones as text (column ``_corrupt_record``).

    Fields are read as text and cast here, so a row's fate depends on all its fields and on no column chosen later. A
    row is malformed if its number of fields differs or a field that is not empty has no value of its type.
    """
    bad, names = "_corrupt_record", schema.names
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, bad]])
    rows = spark.read.schema(as_text).options(
        header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=bad, quote='"', escape='"', multiLine=multi_line,
        columnPruning=False,
    ).csv(path)
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    fits = F.col(bad).isNull()
    for c in names:
        fits = fits & (F.col(c).isNull() | cast[c].isNotNull())
    good = rows.filter(fits).select(*[cast[c].alias(c) for c in names])
    text = F.coalesce(F.col(bad), F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in names]))
    return good, rows.filter(~fits).select(text.alias(bad))


def files_without_rows(spark: SparkSession, directory: str) -> DataFrame:
    """Files of the latest copies that give a tolerant scan no row, since they are unreadable or empty: ``path``."""
    pattern = f"{directory}/*LATEST*.parquet"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    # the two scans may write a local path with one or three slashes
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("path")
    found = listed.load(pattern).select(path)
    return found.join(read_latest(spark, directory, tolerant=True).select(path).distinct(), "path", "left_anti")


def read_latest(spark: SparkSession, directory: str, tolerant: bool = False) -> DataFrame:
    """Parquet files or datasets in a directory whose name marks them as the latest copy.

    An unreadable file fails the scan. With ``tolerant`` such files are skipped; ``files_without_rows`` lists them.
    """
    reader = spark.read.option("ignoreCorruptFiles", str(tolerant).lower())
    return reader.parquet(f"{directory}/*LATEST*.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table, used for the provider-registry dimensions."""
    return spark.table(name)


def infer_bronze(spark: SparkSession, path: str):
    """Schema found in the Parquet footers."""
    return spark.read.parquet(path).schema


def with_source_file(df: DataFrame, name: str = "_SOURCE_FILE") -> DataFrame:
    """Add the path of the file each row was read from; call it directly on a file scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def with_load_timestamp(df: DataFrame, name: str = "_LOAD_TIMESTAMP") -> DataFrame:
    return df.withColumn(name, F.current_timestamp().cast("timestamp_ntz"))
