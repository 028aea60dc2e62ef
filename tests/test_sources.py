from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.sources import bronze, readers, sinks
from provwatch.sources.schemas import BRONZE_SCHEMAS, landed_name


def write_text(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_strings_keep_zeros_and_blanks(spark, tmp_path):
    path = write_text(tmp_path / "a.csv", 'zip,name,note\n00501,"Doe, ""J""",NA\n1,,\n')
    assert [tuple(r) for r in readers.read_csv_strings(spark, path).collect()] == [
        ("00501", 'Doe, "J"', "NA"),
        ("1", "", ""),
    ]
    kept = readers.read_csv_strings(spark, path, missing=None).collect()[1]
    assert kept["name"] is None
    assert readers.read_csv_inferred(spark, path).schema["zip"].dataType == T.IntegerType()


def test_line_breaks_inside_fields(spark, tmp_path):
    path = write_text(tmp_path / "a.csv", 'a,b\n1,"x\ny"\n2,z\n')
    assert [r["b"] for r in readers.read_csv_strings(spark, path, multi_line=True).collect()] == ["x\ny", "z"]


def test_malformed_rows_are_dropped_only_if_tolerant(spark, tmp_path):
    path = write_text(tmp_path / "a.csv", "a,b\n1,2\n3,4,5\n6,7\n")
    assert [r["a"] for r in readers.read_csv_strings(spark, path, tolerant=True).select("a", "b").collect()] == ["1", "6"]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv_strings(spark, path).collect()


def test_conversion_splits_files(spark, tmp_path):
    source = write_text(tmp_path / "a.csv", "a\n" + "\n".join(str(i) for i in range(250)) + "\n")
    target = str(tmp_path / "out")
    assert sinks.csv_to_parquet(spark, source, target, max_records_per_file=100).count() == 250
    assert len([f for f in os.listdir(target) if f.endswith(".parquet")]) == 3


def test_latest_copy_is_found_and_corrupt_files_skipped(spark, tmp_path):
    folder = str(tmp_path)
    sinks.write_versioned(spark.range(3), folder, "x", "20240101_000000")
    sinks.write_versioned(spark.range(5), folder, "x", "20240102_000000")
    assert sorted(os.listdir(folder)) == [
        "x_20240101_000000.parquet", "x_20240102_000000.parquet", "x_LATEST.parquet",
    ]
    assert readers.read_latest(spark, folder).count() == 5
    (tmp_path / "y_LATEST.parquet").write_bytes(b"not parquet at all")
    assert readers.read_latest(spark, folder, tolerant=True).count() == 5
    with pytest.raises(Exception):
        readers.read_latest(spark, folder, tolerant=False).count()


def test_versioned_csv(spark, tmp_path):
    df = spark.createDataFrame([("a,b", '"q"')], "x string, y string")
    latest = sinks.write_versioned(df, str(tmp_path), "raw", "v1", "csv")
    assert [tuple(r) for r in latest.collect()] == [("a,b", '"q"')]


def test_headers():
    assert landed_name("Federal Provider Number") == "FEDERAL_PROVIDER_NUMBER"
    assert landed_name("CMS Certification Number (CCN)") == "CMS_CERTIFICATION_NUMBER"
    assert landed_name("CMS Certification Number") == "CMS_CERTIFICATION_NUMBER"
    assert landed_name("Date First Approved to Provide Medicare and Medicaid Services") == "DATE_FIRST_APPROVED"
    assert landed_name("Avg_Spending_Per_Episode_Hospital") == "AVG_SPENDING_PER_EPISODE_HOSPITAL"
    assert landed_name("Tot_30day_Fills") == "TOT_30DAY_FILLS"


def test_landing_shapes_types_and_audit_columns(spark, tmp_path):
    raw = spark.createDataFrame(
        [(501, "Acme", 1.5)], ["CMS Certification Number (CCN)", "Facility Name", "Unexpected Column"]
    )
    raw.write.parquet(str(tmp_path / "h_LATEST.parquet"))
    loaded = bronze.load_bronze(spark, str(tmp_path), "HOSPICE")
    assert loaded.schema.names == BRONZE_SCHEMAS["HOSPICE"].names
    assert [f.dataType for f in loaded.schema.fields] == [f.dataType for f in BRONZE_SCHEMAS["HOSPICE"].fields]
    row = loaded.first()
    assert (row["CMS_CERTIFICATION_NUMBER"], row["FACILITY_NAME"], row["CITY"]) == ("501", "Acme", None)
    assert "h_LATEST" in row["_SOURCE_FILE"] and isinstance(row["_LOAD_TIMESTAMP"], datetime)


def test_bronze_schemas():
    sizes = {table: len(schema) - 2 for table, schema in BRONZE_SCHEMAS.items()}
    assert sizes == {
        "LEIE": 18, "MEDICARE_HOSPITAL_SPENDING": 18, "PROVIDER_INFORMATION": 25, "LONGTERM_CARE_HOSPITAL": 14,
        "HOSPICE": 12, "HOME_HEALTH_CARE": 15, "MEDICARE_PART_D_PRESCRIBERS": 22,
    }


def test_alignment_ignores_case(spark):
    schema = T.StructType().add("Record_ID", "string").add("Amount", "double").add("Missing", "date")
    df = spark.createDataFrame([(1, "2.5", "x")], "RECORD_ID int, amount string, extra string")
    out = bronze.align_by_name(df, schema)
    assert out.schema.names == ["Record_ID", "Amount", "Missing"]
    assert tuple(out.first()) == ("1", 2.5, None)


def test_staging(spark):
    df = spark.createDataFrame([("1", True), ("2", False), ("3", None)], "NPI string, IS_ACTIVE boolean")
    assert [r["NPI"] for r in bronze.stage(df, active_only=True).collect()] == ["1"]
    assert "_loaded_at" in bronze.stage(df).columns and "_loaded_at" not in bronze.stage(df, stamped=False).columns


def test_empty_source_is_refused(spark):
    with pytest.raises(ValueError, match="leie is empty"):
        bronze.expect_non_empty(spark.range(0), "leie")
    metrics = bronze.load_metrics(spark.range(4).withColumn("x", F.lit(1))).first()
    assert tuple(metrics) == (4, 2)


def test_clustered_write_splits_a_hot_key(spark, tmp_path):
    df = spark.range(20000).select(F.lit("NY").alias("state"), F.col("id"))
    path = str(tmp_path / "c")
    out = sinks.write_clustered(df, path, ["state"], partitions=4, spread=["id"])
    assert out.count() == 20000
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4


def test_registry_tables_come_from_the_catalog(spark):
    spark.range(2).createOrReplaceTempView("dim_provider_test")
    assert readers.read_table(spark, "dim_provider_test").count() == 2


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = sinks.work_folder(spark, "t"), sinks.work_folder(spark, "t")
    assert first.startswith(base) and first != second


def test_export(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.export_csv(spark.createDataFrame([(1, 'say "hi", now')], "a int, b string"), path)
    assert readers.read_csv_strings(spark, path).first()["b"] == 'say "hi", now'


def test_malformed_rows_do_not_depend_on_the_columns_read(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    with open(path, "w") as file:
        file.write('a,b,c\n1,x,2.5\n2,y\n3,"z, w",n/a\n4,,\nfive,v,1\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.DoubleType())])
    good, bad = readers.split_malformed(spark, path, schema)
    assert good.count() == 2 and {r["a"] for r in good.select("a").collect()} == {1, 4}
    assert bad.count() == 3 and sorted(r[0][:2] for r in bad.collect()) == ["2,", "3,", "fi"]


def test_files_a_tolerant_scan_skips_are_listed(spark, tmp_path):
    good, broken = str(tmp_path / "a_LATEST.parquet"), tmp_path / "b_LATEST.parquet"
    spark.range(5).coalesce(1).write.parquet(good)
    broken.write_bytes(b"no parquet at all")
    listed = [r["path"] for r in readers.files_without_rows(spark, str(tmp_path)).collect()]
    assert len(listed) == 1 and listed[0].endswith("b_LATEST.parquet")
