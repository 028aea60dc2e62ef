from __future__ import annotations

from pyspark.sql import functions as F

from provwatch.operators.bitmaps import distinct_bitmaps, distinct_counts
from provwatch.sources.sinks import write_table


def test_bitmaps_count_like_count_distinct(spark, tmp_path, rows):
    df = spark.range(90_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else string(id % 5) end as a",
        "id % 2 as b",
        "case when id % 11 = 0 then null else 'v' || (id * 7919 % 40000) end as v",
    )
    only_null = spark.createDataFrame([("none", 1, None)], "a string, b long, v string")
    df = df.unionByName(only_null)
    bitmaps = write_table(distinct_bitmaps(df, ["a", "b"], "v", str(tmp_path / "numbers")), str(tmp_path / "bitmaps"))
    assert bitmaps.agg(F.max("BUCKET")).first()[0] >= 1  # more values than one bitmap holds
    for keys in (["a", "b"], ["a"], ["b"], []):
        expected = df.groupBy(*keys).agg(F.count_distinct("v").alias("n"))
        assert rows(distinct_counts(bitmaps, keys, "n")) == rows(expected)
    assert "Expand" not in distinct_counts(bitmaps, ["a"], "n")._jdf.queryExecution().executedPlan().toString()


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "a string, v string")
    bitmaps = distinct_bitmaps(none, ["a"], "v", str(tmp_path / "numbers"))
    assert distinct_counts(bitmaps, ["a"], "n").collect() == []
    assert distinct_counts(bitmaps, [], "n").collect() == [(0,)]
