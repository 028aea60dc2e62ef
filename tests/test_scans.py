from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from provwatch.operators.scans import following, numbered, running


@pytest.fixture
def hot(spark):
    """A third of all rows in one group, in no order."""
    rng = random.Random(5)
    rows = [("hot" if i % 3 else f"g{i % 40}", i, rng.randint(-9, 9) if i % 11 else None) for i in range(3000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, i long, v long").repartition(7), sorted(rows)


def test_positions_without_gaps_over_many_ranges(spark, hot, tmp_path):
    df, expected = hot
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbered(df, [F.col("g"), F.col("i")], str(tmp_path / "t")).orderBy("position").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [tuple(r) for r in got] == [(*row, k) for k, row in enumerate(expected)]
    assert len(list((tmp_path / "t").glob("part-*"))) > 1


def test_running_totals_and_following_rows(spark, hot, tmp_path):
    df, expected = hot
    rows = numbered(df, [F.col("g"), F.col("i")], str(tmp_path / "t"), "p")
    kinds = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "x": ("bit_xor", F.col("i"))}
    for keys in ([], ["g"]):
        got = running(rows, "p", kinds, keys, size=64).orderBy("p").collect()
        group = s = m = x = None
        for r, (g, i, v) in zip(got, expected, strict=True):
            if s is None or (keys and g != group):
                group, s, m, x = g, 0, None, 0
            s, x = s + (v or 0), x ^ i
            m = v if m is None else m if v is None else max(m, v)
            assert (r.g, r.i, r.s, r.m, r.x) == (g, i, s, m, x)
    got = following(rows, "p", {"after": "i"}, size=64).orderBy("p").collect()
    assert [r.after for r in got] == [i for _, i, _ in expected[1:]] + [None]


def test_empty_and_single(spark, tmp_path):
    for n in (0, 1):
        df = spark.range(n).withColumn("v", F.lit(4))
        rows = numbered(df, [F.col("id")], str(tmp_path / f"t{n}"))
        assert running(rows, "position", {"s": ("sum", F.col("v"))}).collect() == [(0, 4, 0, 4)] * n
        assert [r.next for r in following(rows, "position", {"next": "id"}).collect()] == [None] * n


def test_no_task_sees_all_rows(spark, hot, tmp_path):
    df, _ = hot
    numbered(df, [F.col("g"), F.col("i")], str(tmp_path / "t"), "p").write.parquet(str(tmp_path / "numbered"))
    rows = spark.read.parquet(str(tmp_path / "numbered"))
    found = running(rows, "p", {"s": ("sum", F.col("v"))}, ["g"], size=64)
    sizes = found.groupBy("g", F.expr("p div 64")).count().agg(F.max("count")).first()[0]
    assert sizes <= 64
    plan = found._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
