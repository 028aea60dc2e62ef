"""Operators on inputs in which one key or value holds a large part of the rows."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from provwatch.operators import aggregates, joins, ranking, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows; group 'hot' holds two thirds, and half of its values are 0."""
    n = F.col("id")
    return spark.range(20000).select(
        n.alias("k"),
        F.when(n % 3 < 2, "hot").when(n % 7 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("g"), (n % 5).cast("string"))
        ).alias("g"),
        F.when(n % 2 == 0, F.lit(0)).otherwise((n * 7919) % 100003 - 50).cast("decimal(18,2)").alias("v"),
        (F.pmod(F.xxhash64("id"), F.lit(1 << 45)) / 100).cast("decimal(18,2)").alias("wide"),
    )


@pytest.mark.parametrize("shuffled", [False, True])
def test_percentile_ranks_equal_the_window(request, spark, skewed, rows, shuffled):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    got = ranking.percentile_ranks(skewed, "k", ["g"], {"pv": "v", "pw": "wide"})
    expected = skewed.select(
        "k",
        *[
            (F.percent_rank().over(Window.partitionBy("g").orderBy(c)) * 100.0).alias(name)
            for name, c in (("pv", "v"), ("pw", "wide"))
        ],
    )
    assert rows(got, "k", "pv", "pw") == rows(expected)


def test_medians_equal_brute_force(spark, skewed):
    got = {r["g"]: (r["mv"], r["mw"]) for r in ranking.exact_medians(skewed, ["g"], {"mv": "v", "mw": "wide"}).collect()}
    groups = {}
    for row in skewed.collect():
        groups.setdefault(row["g"], []).append((float(row["v"]), float(row["wide"])))
    expected = {
        g: (statistics.median(v for v, _ in items), statistics.median(w for _, w in items)) for g, items in groups.items()
    }
    assert got.keys() == expected.keys()
    for g in expected:
        assert got[g] == pytest.approx(expected[g], rel=1e-12)


def test_single_member_group_has_rank_zero(spark):
    df = spark.createDataFrame([("a", "x", 5), ("b", "y", 1), ("c", "y", 1)], "k string, g string, v int")
    got = {r["k"]: r["p"] for r in ranking.percentile_ranks(df, "k", ["g"], {"p": "v"}).collect()}
    assert got == {"a": 0.0, "b": 0.0, "c": 0.0}


def test_values_are_not_rounded(spark):
    df = spark.createDataFrame([("a", 1, "0.001"), ("a", 2, "0.002"), ("a", 3, "0.003")], "g string, k int, v string")
    df = df.withColumns({"d": F.col("v").cast("decimal(10,3)"), "x": F.col("v").cast("double")})
    for column in ("d", "x"):
        assert ranking.exact_medians(df, ["g"], {"m": column}).first()["m"] == 0.002
        ranks = {r["k"]: r["p"] for r in ranking.percentile_ranks(df, "k", ["g"], {"p": column}).collect()}
        assert ranks == {1: 0.0, 2: 50.0, 3: 100.0}


def test_a_group_of_close_values_is_spread_over_ranges(spark):
    """One group whose values lie close together, far from zero: no task of the running sums gets more than its share."""
    df = spark.range(40_000).select("id", F.lit("hot").alias("__group0"), F.lit(0).alias("__metric"))
    df = df.withColumn("__value", (F.col("id") + 10**12).cast("decimal(38,0)"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cells = ranking.cumulative_cells(df, ["__metric", "__group0"])
        sizes = cells.groupBy(F.spark_partition_id()).count().collect()
        wrong = cells.filter(F.col("__below") != F.col("__value") - 10**12).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert wrong == 0 and len(sizes) > 1 and max(r["count"] for r in sizes) <= 30_000


@pytest.mark.parametrize("shuffled", [False, True])
def test_flag_member(request, spark, shuffled):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    facts = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "hot").otherwise(
            F.when(F.col("id") % 2 == 0, F.col("id").cast("string"))
        ).alias("k")
    )
    members = spark.createDataFrame([("hot",), ("hot",), ("",), (None,), ("8",)], "k string")
    flagged = joins.flag_member(facts, members, "k", "f", spread=["id"])
    assert flagged.count() == 3000
    hits = flagged.groupBy("k").agg(F.count("*").alias("n"), F.max("f").alias("f")).filter("f").collect()
    assert {(r["k"], r["n"]) for r in hits} == {("hot", 1000), ("8", 1)}
    assert flagged.filter(F.col("f").isNull()).isEmpty()


def test_a_hot_key_is_spread_by_its_share(no_broadcast):
    spark = no_broadcast
    facts = spark.range(10000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    (_, parts), = joins.hot_keys(facts, ["k"])
    assert parts in range(330, 340)
    joined = joins.salted_left_join(facts, lookup, "k", ["id"])
    assert joined.filter("v = 1").count() == 3334 and joined.count() == 10000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 1


def test_nothing_is_copied_for_even_keys(no_broadcast):
    spark = no_broadcast
    facts = spark.range(20000).select("id", (F.col("id") % 5000).cast("string").alias("k"), F.lit("x").alias("__mark"))
    lookup = spark.range(7000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    assert joins.hot_keys(facts, ["k"]) == []
    joined = joins.salted_left_join(facts, lookup, "k", ["id"])
    assert "Generate" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.filter("v = 2 * (id % 5000)").count() == 20000


def test_hot_null_and_several_keys(spark, rows):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).cast("int").alias("a"), F.lit("x").alias("b"))
    lookup = spark.createDataFrame([(7, "x", "yes"), (None, "x", "never"), (8, "x", "no")], "a long, b string, v string")
    assert len(joins.hot_keys(facts, ["a", "b"])) == 2
    joined = joins.salted_left_join(facts, lookup, ["a", "b"], ["id"])
    assert joined.columns == ["a", "b", "id", "v"]
    assert rows(joined.groupBy("v").count()) == [("yes", 1000), (None, 2000)]
    assert joins.salted_left_join(facts.limit(0), lookup, ["a", "b"], ["id"]).count() == 0


def test_group_limit_runs_before_the_shuffle(spark, skewed):
    first = windows.keep_latest(skewed, ["g"], F.col("v").desc_nulls_last())
    plan = first._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange")[1], plan.split("Exchange")[0]
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_partition_total(spark, skewed, rows):
    got = windows.partition_total(skewed.select("k", "g", "v"), ["g"], "v", "t", ["k"])
    expected = skewed.withColumn("t", F.sum("v").over(Window.partitionBy("g")))
    assert rows(got, "k", "t") == rows(expected, "k", "t")


def test_top_sums_count_unknown_first(spark):
    df = spark.createDataFrame(
        [("a", "x", 5), ("a", "y", None), ("a", "z", 3), ("a", "w", 1), ("b", "x", 4)], "k string, c string, v int"
    )
    got = {r["k"]: (r["TOP_1"], r["TOP_3"]) for r in windows.top_sums(df, ["k"], "v", ["c"], [1, 3]).collect()}
    assert got == {"a": (0, 8), "b": (4, 4)}


def test_hhi(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("a", "y", 2), ("b", "x", 9), ("c", "x", 0)], "e string, c string, w int")
    got = {r["e"]: r["HHI"] for r in aggregates.hhi(df, "e", "c", "w").collect()}
    assert got == {"a": 5000.0, "b": 10000.0, "c": None}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0,), (0,), (10,), (25,), (50,), (None,)], "v int")
    got = {r["BIN"]: r["COUNT"] for r in aggregates.histogram(df, "v", 5).collect()}
    assert got == {1: 2, 2: 1, 3: 1, 5: 1}
    flat = aggregates.histogram(spark.createDataFrame([(7,), (7,)], "v int"), "v").collect()
    assert [(r["BIN"], r["COUNT"]) for r in flat] == [(1, 2)]
    # values that differ in the third digit only are told apart
    fine = spark.createDataFrame([("1.001",), ("1.002",), ("1.003",), (None,)], "v string")
    for column in (F.col("v").cast("decimal(10,3)"), F.col("v").cast("double")):
        got = aggregates.histogram(fine.select(column.alias("v")), "v", 2).orderBy("BIN").collect()
        assert [(r["BIN"], r["COUNT"]) for r in got] == [(1, 1), (2, 2)]
        assert (got[0]["BIN_START"], got[1]["BIN_END"]) == (1.001, 1.003)


@pytest.mark.parametrize("large", [0, 10**9])
def test_only_rows_of_repeated_keys_are_dealt(no_broadcast, rows, large):
    """Equal to the window over all rows; without a repeated key nothing is shuffled."""
    df = no_broadcast.range(400).select(
        F.when(F.col("id") % 40 == 0, F.lit(None)).when(F.col("id") < 20, F.col("id") % 5).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("w"),
    )
    newest = F.col("w").desc_nulls_first()
    expected = rows(windows.keep_latest(df, ["k"], newest))
    assert rows(windows.keep_latest_of_repeated(df, ["k"], newest, large)) == expected
    single = df.where("k >= 20")
    found = windows.keep_first_of_repeated(single, ["k"], [newest], large)
    assert (found is None) == (large > 400)
    if found is not None:
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == single.count()
    assert windows.keep_first_of_repeated(df.where("false"), ["k"], [newest], 1) is None


@pytest.mark.parametrize("sent", [1, 2])
def test_few_members_go_to_the_rows(no_broadcast, sent):
    facts = no_broadcast.range(300).select((F.col("id") % 3).cast("string").alias("k"), "id")
    members = no_broadcast.createDataFrame([("1",), ("1",), ("2",), ("",), (None,)], "k string")
    flagged = joins.flag_member(facts, members, "k", "f", ["id"], sent=sent)
    assert {(r["k"], r["f"], r["count"]) for r in flagged.groupBy("k", "f").count().collect()} == {
        ("0", False, 100), ("1", True, 100), ("2", True, 100)
    }
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan and "__salt" not in plan) == (sent == 2)
