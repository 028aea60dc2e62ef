from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from provwatch.operators import filters, ordering
from provwatch.plans import quality, serving
from tests.test_models import profiles


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("a", 1, "X"), ("a", 5, "Y"), (None, None, None), (None, 11, "Z"), ("b", 10, "X")], "k string, n int, c string"
    )


def test_checks_return_failing_rows(table, rows):
    assert rows(quality.expect_unique(table, "k")) == [("a", 2)]
    assert quality.expect_not_null(table, "k").count() == 2
    assert rows(quality.expect_accepted(table, "c", ["X", "Y"]), "c") == [("Z",)]
    assert rows(quality.expect_range(table, "n", 1, 10), "n") == [(11,)]
    assert rows(quality.expect_range(table, "n", 2), "n") == [(1,)]
    parent = table.filter("k = 'b'")
    assert rows(quality.expect_relationship(table, parent, "k"), "k", "n") == [("a", 1), ("a", 5)]


def test_invariants_find_bad_profiles(spark):
    good = {"TOTAL_PAYMENT_AMOUNT": Decimal(5), "TOTAL_PRESCRIPTION_COST": Decimal(6), "TOTAL_FINANCIAL_EXPOSURE": Decimal(11)}
    bad = {**good, "TOTAL_FINANCIAL_EXPOSURE": Decimal(12)}
    negative = {**good, "TOTAL_PAYMENT_AMOUNT": Decimal(-1), "TOTAL_FINANCIAL_EXPOSURE": Decimal(5)}
    df = profiles(spark, [good, bad, negative])
    assert [r["NPI"] for r in quality.exposure_mismatch(df).collect()] == ["1"]
    assert [r["NPI"] for r in quality.negative_amounts(df).collect()] == ["2"]


def test_null_placement(spark, rows):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r["v"] for r in ordering.order(df, [("v", "desc")]).collect()] == [None, 3, 1]
    assert [r["v"] for r in ordering.order(df, [("v", "desc", "last")]).collect()] == [3, 1, None]
    assert [r["v"] for r in ordering.order(df, [("v",)]).collect()] == [1, 3, None]
    assert [r["v"] for r in ordering.top_k(df, [("v", "desc", "last")], 2).collect()] == [3, 1]
    assert [r["v"] for r in df.orderBy(ordering.nulls_last("v")).collect()] == [3, 1, None]


def test_category_order_drops_other_labels(spark):
    df = spark.createDataFrame([("LOW",), ("CRITICAL",), ("?",), ("HIGH",)], "t string")
    assert [r["t"] for r in ordering.order_by_category(df, "t", ["CRITICAL", "HIGH", "LOW"]).collect()] == [
        "CRITICAL", "HIGH", "LOW",
    ]


def test_optional_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    assert filters.apply_filters(df, k=None, v=[]).count() == 3
    assert filters.apply_filters(df, k=["a", "c"], v=3).count() == 1


def test_search_terms(spark):
    df = profiles(spark, [{"NPI": "1234567890", "FULL_NAME": "Ann Lee"}, {"NPI": "2", "ORGANIZATION_NAME": "Leeds \\ Co"}])
    df = df.withColumns({"CITY": F.lit("c")})
    assert serving.search_providers(df, "lee").count() == 2
    assert serving.search_providers(df, "4567").count() == 1
    assert serving.search_providers(df, "ds \\").count() == 1
    assert serving.compare_search(df, "2").count() == 1
    with pytest.raises(ValueError):
        serving.search_providers(df, "le")


def test_comparison_flags(spark):
    cases = {(151, 100): (True, False), (150, 100): (False, False), (49, 100): (False, True), (5, 0): (False, False), (None, 5): (False, False)}
    df = spark.createDataFrame(list(cases), "a int, b int")
    got = df.select("a", "b", *serving.comparison_flags(F.col("a"), F.col("b"), "X")).collect()
    assert {(r["a"], r["b"]): (r["X_FLAG_1"], r["X_FLAG_2"]) for r in got} == cases
    flipped = serving.comparison_flags(F.col("a"), F.col("b"), "X", higher_is_worse=False)
    assert df.filter("a = 151").select(*flipped).first()["X_FLAG_2"]


def test_findings(spark):
    rows = [
        {"NPI": "1", "FULL_NAME": "A", "TOTAL_PAYMENT_AMOUNT": Decimal(301), "PCT_BRAND_CLAIMS": Decimal(80)},
        {"NPI": "2", "FULL_NAME": "", "ORGANIZATION_NAME": "B", "TOTAL_PAYMENT_AMOUNT": Decimal(100), "IS_EXCLUDED": True},
    ]
    profile = profiles(spark, rows)
    scores = spark.createDataFrame([("1", 10, "LOW"), ("2", 70, "CRITICAL")], "NPI string, FRAUD_RISK_SCORE int, RISK_TIER string")
    pairs = spark.createDataFrame([("1", "2"), ("1", "404")], "npi1 string, npi2 string")
    row = serving.compare_findings(pairs, profile, scores).collect()
    assert [tuple(r) for r in row] == [("1", "2", "A", Decimal("3.0"), "A", "B", "B")]
