from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from provwatch import functions as fn
from provwatch.functions.categories import order_index


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def values(spark, items, kind, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column.alias("x")).collect()]


def test_numbers_from_text(spark):
    texts = ["12", "12.7", " 5 ", "-3.5", "", "x", "1,000", "*", None]
    assert values(spark, texts, "string", fn.try_count(F.col("v"))) == [12, 13, 5, -4, None, None, None, None, None]
    money = values(spark, ["1.005", "2.5", "N/A", None], "string", fn.try_money(F.col("v")))
    assert money == [Decimal("1.01"), Decimal("2.50"), None, None]
    assert values(spark, ["7.12345"], "string", fn.try_percent(F.col("v"))) == [Decimal("7.1235")]


@pytest.mark.parametrize(
    ("layout", "text", "expected"),
    [
        (fn.COMPACT_DATE, "20200229", date(2020, 2, 29)),
        (fn.COMPACT_DATE, "20210229", None),
        (fn.COMPACT_DATE, "00000000", None),
        (fn.COMPACT_DATE, "0", None),
        (fn.COMPACT_DATE, "", None),
        (fn.US_DATE, "12/31/2024", date(2024, 12, 31)),
        (fn.US_DATE, "31/12/2024", None),
        (fn.ISO_DATE, "2020-13-01", None),
        (fn.ISO_DATE, "2020-01-13", date(2020, 1, 13)),
    ],
)
def test_dates_from_text(spark, layout, text, expected):
    assert one(spark, fn.try_date(F.lit(text), layout)) == expected


def test_strict_concatenation(spark):
    assert one(spark, fn.concat_strict(" ", F.lit("a"), F.lit("b"), F.lit("c"))) == "a b c"
    assert one(spark, fn.concat_strict(" ", F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, fn.describe("{} of {}!", F.lit(3), F.lit("x"))) == "3 of x!"
    assert one(spark, fn.describe("{}", F.lit(None))) is None
    with pytest.raises(ValueError):
        fn.describe("{} {}", F.lit(1))


def test_surrogate_key_tells_null_from_text(spark):
    import hashlib

    key = one(spark, fn.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(7)))
    assert key == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-7").hexdigest()
    assert key != one(spark, fn.surrogate_key(F.lit("a"), F.lit(""), F.lit(7)))


def test_exact_ratios(spark):
    # 2.01 / 2 is exactly 1.005: a double would fall on the wrong side.
    assert one(spark, fn.ratio(F.lit(Decimal("2.01")), F.lit(2))) == Decimal("1.01")
    assert one(spark, fn.ratio(F.lit(Decimal("-2.01")), F.lit(2))) == Decimal("-1.01")
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.ratio_or_zero(F.lit(5), F.lit(0))) == 0
    assert one(spark, fn.ratio_or_zero(F.lit(5), F.lit(None).cast("int"))) == 0
    assert one(spark, fn.ratio_or_zero(F.lit(None).cast("int"), F.lit(2))) is None
    assert one(spark, fn.percentage(F.lit(1), F.lit(3))) == Decimal("33.33")
    assert one(spark, fn.pct_change(F.lit(90), F.lit(60))) == 50
    assert one(spark, fn.pct_change(F.lit(90), F.lit(0))) is None


def test_rounding_of_doubles(spark):
    got = values(spark, [2.5, -2.5, 0.4, -0.4, 1e6 + 0.5], "double", fn.round_half_away(F.col("v"), 0))
    assert got == [3.0, -3.0, 0.0, 0.0, 1000001.0]
    assert str(got[3]) == "0.0"


def test_ladders(spark):
    steps = [(100, "HIGH"), (10, "LOW")]
    tiers = values(spark, [100, 99, 10, 9, None], "int", fn.tier(F.col("v"), steps, "NONE"))
    assert tiers == ["HIGH", "LOW", "LOW", "NONE", "NONE"]
    strict = values(spark, [100, 101, 11], "int", fn.tier(F.col("v"), steps, "NONE", ">"))
    assert strict == ["LOW", "HIGH", "LOW"]
    codes = values(spark, ["a", "z", None], "string", fn.code_lookup(F.col("v"), {"a": "A"}, "other"))
    assert codes == ["A", "other", "other"]
    assert values(spark, ["y", "x", "q"], "string", order_index(F.col("v"), ["x", "y"])) == [2, 1, None]


def test_flag_count_ignores_unknown(spark):
    assert one(spark, fn.flag_count(F.lit(True), F.lit(None).cast("boolean"), F.lit(True))) == 2


def test_present(spark):
    assert values(spark, ["a", "", None], "string", fn.present(F.col("v"))) == [True, False, False]
