from __future__ import annotations

import pytest

LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(45))

AWKWARD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n ", None, None),
    (4, "one", "fr", "b"),
    (5, "one two three", "fr", "b"),
    (6, f"alpha {PASSAGE} beta gamma", "en", "a"),
    (7, f"other words {PASSAGE}\nand more of them", "en", "a"),
    (8, LONG, "en", "a"),
    (9, LONG + " tail", "en", "a"),
    (10, "x" * 20_000, "de", "c"),
    (11, "Ünï çödé 梦 😀   ▁ <s> x y", "de", "c"),
    (12, "same text in two rows", "en", "a"),
    (12, "same text in two rows", "en", "a"),
    (13, "Same TEXT in two rows", "en", "a"),
    (None, "a row without an id that is long enough", "en", None),
    (14, "a row without an id that is long enough", None, "d"),
]


@pytest.fixture
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and further columns whose names operators use inside."""
    rows = [(*r, "x", 1, 0.5, r[0]) for r in AWKWARD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, row_key string, n int, score double, id long"
    ).repartition(3)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, toxic int")
