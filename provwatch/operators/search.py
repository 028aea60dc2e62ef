"""Substring search by an index of three-character strings.

A text that holds a search term holds each of the term's trigrams. The index lists the keys of every trigram; a search
takes the keys that all of the term's rarest trigrams share, and the caller verifies those rows alone.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provwatch.sources.keyed import rows_of, write_keyed

SIZE = 3
RAREST = 4


def trigrams(text: Column) -> Column:
    """Distinct substrings of three characters; none of a shorter or missing text."""
    places = F.sequence(F.lit(1), F.length(text) - F.lit(SIZE - 1))
    whole = F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(SIZE))))
    return F.when(F.length(text) >= SIZE, whole).otherwise(F.array().cast("array<string>"))


def term_trigrams(term: str) -> list[str]:
    """Trigrams that any match of ``%term%`` must hold; % and _ stand for other characters, so none spans them."""
    pieces = re.split("[%_]", term)
    return sorted({p[i : i + SIZE] for p in pieces for i in range(len(p) - SIZE + 1)})


class TrigramIndex:
    """Postings (GRAM, key) and their counts (GRAM, N), both laid out for lookups by GRAM."""

    def __init__(self, spark: SparkSession, folder: str, key: str) -> None:
        self.key = key
        self.postings, self.counts = (spark.read.parquet(f"{folder}/{name}") for name in ("postings", "counts"))

    @classmethod
    def build(cls, df: DataFrame, folder: str, key: str, texts: Sequence[Column], buckets: int) -> TrigramIndex:
        """Index of the rows of ``df`` that have a key, over all of ``texts``; a written table, as it is read twice."""
        grams = F.array_distinct(F.concat(*[trigrams(t) for t in texts]))
        rows = df.where(F.col(key).isNotNull()).select(F.explode(grams).alias("GRAM"), key).distinct()
        postings = write_keyed(rows, f"{folder}/postings", "GRAM", buckets)
        write_keyed(postings.groupBy("GRAM").agg(F.count("*").alias("N")), f"{folder}/counts", "GRAM", buckets)
        return cls(df.sparkSession, folder, key)

    def candidates(self, term: str, rarest: int = RAREST) -> DataFrame | None:
        """Keys of rows that may match ``%term%``: all that do, and some that do not. None: the term has no trigram."""
        wanted = term_trigrams(term)
        if not wanted:
            return None
        sizes = {r["GRAM"]: r["N"] for r in rows_of(self.counts, "GRAM", *wanted).collect()}  # the term's length at most
        if len(sizes) < len(wanted):
            return self.postings.where(F.lit(False)).select(self.key)
        chosen = sorted(wanted, key=lambda g: (sizes[g], g))[:rarest]
        shared = rows_of(self.postings, "GRAM", *chosen).groupBy(self.key).count()
        return shared.where(F.col("count") == len(chosen)).select(self.key)
