"""Provider search and point lookups that do not scan the profiles.

The folder holds the profiles, alerts and scores laid out by NPI, and a trigram index over number and names. The reports
of ``serving`` then run over the few rows that can answer them, which also verifies what the index found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provwatch.operators.search import TrigramIndex
from provwatch.plans import serving
from provwatch.sources.keyed import BUCKETS, groups_to_read, rows_of, rows_of_keys, write_keyed
from provwatch.sources.sinks import work_folder, write_table

KEY = "NPI"
_TABLES = ("profiles", "alerts", "scores")


class ProviderSearch:
    """Opens the tables that ``build`` left in ``folder``; any session may."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.tables = {name: spark.read.parquet(f"{folder}/{name}") for name in _TABLES}
        self.index = TrigramIndex(spark, f"{folder}/trigrams", KEY)

    @classmethod
    def build(
        cls, provider_360: DataFrame, alerts: DataFrame, scores: DataFrame, folder: str, buckets: int = BUCKETS
    ) -> ProviderSearch:
        """Lay out written model tables; every profile has an NPI."""
        for name, table in zip(_TABLES, (provider_360, alerts, scores), strict=True):
            write_keyed(table, f"{folder}/{name}", KEY, buckets)
        names = [F.col(KEY), F.upper("FULL_NAME"), F.upper("ORGANIZATION_NAME")]
        TrigramIndex.build(provider_360, f"{folder}/trigrams", KEY, names, buckets)
        return cls(provider_360.sparkSession, folder)

    def _possible(self, term: str, *numbers: str) -> DataFrame:
        """Profiles that may match the term, and those of the given numbers; all if the term has no trigram."""
        found = self.index.candidates(term.upper())
        if found is None:
            return self.tables["profiles"]
        if numbers:
            found = found.unionByName(self.spark.createDataFrame([(n,) for n in numbers], f"{KEY} string"))
        keys = write_table(found.distinct(), work_folder(self.spark, "candidates"))
        return rows_of_keys(self.tables["profiles"], KEY, keys)

    def search_providers(self, term: str, limit: int = 50) -> DataFrame:
        return serving.search_providers(self._possible(term), term, limit)

    def compare_search(self, term: str, limit: int = 20) -> DataFrame:
        return serving.compare_search(self._possible(term, term), term, limit)

    def provider_details(self, npi: str) -> DataFrame:
        return serving.provider_details(rows_of(self.tables["profiles"], KEY, npi), npi)

    def provider_alerts(self, npi: str) -> DataFrame:
        return serving.provider_alerts(rows_of(self.tables["alerts"], KEY, npi), npi)

    def risk_score(self, npi: str) -> DataFrame:
        return serving.risk_score(rows_of(self.tables["scores"], KEY, npi), npi)

    def row_groups(self, npi: str) -> DataFrame:
        """Row groups that a lookup of one provider's profile reads."""
        return groups_to_read(self.tables["profiles"], KEY, npi)
