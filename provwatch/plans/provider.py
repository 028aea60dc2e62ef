"""Provider master: registry, primary address, primary taxonomy and exclusion flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.functions import ladder
from provwatch.operators.filters import filter_true
from provwatch.operators.joins import distinct_keys, is_matched, star_join
from provwatch.operators.windows import keep_first, keep_latest
from provwatch.plans.common import pick, stamp

PROVIDER_COLUMNS = """
    ENTITY_TYPE_CODE ENTITY_TYPE_DESC ORGANIZATION_NAME_LBN PROVIDER_LAST_NAME PROVIDER_FIRST_NAME
    PROVIDER_MIDDLE_NAME PROVIDER_FULL_NAME PROVIDER_CREDENTIAL PROVIDER_SEX_CODE PROVIDER_SEX_DESC
    IS_SOLE_PROPRIETOR PARENT_ORGANIZATION_LBN EIN PRIMARY_TAXONOMY_CODE ENUMERATION_DATE
    LAST_UPDATE_DATE IS_ACTIVE
"""
ADDRESS_COLUMNS = (
    "ADDRESS_LINE_1 ADDRESS_LINE_2 CITY_NAME STATE_CODE POSTAL_CODE_5 TELEPHONE_NUMBER FULL_ADDRESS"
)
TAXONOMY_COLUMNS = "TAXONOMY_CODE TAXONOMY_CLASSIFICATION TAXONOMY_SPECIALIZATION PROVIDER_TYPE"


def _smallest_per_npi(df: DataFrame, columns: str) -> DataFrame:
    names = columns.split()
    return keep_first(
        df.select("NPI", *names), ["NPI"], [F.col(c).asc_nulls_last() for c in names]
    )


def one_row_per_provider(provider: DataFrame) -> DataFrame:
    """Most recently updated registry row per NPI."""
    return keep_latest(
        provider.select("NPI", *PROVIDER_COLUMNS.split()), ["NPI"], F.col("LAST_UPDATE_DATE").desc_nulls_last()
    )


def one_address_per_provider(address: DataFrame) -> DataFrame:
    return _smallest_per_npi(address, ADDRESS_COLUMNS)


def one_taxonomy_per_provider(taxonomy: DataFrame) -> DataFrame:
    return _smallest_per_npi(taxonomy, TAXONOMY_COLUMNS)


def build_provider(
    provider: DataFrame, address: DataFrame, taxonomy: DataFrame, leie: DataFrame, loaded_at=None
) -> DataFrame:
    """One row per active NPI.

    Every side is reduced to one row per NPI before it is joined, so duplicate primary addresses and
    taxonomies cannot multiply; the row kept is the smallest by address, then by taxonomy. All four
    inputs are then partitioned by NPI, and the joins need no further shuffle.
    """
    listed = distinct_keys(leie, "NPI").withColumn("EXCLUDED_NPI", F.lit(True))
    joined = star_join(
        one_row_per_provider(provider),
        [
            one_address_per_provider(filter_true(address, "IS_PRIMARY")),
            one_taxonomy_per_provider(filter_true(taxonomy, "IS_PRIMARY_TAXONOMY")),
            listed,
        ],
        "NPI",
    )
    entity = F.col("ENTITY_TYPE_CODE")
    result = joined.select(
        *pick("NPI ENTITY_TYPE_CODE ENTITY_TYPE_DESC"),
        ladder([(entity == "1", "Individual"), (entity == "2", "Organization")], "Unknown").alias("ENTITY_TYPE"),
        *pick(
            "",
            ORGANIZATION_NAME="ORGANIZATION_NAME_LBN",
            LAST_NAME="PROVIDER_LAST_NAME",
            FIRST_NAME="PROVIDER_FIRST_NAME",
            MIDDLE_NAME="PROVIDER_MIDDLE_NAME",
            FULL_NAME="PROVIDER_FULL_NAME",
            CREDENTIAL="PROVIDER_CREDENTIAL",
            GENDER_CODE="PROVIDER_SEX_CODE",
            GENDER="PROVIDER_SEX_DESC",
        ),
        *pick("IS_SOLE_PROPRIETOR", PARENT_ORGANIZATION="PARENT_ORGANIZATION_LBN"),
        *pick("EIN ADDRESS_LINE_1 ADDRESS_LINE_2", CITY="CITY_NAME", STATE="STATE_CODE"),
        *pick("", ZIP_CODE="POSTAL_CODE_5", PHONE="TELEPHONE_NUMBER"),
        *pick("FULL_ADDRESS PRIMARY_TAXONOMY_CODE TAXONOMY_CODE"),
        *pick("", SPECIALTY_CLASSIFICATION="TAXONOMY_CLASSIFICATION", SPECIALTY="TAXONOMY_SPECIALIZATION"),
        *pick(
            "PROVIDER_TYPE",
            NPI_ENUMERATION_DATE="ENUMERATION_DATE",
            NPI_LAST_UPDATE_DATE="LAST_UPDATE_DATE",
            IS_NPI_ACTIVE="IS_ACTIVE",
        ),
        is_matched("EXCLUDED_NPI").alias("IS_EXCLUDED"),
    )
    return stamp(result, loaded_at)
