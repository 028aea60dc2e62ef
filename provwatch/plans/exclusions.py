"""Exclusion list enriched with the provider registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.functions import COMPACT_DATE, clean, code_lookup, ladder, present, surrogate_key, try_date
from provwatch.operators.filters import filter_true
from provwatch.operators.joins import salted_left_join, semi_join, star_join
from provwatch.operators.windows import keep_latest
from provwatch.plans.common import stamp
from provwatch.plans.provider import one_address_per_provider, one_row_per_provider
from provwatch.sources.schemas import bronze_columns

# Exclusion codes and what they stand for.
EXCLUSION_REASONS = {
    "1128a1": "Conviction of program-related crimes",
    "1128a2": "Conviction relating to patient abuse",
    "1128a3": "Felony conviction relating to health care fraud",
    "1128a4": "Felony conviction relating to controlled substance",
    "1128b1": "Misdemeanor conviction relating to health care fraud",
    "1128b2": "Conviction relating to obstruction of an investigation",
    "1128b4": "License revocation or suspension",
    "1128b5": "Exclusion or suspension under federal or state health care program",
    "1128b6": "Claims for excessive charges or unnecessary services",
    "1128b7": "Fraud, kickbacks and other prohibited activities",
    "1128b8": "Entities controlled by a sanctioned individual",
    "1128b14": "Default on health education loan or scholarship obligations",
    "1128b15": "Individuals controlling a sanctioned entity",
    "1128b16": "Making false statements or misrepresentation of material facts",
}
OTHER_REASON = "Other exclusion type"


def build_exclusions(
    leie: DataFrame,
    provider: DataFrame,
    address: DataFrame,
    placeholder_values: tuple[str, ...] = (),
    loaded_at=None,
) -> DataFrame:
    """One row per exclusion (NPI, date and name), with registry details where the NPI is known.

    ``provider`` holds active registry rows. ``placeholder_values`` lists reinstatement dates that mean
    "none", for files whose blanks were turned into zeros; by default only NULL and '' do.

    The exclusion id hashes the NPI, so its duplicates share one NPI: each side is deduplicated before
    the joins, which can then never multiply rows, and gives the same winner as deduplicating after.
    """
    names = bronze_columns("LEIE")
    dated = leie.filter(present(F.col("EXCLDATE")))
    listed = dated.select(
        surrogate_key(*[F.col(c) for c in ("NPI", "EXCLDATE", "LASTNAME", "FIRSTNAME")]).alias("EXCLUSION_ID"),
        try_date(F.col("EXCLDATE"), COMPACT_DATE).alias("EXCLUSION_DATE"),
        *names,
    )
    listed = keep_latest(listed, ["EXCLUSION_ID"], F.col("EXCLUSION_DATE").desc_nulls_last(), names)

    # What the registry knows about the listed NPIs, one row each. Only registry rows that an exclusion
    # refers to are sorted and joined; the salted join spreads blank NPIs, which many exclusions share.
    npis = dated.select("NPI").distinct()
    registry = one_row_per_provider(semi_join(provider, npis, "NPI")).select(
        "NPI",
        F.col("ENTITY_TYPE_DESC").alias("NPPES_ENTITY_TYPE"),
        F.col("PROVIDER_FULL_NAME").alias("NPPES_FULL_NAME"),
        F.col("ORGANIZATION_NAME_LBN").alias("NPPES_ORGANIZATION"),
        F.col("PRIMARY_TAXONOMY_CODE").alias("NPPES_TAXONOMY_CODE"),
        F.col("IS_ACTIVE").alias("NPPES_IS_ACTIVE"),
        F.lit(True).alias("IN_REGISTRY"),
    )
    primary = semi_join(filter_true(address, "IS_PRIMARY"), npis, "NPI")
    places = one_address_per_provider(primary).select(
        "NPI",
        F.col("CITY_NAME").alias("NPPES_CITY"),
        F.col("STATE_CODE").alias("NPPES_STATE"),
        F.col("POSTAL_CODE_5").alias("NPPES_ZIP"),
    )
    known = star_join(npis, [registry, places], "NPI")
    joined = salted_left_join(listed, known, "NPI", spread=["EXCLUSION_ID"])

    reinstated = present(F.col("REINDATE"))
    if placeholder_values:
        reinstated = reinstated & ~F.col("REINDATE").isin(*placeholder_values)
    excluded_now = ~reinstated
    result = joined.select(
        "EXCLUSION_ID",
        "NPI",
        "UPIN",
        clean(F.col("LASTNAME")).alias("LAST_NAME"),
        clean(F.col("FIRSTNAME")).alias("FIRST_NAME"),
        clean(F.col("MIDNAME")).alias("MIDDLE_NAME"),
        clean(F.col("BUSNAME")).alias("BUSINESS_NAME"),
        "NPPES_FULL_NAME",
        "NPPES_ORGANIZATION",
        F.col("GENERAL").alias("PROVIDER_GENERAL_TYPE"),
        F.col("SPECIALTY").alias("PROVIDER_SPECIALTY"),
        "NPPES_ENTITY_TYPE",
        "NPPES_TAXONOMY_CODE",
        clean(F.col("ADDRESS")).alias("ADDRESS"),
        clean(F.col("CITY")).alias("CITY"),
        clean(F.col("STATE")).alias("STATE"),
        F.trim(F.col("ZIP")).alias("ZIP_CODE"),
        "NPPES_CITY",
        "NPPES_STATE",
        "NPPES_ZIP",
        F.col("EXCLTYPE").alias("EXCLUSION_TYPE_CODE"),
        code_lookup(F.col("EXCLTYPE"), EXCLUSION_REASONS, OTHER_REASON).alias("EXCLUSION_REASON"),
        "EXCLUSION_DATE",
        try_date(F.col("REINDATE"), COMPACT_DATE).alias("REINSTATEMENT_DATE"),
        try_date(F.col("WAIVERDATE"), COMPACT_DATE).alias("WAIVER_DATE"),
        F.col("WVRSTATE").alias("WAIVER_STATE"),
        try_date(F.col("DOB"), COMPACT_DATE).alias("DATE_OF_BIRTH"),
        excluded_now.alias("IS_CURRENTLY_EXCLUDED"),
        "NPPES_IS_ACTIVE",
        (excluded_now & F.coalesce(F.col("NPPES_IS_ACTIVE"), F.lit(False))).alias("IS_HIGH_RISK"),
        ladder(
            [(F.col("IN_REGISTRY"), "NPI_MATCH"), (F.col("NPI").isNull(), "NO_NPI_IN_LEIE")],
            "NPI_NOT_FOUND_IN_NPPES",
        ).alias("MATCH_STATUS"),
    )
    return stamp(result, loaded_at)
