"""The 360-degree provider profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.operators.joins import is_matched, star_join
from provwatch.operators.windows import keep_first
from provwatch.plans.common import pick, stamp


def latest_exclusion(exclusions: DataFrame) -> DataFrame:
    """One exclusion per NPI; an unreadable date counts as the latest."""
    return keep_first(
        exclusions.filter(F.col("NPI").isNotNull()).select(
            *pick("NPI EXCLUSION_ID EXCLUSION_REASON EXCLUSION_DATE IS_CURRENTLY_EXCLUDED IS_HIGH_RISK")
        ),
        ["NPI"],
        [F.col("EXCLUSION_DATE").desc_nulls_first(), F.col("EXCLUSION_ID").asc()],
    ).select(
        *pick("NPI EXCLUSION_REASON EXCLUSION_DATE IS_CURRENTLY_EXCLUDED", IS_EXCLUDED_HIGH_RISK="IS_HIGH_RISK")
    )


def _or_zero(source: str, name: str | None = None) -> Column:
    return F.coalesce(F.col(source), F.lit(0)).alias(name or source)


def build_provider_360(
    provider: DataFrame, pay_sum: DataFrame, rx_sum: DataFrame, exclusions: DataFrame, loaded_at=None
) -> DataFrame:
    """One row per provider. All four sides are unique by NPI, so the joins share one partitioning."""
    paid = pay_sum.select(
        *pick(
            "NPI TOTAL_PAYMENTS TOTAL_PAYMENT_AMOUNT UNIQUE_PAYERS RECIPIENT_TIER PCT_HIGH_RISK_PAYMENTS"
            " FIRST_PAYMENT_DATE LAST_PAYMENT_DATE"
        ),
        F.lit(True).alias("PAID"),
    )
    prescribed = rx_sum.select(
        *pick(
            "NPI TOTAL_CLAIMS TOTAL_COST UNIQUE_DRUGS_PRESCRIBED PCT_BRAND_CLAIMS PRESCRIBER_VOLUME_TIER"
            " TOTAL_HIGH_RISK_DRUGS"
        ),
        F.lit(True).alias("PRESCRIBED"),
    )
    joined = star_join(provider.drop("_loaded_at"), [paid, prescribed, latest_exclusion(exclusions)], "NPI")
    result = joined.select(
        *pick("NPI ENTITY_TYPE FULL_NAME ORGANIZATION_NAME CREDENTIAL GENDER CITY STATE ZIP_CODE PHONE"),
        *pick("SPECIALTY_CLASSIFICATION SPECIALTY PROVIDER_TYPE IS_NPI_ACTIVE NPI_ENUMERATION_DATE"),
        *pick("IS_EXCLUDED EXCLUSION_REASON EXCLUSION_DATE IS_CURRENTLY_EXCLUDED"),
        F.coalesce(F.col("IS_EXCLUDED_HIGH_RISK"), F.lit(False)).alias("IS_EXCLUDED_HIGH_RISK"),
        _or_zero("TOTAL_PAYMENTS"),
        _or_zero("TOTAL_PAYMENT_AMOUNT"),
        _or_zero("UNIQUE_PAYERS"),
        "RECIPIENT_TIER",
        _or_zero("PCT_HIGH_RISK_PAYMENTS"),
        "FIRST_PAYMENT_DATE",
        "LAST_PAYMENT_DATE",
        _or_zero("TOTAL_CLAIMS", "TOTAL_PRESCRIPTION_CLAIMS"),
        _or_zero("TOTAL_COST", "TOTAL_PRESCRIPTION_COST"),
        _or_zero("UNIQUE_DRUGS_PRESCRIBED"),
        _or_zero("PCT_BRAND_CLAIMS"),
        "PRESCRIBER_VOLUME_TIER",
        _or_zero("TOTAL_HIGH_RISK_DRUGS"),
        is_matched("PAID").alias("HAS_PHARMA_PAYMENTS"),
        is_matched("PRESCRIBED").alias("HAS_PRESCRIPTIONS"),
        (
            F.coalesce(F.col("TOTAL_PAYMENT_AMOUNT"), F.lit(0)) + F.coalesce(F.col("TOTAL_COST"), F.lit(0))
        ).alias("TOTAL_FINANCIAL_EXPOSURE"),
    )
    return stamp(result, loaded_at)
