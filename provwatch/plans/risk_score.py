"""Additive fraud risk score."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions import tier
from provwatch.plans.common import pick, stamp

# Risk classes of the raw score, and the order in which they are shown.
RISK_TIERS = [(70, "CRITICAL"), (50, "HIGH"), (30, "MEDIUM"), (10, "LOW")]
TIER_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "MINIMAL"]

HIGH_BRAND_PCT = 80


def _points(condition: Column, points: int) -> Column:
    return F.when(condition, points).otherwise(0)


def _ramp(percent: Column, threshold: int) -> Column:
    """A tenth of the percentage, and the full 10 points from the threshold on."""
    tenth = percent.cast("decimal(9,2)") * F.lit(Decimal("0.1"))
    return F.when(percent >= threshold, F.lit(10)).otherwise(tenth)


def raw_score() -> Column:
    active = F.col("HAS_PHARMA_PAYMENTS") | F.col("HAS_PRESCRIPTIONS")
    recipient = F.col("RECIPIENT_TIER")
    return (
        _points(F.col("IS_EXCLUDED"), 25)
        + _points(F.col("IS_EXCLUDED_HIGH_RISK"), 15)
        + F.when(recipient == "MEGA_RECIPIENT", 10).when(recipient == "MAJOR_RECIPIENT", 5).otherwise(0)
        + _ramp(F.col("PCT_HIGH_RISK_PAYMENTS"), 50)
        + _ramp(F.col("PCT_BRAND_CLAIMS"), HIGH_BRAND_PCT)
        + F.least(F.col("TOTAL_HIGH_RISK_DRUGS"), F.lit(10))
        + _points(F.col("HAS_PHARMA_PAYMENTS") & F.col("HAS_PRESCRIPTIONS"), 10)
        # Staging keeps active providers only, so this rule applies to other inputs.
        + _points(~F.col("IS_NPI_ACTIVE") & active, 10)
    )


def build_risk_score(provider_360: DataFrame, loaded_at=None) -> DataFrame:
    """Score 0 to 100 and tier per provider, as a projection without any shuffle.

    The tier uses the unrounded score: 69.6 shows as 70 but is HIGH.
    """
    scored = provider_360.withColumn("RAW_RISK_SCORE", raw_score())
    result = scored.select(
        *pick("NPI FULL_NAME ORGANIZATION_NAME ENTITY_TYPE SPECIALTY STATE"),
        F.least(F.round("RAW_RISK_SCORE", 0), F.lit(100)).cast("int").alias("FRAUD_RISK_SCORE"),
        tier(F.col("RAW_RISK_SCORE"), RISK_TIERS, "MINIMAL").alias("RISK_TIER"),
        *pick("IS_EXCLUDED IS_EXCLUDED_HIGH_RISK"),
        (F.col("PCT_BRAND_CLAIMS") >= HIGH_BRAND_PCT).alias("IS_HIGH_BRAND_PRESCRIBER"),
        F.coalesce(F.col("RECIPIENT_TIER").isin("MEGA_RECIPIENT", "MAJOR_RECIPIENT"), F.lit(False)).alias(
            "IS_MAJOR_PAYMENT_RECIPIENT"
        ),
        *pick("TOTAL_PAYMENT_AMOUNT TOTAL_PRESCRIPTION_COST TOTAL_FINANCIAL_EXPOSURE RECIPIENT_TIER"),
        *pick("PCT_HIGH_RISK_PAYMENTS PCT_BRAND_CLAIMS TOTAL_HIGH_RISK_DRUGS"),
        *pick("HAS_PHARMA_PAYMENTS HAS_PRESCRIPTIONS IS_NPI_ACTIVE"),
    )
    return stamp(result, loaded_at)
