"""Payment and prescription totals per provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions import percentage_or_zero, ratio, ratio_or_zero, surrogate_key, tier
from provwatch.operators.aggregates import any_true, count_where, sum_where, two_stage
from provwatch.operators.joins import star_join
from provwatch.plans.common import stamp

# Size classes.
RECIPIENT_TIERS = [
    (1000000, "MEGA_RECIPIENT"),
    (100000, "MAJOR_RECIPIENT"),
    (10000, "SIGNIFICANT_RECIPIENT"),
    (1000, "MODERATE_RECIPIENT"),
]
VOLUME_TIERS = [(100000, "VERY_HIGH_VOLUME"), (10000, "HIGH_VOLUME"), (1000, "MEDIUM_VOLUME")]


def _sum_of(name: str) -> Column:
    return F.sum(name).alias(name)


def _sum_or_zero(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).alias(name)


def build_payments_summary(payments: DataFrame, loaded_at=None) -> DataFrame:
    """Payment totals per NPI; the empty NPI is a group of its own.

    Rows are first aggregated per provider, payer and year. That makes both distinct counts cheap (they
    run over the small result) and spreads a provider with very many payments over several tasks.
    """
    amount, category, risk = F.col("PAYMENT_AMOUNT"), F.col("PAYMENT_CATEGORY"), F.col("PAYMENT_RISK_TIER")
    per_payer_and_year = [
        F.count("*").alias("TOTAL_PAYMENTS"),
        *[count_where(category == c).alias(f"{c}_PAYMENTS") for c in ("GENERAL", "RESEARCH", "OWNERSHIP")],
        F.sum(amount).alias("TOTAL_PAYMENT_AMOUNT"),
        *[sum_where(amount, category == c).alias(f"{c}_PAYMENT_AMOUNT") for c in ("GENERAL", "RESEARCH")],
        F.sum("INVESTMENT_AMOUNT").alias("TOTAL_INVESTMENT_AMOUNT"),
        F.count(amount).alias("PRICED_PAYMENTS"),
        F.max(amount).alias("MAX_PAYMENT_AMOUNT"),
        *[count_where(risk == r).alias(f"{r}_RISK_PAYMENTS") for r in ("VERY_HIGH", "HIGH")],
        F.min("PAYMENT_DATE").alias("FIRST_PAYMENT_DATE"),
        F.max("PAYMENT_DATE").alias("LAST_PAYMENT_DATE"),
        any_true(F.col("IS_RECIPIENT_EXCLUDED")).alias("IS_EXCLUDED_PROVIDER"),
    ]
    counts = "TOTAL_PAYMENTS GENERAL_PAYMENTS RESEARCH_PAYMENTS OWNERSHIP_PAYMENTS PRICED_PAYMENTS"
    risks = "VERY_HIGH_RISK_PAYMENTS HIGH_RISK_PAYMENTS"
    sums = "TOTAL_PAYMENT_AMOUNT GENERAL_PAYMENT_AMOUNT RESEARCH_PAYMENT_AMOUNT TOTAL_INVESTMENT_AMOUNT"
    totals = two_stage(
        payments.filter(F.col("NPI").isNotNull()),
        ["NPI", "PAYER_NAME", "PAYMENT_YEAR"],
        per_payer_and_year,
        ["NPI"],
        [
            *[_sum_of(c) for c in f"{counts} {risks}".split()],
            *[_sum_or_zero(c) for c in sums.split()],
            F.max("MAX_PAYMENT_AMOUNT").alias("MAX_PAYMENT_AMOUNT"),
            F.count_distinct("PAYER_NAME").alias("UNIQUE_PAYERS"),
            F.min("FIRST_PAYMENT_DATE").alias("FIRST_PAYMENT_DATE"),
            F.max("LAST_PAYMENT_DATE").alias("LAST_PAYMENT_DATE"),
            F.count_distinct("PAYMENT_YEAR").alias("YEARS_WITH_PAYMENTS"),
            any_true(F.col("IS_EXCLUDED_PROVIDER")).alias("IS_EXCLUDED_PROVIDER"),
        ],
    )
    high_risk = F.col("VERY_HIGH_RISK_PAYMENTS") + F.col("HIGH_RISK_PAYMENTS")
    result = totals.select(
        surrogate_key(F.col("NPI")).alias("PROVIDER_PAYMENT_KEY"),
        "NPI",
        "TOTAL_PAYMENTS",
        "GENERAL_PAYMENTS",
        "RESEARCH_PAYMENTS",
        "OWNERSHIP_PAYMENTS",
        *sums.split(),
        ratio(F.col("TOTAL_PAYMENT_AMOUNT"), F.col("PRICED_PAYMENTS")).alias("AVG_PAYMENT_AMOUNT"),
        "MAX_PAYMENT_AMOUNT",
        "UNIQUE_PAYERS",
        *risks.split(),
        high_risk.alias("TOTAL_HIGH_RISK_PAYMENTS"),
        percentage_or_zero(high_risk, F.col("TOTAL_PAYMENTS")).alias("PCT_HIGH_RISK_PAYMENTS"),
        "FIRST_PAYMENT_DATE",
        "LAST_PAYMENT_DATE",
        "YEARS_WITH_PAYMENTS",
        "IS_EXCLUDED_PROVIDER",
        tier(F.col("TOTAL_PAYMENT_AMOUNT"), RECIPIENT_TIERS, "MINOR_RECIPIENT").alias("RECIPIENT_TIER"),
    )
    return stamp(result, loaded_at)


def _prescriber_names(prescriptions: DataFrame) -> DataFrame:
    """Largest name, type and state per NPI.

    A maximum of strings makes Spark aggregate by sorting. Reducing to distinct combinations first is a
    hash aggregation, and leaves about one row per prescriber to sort.
    """
    combinations = prescriptions.select("NPI", "PRESCRIBER_FULL_NAME", "PRESCRIBER_TYPE", "STATE").distinct()
    return combinations.groupBy("NPI").agg(
        F.max("PRESCRIBER_FULL_NAME").alias("PRESCRIBER_NAME"),
        F.max("PRESCRIBER_TYPE").alias("SPECIALTY"),
        F.max("STATE").alias("STATE"),
    )


def build_prescriptions_summary(prescriptions: DataFrame, loaded_at=None) -> DataFrame:
    """Prescription totals per NPI; prescriptions without an NPI have been dropped before."""
    brand, risk = F.col("DRUG_TYPE") == "BRAND", F.col("RISK_TIER")
    claims, cost = F.col("TOTAL_CLAIMS"), F.col("TOTAL_COST")
    volumes = prescriptions.groupBy("NPI").agg(
        F.count("*").alias("TOTAL_DRUG_RECORDS"),
        F.sum("TOTAL_CLAIMS").alias("TOTAL_CLAIMS"),
        F.sum("TOTAL_BENEFICIARIES").alias("TOTAL_BENEFICIARIES"),
        F.sum("TOTAL_30DAY_FILLS").alias("TOTAL_30_DAY_FILLS"),
        F.sum("TOTAL_DRUG_COST").alias("TOTAL_COST"),
        ratio(F.sum("AVG_COST_PER_CLAIM"), F.count("AVG_COST_PER_CLAIM")).alias("AVG_COST_PER_CLAIM"),
        sum_where(F.col("TOTAL_CLAIMS"), brand, 0).alias("BRAND_CLAIMS"),
        sum_where(F.col("TOTAL_DRUG_COST"), brand, 0).alias("BRAND_COST"),
        *[count_where(risk == r).alias(f"{r}_RISK_DRUGS") for r in ("CRITICAL", "VERY_HIGH", "HIGH")],
        any_true(F.col("IS_PRESCRIBER_EXCLUDED")).alias("IS_EXCLUDED_PROVIDER"),
    )
    # A distinct count beside the sums would send all of them by prescriber and drug first.
    drugs = prescriptions.select("NPI", "GENERIC_NAME").distinct().groupBy("NPI")
    drugs = drugs.agg(F.count("GENERIC_NAME").alias("UNIQUE_DRUGS_PRESCRIBED"))
    totals = star_join(volumes, [drugs, _prescriber_names(prescriptions)], "NPI")
    risky = F.col("CRITICAL_RISK_DRUGS") + F.col("VERY_HIGH_RISK_DRUGS") + F.col("HIGH_RISK_DRUGS")
    result = totals.select(
        surrogate_key(F.col("NPI")).alias("PROVIDER_PRESCRIPTION_KEY"),
        "NPI",
        "PRESCRIBER_NAME",
        "SPECIALTY",
        "STATE",
        "TOTAL_DRUG_RECORDS",
        "TOTAL_CLAIMS",
        "TOTAL_BENEFICIARIES",
        "TOTAL_30_DAY_FILLS",
        "TOTAL_COST",
        "AVG_COST_PER_CLAIM",
        ratio_or_zero(cost, claims).alias("COST_PER_CLAIM"),
        "UNIQUE_DRUGS_PRESCRIBED",
        "BRAND_CLAIMS",
        "BRAND_COST",
        percentage_or_zero(F.col("BRAND_CLAIMS"), claims).alias("PCT_BRAND_CLAIMS"),
        percentage_or_zero(F.col("BRAND_COST"), cost).alias("PCT_BRAND_COST"),
        "CRITICAL_RISK_DRUGS",
        "VERY_HIGH_RISK_DRUGS",
        "HIGH_RISK_DRUGS",
        risky.alias("TOTAL_HIGH_RISK_DRUGS"),
        "IS_EXCLUDED_PROVIDER",
        tier(claims, VOLUME_TIERS, "LOW_VOLUME").alias("PRESCRIBER_VOLUME_TIER"),
    )
    return stamp(result, loaded_at)
