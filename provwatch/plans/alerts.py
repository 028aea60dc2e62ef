"""Investigation alerts from five generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions import describe, ladder, surrogate_key
from provwatch.operators.filters import null_as, union_all
from provwatch.operators.joins import semi_join
from provwatch.operators.windows import keep_by_priority, keep_first
from provwatch.plans.common import stamp

_MONEY = "decimal(28,2)"


def _alert(
    df: DataFrame,
    kind: str,
    key: list[str],
    name: Column,
    specialty: str,
    score: Column,
    risk_tier: Column,
    text: Column,
    exposure: Column,
) -> DataFrame:
    return df.select(
        surrogate_key(*[F.col(c) for c in key], F.lit(kind)).alias("ALERT_ID"),
        F.lit(kind).alias("ALERT_TYPE"),
        "NPI",
        name.alias("PROVIDER_NAME"),
        F.col(specialty).alias("SPECIALTY"),
        "STATE",
        score.cast("int").alias("RISK_SCORE"),
        risk_tier.alias("RISK_TIER"),
        text.alias("ALERT_DESCRIPTION"),
        exposure.cast(_MONEY).alias("FINANCIAL_EXPOSURE"),
    )


def high_score_alerts(scores: DataFrame) -> DataFrame:
    return _alert(
        scores.filter(F.col("RISK_TIER").isin("CRITICAL", "HIGH")),
        "HIGH_RISK_SCORE",
        ["NPI"],
        F.coalesce("FULL_NAME", "ORGANIZATION_NAME"),
        "SPECIALTY",
        F.col("FRAUD_RISK_SCORE"),
        F.col("RISK_TIER"),
        describe("Provider has fraud risk score of {} ({})", F.col("FRAUD_RISK_SCORE"), F.col("RISK_TIER")),
        F.col("TOTAL_FINANCIAL_EXPOSURE"),
    )


def still_active_alerts(exclusions: DataFrame, known: DataFrame) -> DataFrame:
    """Latest current exclusion of each known provider, if it is a high-risk one."""
    current = semi_join(exclusions.filter(F.col("IS_CURRENTLY_EXCLUDED")), known, "NPI")
    latest = keep_first(
        current, ["NPI"], [F.col("EXCLUSION_DATE").desc_nulls_first(), F.col("EXCLUSION_ID").asc()]
    )
    return _alert(
        latest.filter(F.col("IS_HIGH_RISK")),
        "EXCLUDED_STILL_ACTIVE",
        ["NPI"],
        F.coalesce(F.col("NPPES_FULL_NAME"), describe("{} {}", F.col("LAST_NAME"), F.col("FIRST_NAME"))),
        "PROVIDER_SPECIALTY",
        F.lit(100),
        F.lit("CRITICAL"),
        describe(
            'Provider excluded on {} for "{}" but still active in NPPES',
            F.col("EXCLUSION_DATE"),
            F.col("EXCLUSION_REASON"),
        ),
        null_as(_MONEY),
    )


def paid_while_excluded_alerts(payments: DataFrame, known: DataFrame) -> DataFrame:
    """Payments to an excluded provider, per payer. Aggregated first: one provider may hold most rows."""
    totals = (
        payments.filter(F.col("IS_RECIPIENT_EXCLUDED") & F.col("NPI").isNotNull())
        .groupBy("NPI", "FULL_NAME", "SPECIALTY", "STATE", "PAYER_NAME")
        .agg(F.count("*").alias("PAYMENTS"), F.sum("PAYMENT_AMOUNT").alias("AMOUNT"))
    )
    return _alert(
        semi_join(totals, known, "NPI"),
        "PAYMENT_TO_EXCLUDED",
        ["NPI", "PAYER_NAME"],
        F.col("FULL_NAME"),
        "SPECIALTY",
        F.lit(90),
        F.lit("CRITICAL"),
        describe(
            "Excluded provider received {} payments totaling ${} from {}",
            F.col("PAYMENTS"),
            F.col("AMOUNT").cast(_MONEY),
            F.col("PAYER_NAME"),
        ),
        F.col("AMOUNT"),
    )


def prescribed_while_excluded_alerts(prescriptions: DataFrame, known: DataFrame) -> DataFrame:
    totals = (
        prescriptions.filter(F.col("IS_PRESCRIBER_EXCLUDED") & F.col("NPI").isNotNull())
        .groupBy("NPI", "PRESCRIBER_FULL_NAME", "PRESCRIBER_TYPE", "STATE")
        .agg(F.sum("TOTAL_CLAIMS").alias("CLAIMS"), F.sum("TOTAL_DRUG_COST").alias("COST"))
    )
    return _alert(
        semi_join(totals, known, "NPI"),
        "PRESCRIPTION_BY_EXCLUDED",
        ["NPI"],
        F.col("PRESCRIBER_FULL_NAME"),
        "PRESCRIBER_TYPE",
        F.lit(95),
        F.lit("CRITICAL"),
        describe(
            "Excluded provider prescribed {} claims totaling ${}", F.col("CLAIMS"), F.col("COST").cast(_MONEY)
        ),
        F.col("COST"),
    )


def high_brand_alerts(scores: DataFrame) -> DataFrame:
    return _alert(
        scores.filter(F.col("IS_HIGH_BRAND_PRESCRIBER") & ~F.col("IS_EXCLUDED")),
        "HIGH_BRAND_PRESCRIBER",
        ["NPI"],
        F.coalesce("FULL_NAME", "ORGANIZATION_NAME"),
        "SPECIALTY",
        F.col("FRAUD_RISK_SCORE"),
        F.lit("HIGH"),
        describe(
            "Provider has {}% brand prescription rate (potential kickback indicator)",
            F.col("PCT_BRAND_CLAIMS").cast("decimal(9,2)"),
        ),
        F.col("TOTAL_PRESCRIPTION_COST"),
    )


def priority_rank() -> Column:
    kind = F.col("ALERT_TYPE")
    return ladder(
        [
            (kind == "EXCLUDED_STILL_ACTIVE", 1),
            (kind == "PRESCRIPTION_BY_EXCLUDED", 2),
            (kind == "PAYMENT_TO_EXCLUDED", 3),
            ((kind == "HIGH_RISK_SCORE") & (F.col("RISK_TIER") == "CRITICAL"), 4),
            (kind == "HIGH_BRAND_PRESCRIBER", 5),
        ],
        6,
    )


def build_alerts(
    provider_360: DataFrame,
    scores: DataFrame,
    exclusions: DataFrame,
    payments: DataFrame,
    prescriptions: DataFrame,
    alert_date: Column | None = None,
    loaded_at=None,
) -> DataFrame:
    """One row per alert id. The result is unordered: sorting is left to the reader that needs it.

    Rows with the same id differ in name, specialty or state; the one with the largest exposure stays.
    """
    known = provider_360.select("NPI")
    alerts = union_all(
        [
            high_score_alerts(scores),
            still_active_alerts(exclusions, known),
            paid_while_excluded_alerts(payments, known),
            prescribed_while_excluded_alerts(prescriptions, known),
            high_brand_alerts(scores),
        ]
    ).withColumn("PRIORITY_RANK", priority_rank())
    ties = [F.col("FINANCIAL_EXPOSURE").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in ("PROVIDER_NAME", "SPECIALTY", "STATE", "ALERT_DESCRIPTION")
    ]
    kept = keep_by_priority(alerts, ["ALERT_ID"], F.col("PRIORITY_RANK"), ties)
    result = kept.withColumns(
        {
            "ALERT_STATUS": F.lit("PENDING"),
            "ALERT_DATE": F.current_date() if alert_date is None else alert_date,
        }
    ).select(
        "ALERT_ID",
        "ALERT_TYPE",
        "NPI",
        "PROVIDER_NAME",
        "SPECIALTY",
        "STATE",
        "RISK_SCORE",
        "RISK_TIER",
        "ALERT_DESCRIPTION",
        "FINANCIAL_EXPOSURE",
        "ALERT_STATUS",
        "ALERT_DATE",
        "PRIORITY_RANK",
    )
    return stamp(result, loaded_at)
