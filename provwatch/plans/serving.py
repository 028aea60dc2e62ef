"""Report, search and comparison queries over the gold tables.

Every function returns a lazy DataFrame; a sort without a limit is part of a report's contract and
applies to small aggregated results only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions import ladder, quotient
from provwatch.operators.aggregates import count_where, group_by_bucket, histogram, mean, rollup_summary
from provwatch.operators.filters import apply_filters, filter_true, like_any
from provwatch.operators.joins import inner_join, left_join, semi_join
from provwatch.operators.ordering import order, order_by_category, top_k
from provwatch.plans.common import pick
from provwatch.plans.ml_features import MEASURES
from provwatch.plans.risk_score import HIGH_BRAND_PCT, TIER_ORDER

_ALERT_COLUMNS = (
    "ALERT_ID ALERT_TYPE NPI PROVIDER_NAME SPECIALTY STATE RISK_SCORE RISK_TIER ALERT_DESCRIPTION"
    " FINANCIAL_EXPOSURE PRIORITY_RANK"
)
# The last key makes the cut at the limit repeatable.
_ALERT_ORDER = [("PRIORITY_RANK",), ("RISK_SCORE", "desc"), ("ALERT_ID",)]


def _whole(value: Column) -> Column:
    return F.round(value, 0)


def _active() -> Column:
    return F.col("HAS_PHARMA_PAYMENTS") | F.col("HAS_PRESCRIPTIONS")


def _name() -> Column:
    return F.coalesce(F.col("FULL_NAME"), F.col("ORGANIZATION_NAME")).alias("NAME")


# --- overview ---------------------------------------------------------------------------------------


def kpis(provider_360: DataFrame) -> DataFrame:
    brand = F.col("PCT_BRAND_CLAIMS")
    return provider_360.agg(
        F.count("*").alias("TOTAL_PROVIDERS"),
        count_where(F.col("HAS_PHARMA_PAYMENTS")).alias("PROVIDERS_WITH_PAYMENTS"),
        count_where(F.col("HAS_PRESCRIPTIONS")).alias("PROVIDERS_WITH_PRESCRIPTIONS"),
        count_where(F.col("IS_EXCLUDED")).alias("EXCLUDED_PROVIDERS"),
        count_where(F.col("IS_EXCLUDED") & _active()).alias("EXCLUDED_WITH_ACTIVITY"),
        _whole(F.sum("TOTAL_PAYMENT_AMOUNT")).alias("TOTAL_PHARMA_PAYMENTS"),
        _whole(F.sum("TOTAL_PRESCRIPTION_COST")).alias("TOTAL_PRESCRIPTION_COSTS"),
        F.round(quotient(F.sum(brand), F.count(brand)), 1).alias("AVG_BRAND_PCT"),
        count_where(brand >= HIGH_BRAND_PCT).alias("HIGH_BRAND_PRESCRIBERS"),
    )


def risk_distribution(scores: DataFrame) -> DataFrame:
    score = F.col("FRAUD_RISK_SCORE")
    tiers = (
        scores.filter(F.col("RISK_TIER").isNotNull())
        .groupBy("RISK_TIER")
        .agg(
            F.count("*").alias("COUNT"),
            F.round(quotient(F.sum(score), F.count(score)), 1).alias("AVG_SCORE"),
            _whole(F.sum("TOTAL_FINANCIAL_EXPOSURE")).alias("TOTAL_EXPOSURE"),
        )
    )
    return order(tiers, [("AVG_SCORE", "desc")])


def alerts_summary(alerts: DataFrame) -> DataFrame:
    groups = alerts.groupBy("ALERT_TYPE", "RISK_TIER").agg(
        F.count("*").alias("NB_ALERTS"), _whole(F.sum("FINANCIAL_EXPOSURE")).alias("TOTAL_EXPOSURE")
    )
    return order(groups, [("NB_ALERTS", "desc")])


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    """The summary rolled up to the alert type; types without any known exposure show 0."""
    types = rollup_summary(
        alerts_summary(alerts),
        ["ALERT_TYPE"],
        {
            "NB_ALERTS": F.sum("NB_ALERTS"),
            "TOTAL_EXPOSURE": F.coalesce(F.sum("TOTAL_EXPOSURE"), F.lit(0)),
        },
    )
    return order(types, [("NB_ALERTS",)])


def exposure_totals(scores: DataFrame, alerts: DataFrame) -> DataFrame:
    """Exposure of all providers, of the two top tiers, and of all alerts, from rounded group sums."""
    exposure = F.col("TOTAL_EXPOSURE")
    top = F.when(F.col("RISK_TIER").isin(*TIER_ORDER[:2]), exposure)
    alerting = alerts_summary(alerts).agg(F.coalesce(F.sum(exposure), F.lit(0)))
    totals = risk_distribution(scores).agg(
        F.coalesce(F.sum(exposure), F.lit(0)).alias("TOTAL_EXPOSURE"),
        F.coalesce(F.sum(top), F.lit(0)).alias("CRITICAL_HIGH_EXPOSURE"),
    )
    return totals.select("*", alerting.scalar().alias("ALERTS_EXPOSURE"))


# --- alerts -----------------------------------------------------------------------------------------


def alerts_filtered(
    alerts: DataFrame,
    alert_type: str | None = None,
    states: Sequence[str] | None = None,
    tiers: Sequence[str] | None = None,
    limit: int = 100,
) -> DataFrame:
    wanted = apply_filters(alerts, ALERT_TYPE=alert_type, STATE=states, RISK_TIER=tiers)
    return top_k(wanted.select(*pick(_ALERT_COLUMNS)), _ALERT_ORDER, limit)


def alerts_list(alerts: DataFrame, alert_type: str | None = None, limit: int = 100) -> DataFrame:
    return alerts_filtered(alerts, alert_type, limit=limit)


def provider_alerts(alerts: DataFrame, npi: str) -> DataFrame:
    return order(alerts.filter(F.col("NPI") == npi), [("PRIORITY_RANK",)])


def alert_filter_options(alerts: DataFrame) -> DataFrame:
    """Values to choose from, as (FILTER, VALUE) rows."""
    options = [
        alerts.select(F.lit(name).alias("FILTER"), F.col(name).alias("VALUE")).distinct()
        for name in ("STATE", "RISK_TIER")
    ]
    chosen = options[0].unionByName(options[1]).filter(F.col("VALUE").isNotNull())
    return order(chosen, [("FILTER",), ("VALUE",)])


def alert_batch_metrics(batch: DataFrame) -> DataFrame:
    """Headline numbers of any selection of alerts."""
    return batch.agg(
        F.count("*").alias("TOTAL_ALERTS"),
        count_where(F.col("RISK_TIER") == "CRITICAL").alias("CRITICAL_ALERTS"),
        count_where(F.col("RISK_TIER") == "HIGH").alias("HIGH_ALERTS"),
        F.coalesce(F.sum("FINANCIAL_EXPOSURE"), F.lit(0)).alias("TOTAL_EXPOSURE"),
    )


def alerts_by_priority(batch: DataFrame) -> DataFrame:
    return batch.groupBy("PRIORITY_RANK").agg(F.count("*").alias("COUNT"))


def alerts_by_tier(batch: DataFrame) -> DataFrame:
    return batch.groupBy("RISK_TIER").agg(F.count("*").alias("COUNT"))


# --- providers --------------------------------------------------------------------------------------


def provider_details(provider_360: DataFrame, npi: str) -> DataFrame:
    return provider_360.filter(F.col("NPI") == npi)


def _name_like(pattern: str) -> Column:
    return like_any([F.upper("FULL_NAME"), F.upper("ORGANIZATION_NAME")], pattern)


def search_providers(provider_360: DataFrame, term: str, limit: int = 50) -> DataFrame:
    """Providers whose NPI or name contains the term, largest exposure first."""
    if len(term) < 3:
        raise ValueError("search terms need at least 3 characters")
    pattern = f"%{term.upper()}%"
    hits = provider_360.filter(F.col("NPI").like(pattern.replace("\\", "\\\\")) | _name_like(pattern)).select(
        "NPI", _name(), *pick("ENTITY_TYPE SPECIALTY STATE IS_EXCLUDED TOTAL_FINANCIAL_EXPOSURE")
    )
    return top_k(hits, [("TOTAL_FINANCIAL_EXPOSURE", "desc", "last"), ("NPI",)], limit)


def compare_search(provider_360: DataFrame, term: str, limit: int = 20) -> DataFrame:
    """Providers with this NPI or with the term in their name."""
    hits = provider_360.filter((F.col("NPI") == term) | _name_like(f"%{term}%".upper()))
    return top_k(hits.select("NPI", _name(), *pick("SPECIALTY STATE CITY")), [("NPI",)], limit)


def excluded_with_activity(provider_360: DataFrame, limit: int = 100) -> DataFrame:
    active = filter_true(provider_360, "IS_EXCLUDED").filter(_active())
    columns = active.select(
        "NPI",
        _name(),
        *pick("SPECIALTY STATE EXCLUSION_REASON EXCLUSION_DATE TOTAL_PAYMENT_AMOUNT TOTAL_PRESCRIPTION_COST"),
        "TOTAL_FINANCIAL_EXPOSURE",
    )
    return top_k(columns, [("TOTAL_FINANCIAL_EXPOSURE", "desc"), ("NPI",)], limit)


def high_risk_examples(provider_360: DataFrame) -> DataFrame:
    """The ten largest excluded providers that are still active."""
    examples = excluded_with_activity(provider_360, 10)
    return examples.select(*pick("NPI NAME SPECIALTY STATE EXCLUSION_REASON TOTAL_FINANCIAL_EXPOSURE"))


def risk_score(scores: DataFrame, npi: str) -> DataFrame:
    return scores.filter(F.col("NPI") == npi).select("FRAUD_RISK_SCORE", "RISK_TIER")


def ml_features(features: DataFrame, npi: str) -> DataFrame:
    return features.filter(F.col("NPI") == npi).select(
        *pick("NPI PEER_COUNT"),
        *[f"{name}_ZSCORE" for name in MEASURES],
        *pick("PAYMENT_TO_RX_RATIO AVG_COST_PER_CLAIM PAYMENT_VS_PEER_RATIO UNIQUE_DRUGS_PRESCRIBED"),
        *pick("DRUG_CONCENTRATION_HHI TOP_DRUG_PCT TOP_3_DRUGS_PCT IS_CONCENTRATED_PRESCRIBER"),
        *pick("UNIQUE_PHARMA_COMPANIES TOP_PAYER_PCT PCT_GENERAL_PAYMENTS PCT_RESEARCH_PAYMENTS"),
        "IS_SINGLE_PAYER_RECIPIENT",
        *[f"{name}_PERCENTILE" for name in MEASURES],
        *pick("IS_MULTI_DIMENSION_OUTLIER ANOMALY_FLAG_COUNT"),
    )


def anomaly_banner(features: DataFrame) -> DataFrame:
    """Banner colour per provider from its anomaly flags."""
    flags = F.coalesce(F.col("ANOMALY_FLAG_COUNT"), F.lit(0))
    colour = ladder(
        [((flags >= 3) | F.col("IS_MULTI_DIMENSION_OUTLIER"), "RED"), (flags >= 1, "ORANGE")], "GREEN"
    )
    return features.select(
        *pick("NPI ANOMALY_FLAG_COUNT IS_MULTI_DIMENSION_OUTLIER"), colour.alias("BANNER")
    )


def outlier_labels(features: DataFrame) -> DataFrame:
    """'Outlier' per dimension whose rounded z-score exceeds 2, else NULL."""
    return features.select(
        "NPI",
        *[F.when(F.col(f"{name}_ZSCORE") > 2, "Outlier").alias(f"{name}_LABEL") for name in MEASURES],
    )


def percentile_bands(features: DataFrame) -> DataFrame:
    def band(name: str) -> Column:
        value = F.coalesce(F.col(f"{name}_PERCENTILE"), F.lit(0.0))
        return ladder([(value >= 90, "RED"), (value >= 75, "YELLOW")], "GREEN").alias(f"{name}_BAND")

    return features.select("NPI", *[band(name) for name in MEASURES])


# --- analytics --------------------------------------------------------------------------------------


def payments_by_state(payments_summary: DataFrame, provider_360: DataFrame) -> DataFrame:
    paid = inner_join(
        payments_summary.select("NPI", "TOTAL_PAYMENT_AMOUNT"),
        provider_360.filter(F.col("STATE").isNotNull()).select("NPI", "STATE"),
        "NPI",
    )
    amount = F.col("TOTAL_PAYMENT_AMOUNT")
    states = paid.groupBy("STATE").agg(
        F.count("*").alias("PROVIDER_COUNT"),  # both sides have one row per NPI
        F.sum(amount).alias("TOTAL_PAYMENTS"),
        mean(amount).alias("AVG_PAYMENT"),
    )
    return order(states, [("TOTAL_PAYMENTS", "desc")])


def top_states(payments_summary: DataFrame, provider_360: DataFrame, n: int = 15) -> DataFrame:
    states = payments_by_state(payments_summary, provider_360)
    return top_k(states, [("TOTAL_PAYMENTS", "desc", "last"), ("STATE",)], n)


def top_recipients(payments_summary: DataFrame, provider_360: DataFrame, limit: int = 100) -> DataFrame:
    """Largest recipients, excluded providers first."""
    joined = inner_join(
        payments_summary.select(*pick("NPI TOTAL_PAYMENT_AMOUNT RECIPIENT_TIER")),
        provider_360.select(*pick("NPI FULL_NAME ORGANIZATION_NAME SPECIALTY STATE IS_EXCLUDED")),
        "NPI",
    )
    columns = joined.select(
        "NPI", _name(), *pick("SPECIALTY STATE TOTAL_PAYMENT_AMOUNT RECIPIENT_TIER IS_EXCLUDED")
    )
    return top_k(columns, [("IS_EXCLUDED", "desc"), ("TOTAL_PAYMENT_AMOUNT", "desc"), ("NPI",)], limit)


def recipient_tiers(payments_summary: DataFrame) -> DataFrame:
    known = payments_summary.filter(F.col("RECIPIENT_TIER").isNotNull())
    return known.groupBy("RECIPIENT_TIER").agg(
        F.count("*").alias("COUNT"), F.sum("TOTAL_PAYMENT_AMOUNT").alias("TOTAL")
    )


def payment_histogram(payments_summary: DataFrame, provider_360: DataFrame, bins: int = 50) -> DataFrame:
    """Distribution over all recipients that have a profile."""
    known = semi_join(payments_summary.select("NPI", "TOTAL_PAYMENT_AMOUNT"), provider_360, "NPI")
    return histogram(known, "TOTAL_PAYMENT_AMOUNT", bins)


def volume_tiers(prescriptions_summary: DataFrame) -> DataFrame:
    known = prescriptions_summary.filter(F.col("PRESCRIBER_VOLUME_TIER").isNotNull())
    return known.groupBy("PRESCRIBER_VOLUME_TIER").agg(
        F.count("*").alias("COUNT"), F.sum("TOTAL_COST").alias("TOTAL_COST")
    )


def brand_buckets(prescriptions_summary: DataFrame) -> DataFrame:
    percent = F.col("PCT_BRAND_CLAIMS")
    bucket = ladder(
        [(percent >= 80, "High Brand (>=80%)"), (percent >= 50, "Medium Brand (50-80%)")],
        "Low Brand (<50%)",
    )
    return group_by_bucket(prescriptions_summary, "BRAND_CATEGORY", bucket, [F.count("*").alias("COUNT")])


def top_prescribers(prescriptions_summary: DataFrame, limit: int = 25) -> DataFrame:
    columns = prescriptions_summary.select(
        *pick("NPI PRESCRIBER_NAME SPECIALTY STATE TOTAL_CLAIMS TOTAL_COST PCT_BRAND_CLAIMS"),
        "IS_EXCLUDED_PROVIDER",
    )
    return top_k(columns, [("TOTAL_COST", "desc"), ("NPI",)], limit)


def risk_funnel(scores: DataFrame) -> DataFrame:
    """Provider count per tier in severity order, with its share of the first tier present."""
    tiers = risk_distribution(scores).select("RISK_TIER", "COUNT", "AVG_SCORE", "TOTAL_EXPOSURE").dropna()
    first = order_by_category(tiers, "RISK_TIER", TIER_ORDER).limit(1).select("COUNT").scalar()
    shares = tiers.withColumn("PERCENT_OF_FIRST", F.round(quotient(F.col("COUNT"), first, 100), 2))
    return order_by_category(shares, "RISK_TIER", TIER_ORDER)


def score_histogram(scores: DataFrame, bins: int = 50) -> DataFrame:
    """Distribution of all positive scores."""
    return histogram(scores.filter(F.col("FRAUD_RISK_SCORE") > 0), "FRAUD_RISK_SCORE", bins)


def risk_summary(scores: DataFrame) -> DataFrame:
    """Headline risk numbers; the mean score is the plain mean of the tier means."""
    tier, count, score = F.col("RISK_TIER"), F.col("COUNT"), F.col("AVG_SCORE")
    return risk_distribution(scores).agg(
        F.coalesce(F.sum(F.when(tier == "CRITICAL", count)), F.lit(0)).alias("CRITICAL_COUNT"),
        F.coalesce(F.sum(F.when(tier == "HIGH", count)), F.lit(0)).alias("HIGH_COUNT"),
        F.sum("TOTAL_EXPOSURE").alias("TOTAL_EXPOSURE"),
        F.round(quotient(F.sum(score), F.count(score)), 1).alias("AVG_RISK_SCORE"),
    )


# --- comparison -------------------------------------------------------------------------------------


def providers_with_scores(provider_360: DataFrame, scores: DataFrame) -> DataFrame:
    return left_join(provider_360, scores.select(*pick("NPI FRAUD_RISK_SCORE RISK_TIER")), "NPI")


def provider_with_score(provider_360: DataFrame, scores: DataFrame, npi: str) -> DataFrame:
    return providers_with_scores(provider_details(provider_360, npi), scores)


def _benchmarks() -> list[Column]:
    return [
        mean(F.col("TOTAL_PAYMENT_AMOUNT")).alias("AVG_PAYMENTS"),
        mean(F.col("TOTAL_PRESCRIPTION_COST")).alias("AVG_RX_COST"),
        mean(F.col("PCT_BRAND_CLAIMS")).alias("AVG_BRAND_PCT"),
        mean(F.col("FRAUD_RISK_SCORE")).alias("AVG_RISK_SCORE"),
        F.count("*").alias("PEER_COUNT"),
    ]


def peer_benchmark(provider_360: DataFrame, scores: DataFrame, specialty: str, state: str) -> DataFrame:
    """Averages over one specialty and state; filtered before the join."""
    peers = provider_360.filter((F.col("SPECIALTY") == specialty) & (F.col("STATE") == state))
    return providers_with_scores(peers, scores).agg(*_benchmarks())


def peer_benchmarks(provider_360: DataFrame, scores: DataFrame) -> DataFrame:
    """The same averages for every specialty and state at once."""
    known = provider_360.filter(F.col("SPECIALTY").isNotNull() & F.col("STATE").isNotNull())
    return providers_with_scores(known, scores).groupBy("SPECIALTY", "STATE").agg(*_benchmarks())


_COMPARED = {
    "PAY": "TOTAL_PAYMENT_AMOUNT",
    "RX": "TOTAL_PRESCRIPTION_COST",
    "EXPOSURE": "TOTAL_FINANCIAL_EXPOSURE",
    "BRAND": "PCT_BRAND_CLAIMS",
    "SCORE": "FRAUD_RISK_SCORE",
}


def _nonblank(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def pair_sides(pairs: DataFrame, provider_360: DataFrame, scores: DataFrame) -> DataFrame:
    """Look up both providers of each ``(npi1, npi2)`` pair; pairs with an unknown side drop out."""
    profile = providers_with_scores(provider_360, scores).select(
        "NPI",
        F.coalesce(_nonblank("FULL_NAME"), _nonblank("ORGANIZATION_NAME"), F.lit("Unknown")).alias("NAME"),
        "IS_EXCLUDED",
        *[F.coalesce(F.col(column), F.lit(0)).alias(name) for name, column in _COMPARED.items()],
    )
    for side in (1, 2):
        renamed = profile.select(
            *[F.col(c).alias(f"npi{side}" if c == "NPI" else f"{c}{side}") for c in profile.columns]
        )
        pairs = pairs.join(renamed, f"npi{side}")
    return pairs


def comparison_flags(
    value1: Column, value2: Column, name: str, higher_is_worse: bool = True
) -> list[Column]:
    """Which side stands out: the first differs from the second by more than half of the second."""
    gap = F.lit(2) * (value1 - value2) * F.signum(value2).cast("int")
    above, below = gap > F.abs(value2), gap < -F.abs(value2)
    first, second = (above, below) if higher_is_worse else (below, above)
    return [
        (F.coalesce(side, F.lit(False)) & (value2 != 0)).alias(f"{name}_FLAG_{n}")
        for n, side in ((1, first), (2, second))
    ]


def compare_pairs(pairs: DataFrame, provider_360: DataFrame, scores: DataFrame) -> DataFrame:
    sides = pair_sides(pairs, provider_360, scores)
    flags = [
        flag
        for name in ("PAY", "RX", "BRAND")
        for flag in comparison_flags(F.col(f"{name}1"), F.col(f"{name}2"), name)
    ]
    return sides.select("npi1", "npi2", *flags)


def compare_normalised(pairs: DataFrame, provider_360: DataFrame, scores: DataFrame) -> DataFrame:
    """Amounts scaled to the larger of the pair (at least 1) as 100; brand share and score as they are."""
    sides = pair_sides(pairs, provider_360, scores)

    def scaled(name: str, side: int) -> Column:
        largest = F.greatest(F.col(f"{name}1"), F.col(f"{name}2"), F.lit(1))
        return F.round(quotient(F.col(f"{name}{side}"), largest, 100), 2).alias(f"{name}_{side}")

    return sides.select(
        "npi1",
        "npi2",
        *[scaled(name, side) for name in ("PAY", "RX") for side in (1, 2)],
        *[F.col(f"{name}{side}").alias(f"{name}_{side}") for name in ("BRAND", "SCORE") for side in (1, 2)],
    )


def compare_findings(pairs: DataFrame, provider_360: DataFrame, scores: DataFrame) -> DataFrame:
    """Name of the provider each finding points at, NULL where there is none.

    The payment ratio is larger over smaller.
    """
    sides = pair_sides(pairs, provider_360, scores)

    def higher(name: str) -> Column:
        return F.when(F.col(f"{name}1") > F.col(f"{name}2"), F.col("NAME1")).otherwise(F.col("NAME2"))

    def either(name: str, bound: int) -> Column:
        return (F.col(f"{name}1") >= bound) | (F.col(f"{name}2") >= bound)

    most, least = F.greatest("PAY1", "PAY2"), F.least("PAY1", "PAY2")
    far_more = (least > 0) & (most > F.lit(3) * least)
    excluded = F.when(F.col("IS_EXCLUDED1"), F.col("NAME1")).when(F.col("IS_EXCLUDED2"), F.col("NAME2"))
    return sides.select(
        "npi1",
        "npi2",
        F.when(far_more, higher("PAY")).alias("MORE_PAYMENTS"),
        F.when(far_more, F.round(quotient(most, least), 1)).alias("PAYMENT_RATIO"),
        F.when(either("BRAND", HIGH_BRAND_PCT), higher("BRAND")).alias("HIGH_BRAND"),
        F.when(either("SCORE", 70), higher("SCORE")).alias("HIGH_RISK"),
        excluded.alias("EXCLUDED"),
    )
