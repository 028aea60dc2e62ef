"""Peer comparison, concentration and percentile features per provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions import flag_count, quotient, ratio_or_null, round_half_away
from provwatch.operators.aggregates import hhi_of_weights, mean, sum_where
from provwatch.operators.filters import having
from provwatch.operators.joins import left_join, salted_left_join
from provwatch.operators.ranking import exact_medians, percentile_ranks
from provwatch.operators.windows import top_sums
from provwatch.plans.common import pick, stamp

PEERS = ["SPECIALTY_GROUP", "STATE_GROUP"]

# Measures compared with peers: short name, column of the profile.
MEASURES = {
    "PAYMENT": "TOTAL_PAYMENT_AMOUNT",
    "RX_COST": "TOTAL_PRESCRIPTION_COST",
    "BRAND_PCT": "PCT_BRAND_CLAIMS",
    "CLAIMS": "TOTAL_PRESCRIPTION_CLAIMS",
}
MINIMUM_PEERS = 5
CONCENTRATED_HHI = 2500
OUTLIER_Z = 2
SINGLE_PAYER_AMOUNT = 10000


def with_peer_groups(provider_360: DataFrame) -> DataFrame:
    return provider_360.withColumns(
        {
            "SPECIALTY_GROUP": F.coalesce(F.col("SPECIALTY"), F.lit("UNKNOWN")),
            "STATE_GROUP": F.coalesce(F.col("STATE"), F.lit("UNKNOWN")),
        }
    )


def _active(provider_360: DataFrame) -> DataFrame:
    return with_peer_groups(provider_360).filter(
        (F.col("TOTAL_PAYMENT_AMOUNT") > 0) | (F.col("TOTAL_PRESCRIPTION_COST") > 0)
    )


def build_peer_stats(provider_360: DataFrame) -> DataFrame:
    """Mean and sample deviation of each measure over active providers, for groups of at least five."""
    grouped = (
        _active(provider_360)
        .groupBy(*PEERS)
        .agg(
            F.count("*").alias("PEER_COUNT"),
            *[mean(F.col(c)).alias(f"PEER_AVG_{name}") for name, c in MEASURES.items()],
            *[
                F.stddev_samp(F.col(c).cast("double")).alias(f"PEER_STDDEV_{name}")
                for name, c in MEASURES.items()
            ],
        )
    )
    return having(grouped, F.col("PEER_COUNT") >= MINIMUM_PEERS)


def build_peer_medians(provider_360: DataFrame) -> DataFrame:
    """Exact medians of payments and prescription cost per peer group (not part of the feature table)."""
    return exact_medians(
        _active(provider_360),
        PEERS,
        {"PEER_MEDIAN_PAYMENT": MEASURES["PAYMENT"], "PEER_MEDIAN_RX_COST": MEASURES["RX_COST"]},
    )


def build_drug_concentration(prescriptions: DataFrame) -> DataFrame:
    """Herfindahl index and top shares of a prescriber's drugs, by claims.

    A drug whose claims are all unknown ranks first, so it takes a place among the top drugs with 0.
    """
    # Both uses below share this aggregate's shuffle; the filter, which the join would add to one of them
    # only, keeps them alike.
    drugs = (
        prescriptions.filter(F.col("NPI").isNotNull())
        .groupBy("NPI", "GENERIC_NAME")
        .agg(F.sum("TOTAL_CLAIMS").alias("DRUG_CLAIMS"))
    )
    totals = drugs.groupBy("NPI").agg(
        F.count("GENERIC_NAME").alias("UNIQUE_DRUGS"),
        F.sum("DRUG_CLAIMS").alias("TOTAL_CLAIMS"),
        hhi_of_weights(F.col("DRUG_CLAIMS")).alias("DRUG_HHI"),
    )
    leaders = top_sums(drugs, ["NPI"], "DRUG_CLAIMS", ["GENERIC_NAME"], [1, 3])
    return left_join(totals, leaders, "NPI").select(
        *pick("NPI UNIQUE_DRUGS TOTAL_CLAIMS DRUG_HHI"),
        quotient(F.col("TOP_1"), F.col("TOTAL_CLAIMS"), 100).alias("TOP_DRUG_PCT"),
        quotient(F.col("TOP_3"), F.col("TOTAL_CLAIMS"), 100).alias("TOP_3_DRUGS_PCT"),
    )


def build_pharma_diversity(payments: DataFrame) -> DataFrame:
    """Payer mix per provider. A payer counts once per category, so shares are per payer and category."""
    per_payer = (
        payments.filter(F.col("NPI").isNotNull())
        .groupBy("NPI", "PAYER_NAME", "PAYMENT_CATEGORY")
        .agg(F.sum("PAYMENT_AMOUNT").alias("PAYER_TOTAL"))
    )
    amount, category = F.col("PAYER_TOTAL"), F.col("PAYMENT_CATEGORY")
    totals = per_payer.groupBy("NPI").agg(
        F.count_distinct("PAYER_NAME").alias("UNIQUE_PHARMA_COMPANIES"),
        F.count("*").alias("TOTAL_PAYMENT_RECORDS"),
        F.max(amount).alias("LARGEST"),
        F.sum(amount).alias("ALL"),
        sum_where(amount, category == "GENERAL", 0).alias("GENERAL"),
        sum_where(amount, category == "RESEARCH", 0).alias("RESEARCH"),
    )
    return totals.select(
        *pick("NPI UNIQUE_PHARMA_COMPANIES TOTAL_PAYMENT_RECORDS"),
        quotient(F.col("LARGEST"), F.col("ALL"), 100).alias("TOP_PAYER_PCT"),
        quotient(F.col("GENERAL"), F.col("ALL"), 100).alias("PCT_GENERAL_PAYMENTS"),
        quotient(F.col("RESEARCH"), F.col("ALL"), 100).alias("PCT_RESEARCH_PAYMENTS"),
    )


def build_percentiles(provider_360: DataFrame) -> DataFrame:
    """Percent rank (0 to 100) of each measure among all providers of the peer group."""
    ranked = percentile_ranks(
        with_peer_groups(provider_360),
        "NPI",
        PEERS,
        {f"{name}_PERCENTILE": column for name, column in MEASURES.items()},
    )
    return ranked


def _z(name: str) -> Column:
    """Deviations from the peer mean; 0 without peers or without spread."""
    spread = F.col(f"PEER_STDDEV_{name}")
    deviation = F.col(MEASURES[name]).cast("double") - F.col(f"PEER_AVG_{name}")
    return F.when(spread > 0, deviation / spread).otherwise(F.lit(0.0))


def with_zscores(members: DataFrame, peer_stats: DataFrame) -> DataFrame:
    """Attach peer statistics and unrounded z-scores (``Z_<measure>``).

    A peer group may hold a large part of all providers, hence the salted join.
    """
    joined = salted_left_join(members, peer_stats, PEERS, spread=["NPI"])
    return joined.withColumns({f"Z_{name}": _z(name) for name in MEASURES})


def _rounded(column: str, digits: int) -> Column:
    return F.round(F.coalesce(F.col(column), F.lit(0)), digits)


def build_ml_features(
    provider_360: DataFrame, prescriptions: DataFrame, payments: DataFrame, loaded_at=None
) -> DataFrame:
    members = with_peer_groups(
        provider_360.select(
            *pick("NPI FULL_NAME ORGANIZATION_NAME ENTITY_TYPE SPECIALTY STATE IS_EXCLUDED"),
            *MEASURES.values(),
        )
    )
    scored = with_zscores(members, build_peer_stats(provider_360))
    full = left_join(
        left_join(
            left_join(scored, build_drug_concentration(prescriptions).drop("TOTAL_CLAIMS"), "NPI"),
            build_pharma_diversity(payments).drop("TOTAL_PAYMENT_RECORDS"),
            "NPI",
        ),
        build_percentiles(provider_360),
        "NPI",
    )
    payment, cost, claims = (F.col(MEASURES[name]) for name in ("PAYMENT", "RX_COST", "CLAIMS"))
    companies = F.coalesce(F.col("UNIQUE_PHARMA_COMPANIES"), F.lit(0))
    concentrated = F.coalesce(F.col("DRUG_HHI") > CONCENTRATED_HHI, F.lit(False))
    outlier = {name: F.col(f"Z_{name}") > OUTLIER_Z for name in MEASURES}
    result = full.select(
        *pick("NPI FULL_NAME ORGANIZATION_NAME ENTITY_TYPE SPECIALTY STATE"),
        *pick("TOTAL_PAYMENT_AMOUNT TOTAL_PRESCRIPTION_COST TOTAL_PRESCRIPTION_CLAIMS PCT_BRAND_CLAIMS"),
        "IS_EXCLUDED",
        F.coalesce(F.col("PEER_COUNT"), F.lit(0)).alias("PEER_COUNT"),
        *[round_half_away(F.col(f"Z_{name}"), 2).alias(f"{name}_ZSCORE") for name in MEASURES],
        ratio_or_null(payment, cost, 4).alias("PAYMENT_TO_RX_RATIO"),
        ratio_or_null(cost, claims, 2).alias("AVG_COST_PER_CLAIM"),
        F.when(
            F.col("PEER_AVG_PAYMENT") > 0,
            round_half_away(payment.cast("double") / F.col("PEER_AVG_PAYMENT"), 2),
        ).alias("PAYMENT_VS_PEER_RATIO"),
        F.coalesce(F.col("UNIQUE_DRUGS"), F.lit(0)).alias("UNIQUE_DRUGS_PRESCRIBED"),
        round_half_away(F.coalesce(F.col("DRUG_HHI"), F.lit(0.0)), 0).alias("DRUG_CONCENTRATION_HHI"),
        _rounded("TOP_DRUG_PCT", 1).alias("TOP_DRUG_PCT"),
        _rounded("TOP_3_DRUGS_PCT", 1).alias("TOP_3_DRUGS_PCT"),
        concentrated.alias("IS_CONCENTRATED_PRESCRIBER"),
        companies.alias("UNIQUE_PHARMA_COMPANIES"),
        _rounded("TOP_PAYER_PCT", 1).alias("TOP_PAYER_PCT"),
        _rounded("PCT_GENERAL_PAYMENTS", 1).alias("PCT_GENERAL_PAYMENTS"),
        _rounded("PCT_RESEARCH_PAYMENTS", 1).alias("PCT_RESEARCH_PAYMENTS"),
        (companies == 1).alias("IS_SINGLE_PAYER_RECIPIENT"),
        *[
            round_half_away(F.coalesce(F.col(f"{name}_PERCENTILE"), F.lit(0.0)), 1).alias(f"{name}_PERCENTILE")
            for name in MEASURES
        ],
        (flag_count(*outlier.values()) >= 2).alias("IS_MULTI_DIMENSION_OUTLIER"),
        flag_count(
            outlier["PAYMENT"],
            outlier["RX_COST"],
            outlier["BRAND_PCT"],
            concentrated,
            (companies == 1) & (payment > SINGLE_PAYER_AMOUNT),
            F.col("IS_EXCLUDED"),
        ).alias("ANOMALY_FLAG_COUNT"),
    )
    return stamp(result, loaded_at)
