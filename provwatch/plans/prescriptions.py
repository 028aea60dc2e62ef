"""Prescriptions per prescriber and drug."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.functions import (
    concat_strict,
    ladder,
    present,
    ratio_or_zero,
    surrogate_key,
    try_count,
    try_money,
)
from provwatch.operators.joins import flag_member
from provwatch.plans.common import pick, stamp

# Cost classes (strictly above).
COST_TIERS = [(1000000, "VERY_HIGH"), (100000, "HIGH"), (10000, "MEDIUM")]

VOLUMES = {
    "TOTAL_CLAIMS": ("TOT_CLMS", try_count),
    "TOTAL_30DAY_FILLS": ("TOT_30DAY_FILLS", try_money),
    "TOTAL_DAYS_SUPPLY": ("TOT_DAY_SUPLY", try_count),
    "TOTAL_DRUG_COST": ("TOT_DRUG_CST", try_money),
    "TOTAL_BENEFICIARIES": ("TOT_BENES", try_count),
}


def _is_above(column: str, bound: int):
    return F.coalesce(F.col(column) > bound, F.lit(False))


def build_prescriptions(
    part_d: DataFrame, leie: DataFrame, loaded_at=None, keep_load_time: bool = False
) -> DataFrame:
    """Typed volumes, per-row ratios, exclusion flag and risk tier.

    ``keep_load_time`` keeps the source rows' load time, for incremental tables.

    Not deduplicated: PRESCRIPTION_ID repeats if the source repeats a prescriber and drug.
    """
    brand, generic = F.col("BRND_NAME"), F.col("GNRC_NAME")
    all_ages = [parse(F.col(raw)).alias(name) for name, (raw, parse) in VOLUMES.items()]
    seniors = [parse(F.col(f"GE65_{raw}")).alias(f"{name}_65PLUS") for name, (raw, parse) in VOLUMES.items()]
    typed = part_d.filter(present(F.col("PRSCRBR_NPI"))).select(
        surrogate_key(F.col("PRSCRBR_NPI"), brand, generic).alias("PRESCRIPTION_ID"),
        *pick(
            "",
            NPI="PRSCRBR_NPI",
            PRESCRIBER_LAST_NAME="PRSCRBR_LAST_ORG_NAME",
            PRESCRIBER_FIRST_NAME="PRSCRBR_FIRST_NAME",
        ),
        concat_strict(" ", F.col("PRSCRBR_FIRST_NAME"), F.col("PRSCRBR_LAST_ORG_NAME")).alias("PRESCRIBER_FULL_NAME"),
        *pick(
            "",
            CITY="PRSCRBR_CITY",
            STATE="PRSCRBR_STATE_ABRVTN",
            PRESCRIBER_TYPE="PRSCRBR_TYPE",
            BRAND_NAME="BRND_NAME",
            GENERIC_NAME="GNRC_NAME",
        ),
        # A missing generic name makes the comparison unknown, which counts as generic.
        ladder([(brand != generic, "BRAND")], "GENERIC").alias("DRUG_TYPE"),
        *all_ages,
        *seniors,
        *(["_LOAD_TIMESTAMP"] if keep_load_time else []),
    )
    claims, cost, patients = F.col("TOTAL_CLAIMS"), F.col("TOTAL_DRUG_COST"), F.col("TOTAL_BENEFICIARIES")
    measured = typed.withColumns(
        {
            "AVG_COST_PER_CLAIM": ratio_or_zero(cost, claims),
            "AVG_COST_PER_BENEFICIARY": ratio_or_zero(cost, patients),
            "AVG_CLAIMS_PER_BENEFICIARY": ratio_or_zero(claims, patients),
            "AVG_DAYS_PER_FILL": ratio_or_zero(F.col("TOTAL_DAYS_SUPPLY"), F.col("TOTAL_30DAY_FILLS")),
        }
    )
    flagged = flag_member(
        measured, leie, "NPI", "IS_PRESCRIBER_EXCLUDED", spread=["BRAND_NAME", "GENERIC_NAME"]
    )
    result = flagged.withColumns(
        {
            "IS_HIGH_VOLUME_PRESCRIBER": _is_above("TOTAL_CLAIMS", 1000),
            "IS_HIGH_COST_PRESCRIBER": _is_above("AVG_COST_PER_CLAIM", 500),
            "IS_HIGH_CLAIMS_PER_BENE": _is_above("AVG_CLAIMS_PER_BENEFICIARY", 10),
            "RISK_TIER": ladder(
                [(F.col("IS_PRESCRIBER_EXCLUDED"), "CRITICAL")]
                + [(cost > bound, label) for bound, label in COST_TIERS],
                "LOW",
            ),
        }
    )
    return stamp(result, loaded_at)
