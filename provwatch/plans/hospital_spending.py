"""Hospital spending per claim type against state and national benchmarks."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions import ISO_DATE, ladder, pct_change, surrogate_key, try_date, try_money, try_percent
from provwatch.operators.windows import keep_latest
from provwatch.plans.common import pick, stamp

LEVELS = ("HOSPITAL", "STATE", "NATION")


def _benchmark_status(value: Column, benchmark: Column, label: str) -> Column:
    """Below, around, or more than 20 % above a benchmark; unknown values count as around it."""
    return ladder(
        [
            (value < benchmark, f"BELOW_{label}_AVG"),
            (value > benchmark * F.lit(Decimal("1.2")), f"ABOVE_{label}_AVG_20PCT"),
        ],
        f"AT_{label}_AVG",
    )


def build_hospital_spending(spending: DataFrame, loaded_at=None, keep_load_time: bool = False) -> DataFrame:
    """One row per hospital, claim type and period, the newest load."""
    known = spending.filter(F.col("STATE").isNotNull() & F.col("FACILITY_ID").isNotNull())
    typed = known.select(
        surrogate_key(F.col("FACILITY_ID"), F.col("CLAIM_TYPE"), F.col("PERIOD")).alias("SPENDING_ID"),
        *pick("", CCN="FACILITY_ID", HOSPITAL_NAME="FACILITY_NAME"),
        *pick("ADDRESS CITY STATE ZIP_CODE", COUNTY="COUNTY_NAME", PHONE="PHONE_NUMBER"),
        *pick("CLAIM_TYPE PERIOD"),
        *[try_money(F.col(f"AVG_SPENDING_PER_EPISODE_{n}")).alias(f"AVG_SPENDING_{n}") for n in LEVELS],
        *[try_percent(F.col(f"PERCENT_OF_SPENDING_{n}")).alias(f"PCT_SPENDING_{n}") for n in LEVELS],
        try_date(F.col("START_DATE"), ISO_DATE).alias("PERIOD_START_DATE"),
        try_date(F.col("END_DATE"), ISO_DATE).alias("PERIOD_END_DATE"),
        "_LOAD_TIMESTAMP",
    )
    newest = keep_latest(typed, ["SPENDING_ID"], F.col("_LOAD_TIMESTAMP").desc_nulls_first())
    own, state, nation = (F.col(f"AVG_SPENDING_{n}") for n in LEVELS)
    variance = F.col("PCT_VARIANCE_FROM_NATION")
    result = (
        newest.withColumns(
            {
                "PCT_VARIANCE_FROM_STATE": pct_change(own, state),
                "PCT_VARIANCE_FROM_NATION": pct_change(own, nation),
                "STATE_BENCHMARK_STATUS": _benchmark_status(own, state, "STATE"),
                "NATIONAL_BENCHMARK_STATUS": _benchmark_status(own, nation, "NATIONAL"),
            }
        )
        .withColumn("IS_HIGH_SPENDER", F.coalesce(variance > 50, F.lit(False)))
        .withColumn(
            "SPENDING_RISK_TIER",
            ladder([(variance > 50, "HIGH"), (variance > 20, "MEDIUM"), (variance < -20, "LOW")], "NORMAL"),
        )
    )
    return stamp(result if keep_load_time else result.drop("_LOAD_TIMESTAMP"), loaded_at)
