"""Data expectations over the silver and gold tables.

Single checks return the failing rows. ``run_expectations`` counts violations of everything declared
below: all row-level checks of a table share one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.operators.filters import union_all
from provwatch.operators.joins import anti_join

# --- checks that return failing rows ------------------------------------------------------------------


def expect_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not a duplicate."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def expect_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def expect_accepted(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(_not_accepted(column, values))


def expect_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    return df.filter(_out_of_range(column, low, high))


def expect_relationship(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return anti_join(child.filter(F.col(key).isNotNull()), parent, key)


def _not_accepted(column: str, values: Sequence[object]) -> Column:
    return ~F.col(column).isin(*values)


def _out_of_range(column: str, low: float | None, high: float | None) -> Column:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return outside


# --- invariants across columns and tables -------------------------------------------------------------


def alerts_without_provider(alerts: DataFrame, provider_360: DataFrame) -> DataFrame:
    return anti_join(alerts, provider_360, "NPI").select("ALERT_ID", "NPI", "ALERT_TYPE")


def critical_but_not_excluded(scores: DataFrame) -> DataFrame:
    failing = (F.col("RISK_TIER") == "CRITICAL") & ~F.col("IS_EXCLUDED") & (F.col("FRAUD_RISK_SCORE") >= 70)
    return scores.filter(failing).select("NPI", "FRAUD_RISK_SCORE", "RISK_TIER", "IS_EXCLUDED")


def exposure_mismatch(provider_360: DataFrame) -> DataFrame:
    expected = F.col("TOTAL_PAYMENT_AMOUNT") + F.col("TOTAL_PRESCRIPTION_COST")
    return provider_360.withColumn("EXPECTED_EXPOSURE", expected).filter(
        F.col("TOTAL_FINANCIAL_EXPOSURE") != F.col("EXPECTED_EXPOSURE")
    )


def negative_amounts(provider_360: DataFrame) -> DataFrame:
    amounts = ["TOTAL_PAYMENT_AMOUNT", "TOTAL_PRESCRIPTION_COST", "TOTAL_FINANCIAL_EXPOSURE"]
    return provider_360.filter(F.least(*amounts) < 0).select("NPI", *amounts)


# --- declared expectations ----------------------------------------------------------------------------

# What each table promises, one line per column.
UNIQUE = {
    "provider": "NPI",
    "excluded_providers": "EXCLUSION_ID",
    "payments": "PAYMENT_ID",
    "prescriptions": "PRESCRIPTION_ID",
    "facilities": "FACILITY_ID",
    "hospital_spending": "SPENDING_ID",
    "provider_360": "NPI",
    "fraud_risk_score": "NPI",
    "high_risk_alerts": "ALERT_ID",
    "payments_summary": "NPI",
    "prescriptions_summary": "NPI",
    "provider_ml_features": "NPI",
}
NOT_NULL = {
    "provider": "NPI IS_EXCLUDED",
    "excluded_providers": "EXCLUSION_ID EXCLUSION_DATE IS_CURRENTLY_EXCLUDED IS_HIGH_RISK",
    "payments": "PAYMENT_ID PAYMENT_CATEGORY IS_RECIPIENT_EXCLUDED",
    "prescriptions": "PRESCRIPTION_ID NPI IS_PRESCRIBER_EXCLUDED",
    "facilities": "FACILITY_ID CCN FACILITY_TYPE",
    "hospital_spending": "SPENDING_ID CCN IS_HIGH_SPENDER",
    "provider_360": "NPI IS_EXCLUDED TOTAL_PAYMENT_AMOUNT TOTAL_PRESCRIPTION_COST TOTAL_FINANCIAL_EXPOSURE",
    "fraud_risk_score": "NPI FRAUD_RISK_SCORE RISK_TIER IS_EXCLUDED TOTAL_FINANCIAL_EXPOSURE",
    "high_risk_alerts": "ALERT_ID ALERT_TYPE NPI RISK_TIER ALERT_STATUS PRIORITY_RANK",
    "payments_summary": "NPI TOTAL_PAYMENTS TOTAL_PAYMENT_AMOUNT",
    "prescriptions_summary": "NPI TOTAL_CLAIMS TOTAL_COST",
    "provider_ml_features": "NPI IS_MULTI_DIMENSION_OUTLIER ANOMALY_FLAG_COUNT",
}
_ENTITY = "Individual Organization Unknown"
ACCEPTED = {
    ("provider", "ENTITY_TYPE"): _ENTITY,
    ("payments", "PAYMENT_CATEGORY"): "GENERAL RESEARCH OWNERSHIP",
    ("payments", "PAYMENT_RISK_TIER"): "VERY_HIGH HIGH MEDIUM LOW MINIMAL",
    ("prescriptions", "RISK_TIER"): "CRITICAL VERY_HIGH HIGH MEDIUM LOW",
    ("facilities", "FACILITY_TYPE"): "HOSPICE HOME_HEALTH LTCH NURSING_HOME",
    ("facilities", "OWNERSHIP_CATEGORY"): "FOR_PROFIT NON_PROFIT GOVERNMENT OTHER",
    ("hospital_spending", "SPENDING_RISK_TIER"): "HIGH MEDIUM LOW NORMAL",
    ("provider_360", "ENTITY_TYPE"): _ENTITY,
    ("fraud_risk_score", "RISK_TIER"): "CRITICAL HIGH MEDIUM LOW MINIMAL",
    ("high_risk_alerts", "ALERT_TYPE"): (
        "HIGH_RISK_SCORE EXCLUDED_STILL_ACTIVE PAYMENT_TO_EXCLUDED PRESCRIPTION_BY_EXCLUDED"
        " HIGH_BRAND_PRESCRIBER SIGNIFICANT_RECIPIENT"
    ),
    ("high_risk_alerts", "RISK_TIER"): "CRITICAL HIGH MEDIUM LOW",
    ("high_risk_alerts", "ALERT_STATUS"): "PENDING REVIEWED DISMISSED ESCALATED",
    ("payments_summary", "RECIPIENT_TIER"): (
        "MEGA_RECIPIENT MAJOR_RECIPIENT SIGNIFICANT_RECIPIENT MODERATE_RECIPIENT MINOR_RECIPIENT"
    ),
}
RANGES = {
    ("provider_360", "TOTAL_PAYMENT_AMOUNT"): (0, None),
    ("provider_360", "TOTAL_PRESCRIPTION_COST"): (0, None),
    ("provider_360", "TOTAL_FINANCIAL_EXPOSURE"): (0, None),
    ("fraud_risk_score", "FRAUD_RISK_SCORE"): (0, 100),
    ("fraud_risk_score", "TOTAL_FINANCIAL_EXPOSURE"): (0, None),
    ("high_risk_alerts", "PRIORITY_RANK"): (1, 6),
    ("payments_summary", "TOTAL_PAYMENTS"): (0, None),
    ("payments_summary", "TOTAL_PAYMENT_AMOUNT"): (0, None),
    ("prescriptions_summary", "TOTAL_CLAIMS"): (0, None),
    ("prescriptions_summary", "TOTAL_COST"): (0, None),
    ("prescriptions_summary", "PCT_BRAND_CLAIMS"): (0, 100),
    ("provider_ml_features", "DRUG_CONCENTRATION_HHI"): (0, 10000),
    ("provider_ml_features", "UNIQUE_PHARMA_COMPANIES"): (0, None),
    ("provider_ml_features", "PAYMENT_PERCENTILE"): (0, 100),
    ("provider_ml_features", "ANOMALY_FLAG_COUNT"): (0, 6),
}
RELATIONSHIPS = [("fraud_risk_score", "provider_360", "NPI"), ("provider_ml_features", "provider_360", "NPI")]


def row_checks(kinds: Sequence[str] = ("not_null", "accepted", "range")) -> dict[str, list[tuple[str, str, Column]]]:
    """Declared row-level checks as ``{table: [(kind, column, failing condition)]}``."""
    checks: dict[str, list[tuple[str, str, Column]]] = {}

    def add(table: str, kind: str, column: str, failing: Column) -> None:
        if kind in kinds:
            checks.setdefault(table, []).append((kind, column, failing))

    for table, columns in NOT_NULL.items():
        for column in columns.split():
            add(table, "not_null", column, F.col(column).isNull())
    for (table, column), values in ACCEPTED.items():
        add(table, "accepted", column, _not_accepted(column, values.split()))
    for (table, column), (low, high) in RANGES.items():
        add(table, "range", column, _out_of_range(column, low, high))
    return checks


def _report(counted: DataFrame, table: str, kind: str, column: str) -> DataFrame:
    return counted.select(
        F.lit(table).alias("TABLE_NAME"),
        F.lit(column).alias("COLUMN_NAME"),
        F.lit(kind).alias("CHECK_KIND"),
        F.col("VIOLATIONS"),
    )


def count_row_checks(
    tables: Mapping[str, DataFrame], kinds: Sequence[str] = ("not_null", "accepted", "range")
) -> DataFrame:
    """Violations of all row-level checks; one aggregate per table, turned into one row per check."""
    reports = []
    for table, checks in row_checks(kinds).items():
        counts = tables[table].agg(
            *[F.count_if(failing).alias(f"c{i}") for i, (_, _, failing) in enumerate(checks)]
        )
        rows = [
            F.struct(
                F.lit(table).alias("TABLE_NAME"),
                F.lit(column).alias("COLUMN_NAME"),
                F.lit(kind).alias("CHECK_KIND"),
                F.col(f"c{i}").alias("VIOLATIONS"),
            )
            for i, (kind, column, _) in enumerate(checks)
        ]
        reports.append(counts.select(F.inline(F.array(*rows))))
    return union_all(reports)


def count_unique_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of duplicated values per declared key."""
    counted = F.count("*").alias("VIOLATIONS")
    return union_all(
        [_report(expect_unique(tables[t], c).agg(counted), t, "unique", c) for t, c in UNIQUE.items()]
    )


def count_relationship_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    counted = F.count("*").alias("VIOLATIONS")
    return union_all(
        [
            _report(expect_relationship(tables[child], tables[parent], key).agg(counted), child, "relationship", key)
            for child, parent, key in RELATIONSHIPS
        ]
    )


def count_invariants(tables: Mapping[str, DataFrame]) -> DataFrame:
    profile, scores = tables["provider_360"], tables["fraud_risk_score"]
    failing = {
        "alerts_have_provider": alerts_without_provider(tables["high_risk_alerts"], profile),
        "critical_is_excluded": critical_but_not_excluded(scores),
        "exposure_adds_up": exposure_mismatch(profile),
        "no_negative_amounts": negative_amounts(profile),
    }
    return union_all(
        [
            rows.agg(F.count("*").alias("VIOLATIONS")).select(F.lit(name).alias("INVARIANT"), "VIOLATIONS")
            for name, rows in failing.items()
        ]
    )


def run_expectations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violation count of every declared check and invariant."""
    invariants = count_invariants(tables).select(
        F.lit(None).cast("string").alias("TABLE_NAME"),
        F.col("INVARIANT").alias("COLUMN_NAME"),
        F.lit("invariant").alias("CHECK_KIND"),
        "VIOLATIONS",
    )
    return union_all(
        [count_row_checks(tables), count_unique_checks(tables), count_relationship_checks(tables), invariants]
    )
