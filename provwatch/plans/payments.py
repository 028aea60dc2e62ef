"""Manufacturer payments: three sources in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.functions import US_DATE, concat_strict, surrogate_key, tier, try_count, try_date, try_money
from provwatch.operators.filters import null_as, union_all
from provwatch.operators.joins import flag_member
from provwatch.plans.common import stamp

PAYER = "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name"

# Payment size classes.
PAYMENT_TIERS = [(100000, "VERY_HIGH"), (10000, "HIGH"), (1000, "MEDIUM"), (100, "LOW")]


def _recipient(prefix: str, specialty: str, kind) -> list:
    return [
        F.col("Record_ID").cast("string").alias("RECORD_ID"),
        F.col(f"{prefix}_NPI").alias("NPI"),
        kind.alias("RECIPIENT_TYPE"),
        F.col(f"{prefix}_First_Name").alias("FIRST_NAME"),
        F.col(f"{prefix}_Last_Name").alias("LAST_NAME"),
        F.col(specialty).alias("SPECIALTY"),
        F.col("Recipient_City").alias("CITY"),
        F.col("Recipient_State").alias("STATE"),
        F.col("Recipient_Zip_Code").alias("ZIP_CODE"),
        F.col(PAYER).alias("PAYER_NAME"),
        F.col("Program_Year").alias("PROGRAM_YEAR"),
    ]


def _transfers(df: DataFrame, category: str, *extra) -> DataFrame:
    """General and research payments share everything but a few descriptive columns."""
    return df.select(
        F.lit(category).alias("PAYMENT_CATEGORY"),
        *_recipient("Covered_Recipient", "Covered_Recipient_Specialty_1", F.col("Covered_Recipient_Type")),
        F.col("Teaching_Hospital_Name").alias("TEACHING_HOSPITAL"),
        try_money(F.col("Total_Amount_of_Payment_USDollars")).alias("PAYMENT_AMOUNT"),
        try_date(F.col("Date_of_Payment"), US_DATE).alias("PAYMENT_DATE"),
        F.col("Form_of_Payment_or_Transfer_of_Value").alias("PAYMENT_FORM"),
        *extra,
    )


def _ownership(df: DataFrame) -> DataFrame:
    return df.select(
        F.lit("OWNERSHIP").alias("PAYMENT_CATEGORY"),
        *_recipient("Physician", "Physician_Specialty", F.lit("Physician")),
        null_as("decimal(18,2)").alias("PAYMENT_AMOUNT"),
        null_as("date").alias("PAYMENT_DATE"),
        try_money(F.col("Total_Amount_Invested_USDollars")).alias("INVESTMENT_AMOUNT"),
        F.col("Value_of_Interest").alias("INTEREST_VALUE"),
    )


def build_payments(
    general: DataFrame, research: DataFrame, ownership: DataFrame, leie: DataFrame, loaded_at=None
) -> DataFrame:
    """All payments with their size class and whether the recipient is on the exclusion list.

    Columns a source lacks are NULL. Not deduplicated: PAYMENT_ID repeats if a source repeats a record.
    """
    payments = union_all(
        [
            _transfers(general, "GENERAL", F.col("Nature_of_Payment_or_Transfer_of_Value").alias("PAYMENT_NATURE")),
            _transfers(
                research,
                "RESEARCH",
                F.col("Name_of_Study").alias("STUDY_NAME"),
                F.col("ClinicalTrials_Gov_Identifier").alias("CLINICAL_TRIAL_ID"),
            ),
            _ownership(ownership),
        ]
    ).filter(F.col("RECORD_ID").isNotNull())
    flagged = flag_member(payments, leie, "NPI", "IS_RECIPIENT_EXCLUDED", spread=["RECORD_ID"])
    result = flagged.select(
        surrogate_key(F.col("PAYMENT_CATEGORY"), F.col("RECORD_ID")).alias("PAYMENT_ID"),
        "PAYMENT_CATEGORY",
        "RECORD_ID",
        "NPI",
        "RECIPIENT_TYPE",
        "FIRST_NAME",
        "LAST_NAME",
        concat_strict(" ", F.col("FIRST_NAME"), F.col("LAST_NAME")).alias("FULL_NAME"),
        "SPECIALTY",
        "CITY",
        "STATE",
        "ZIP_CODE",
        "TEACHING_HOSPITAL",
        "PAYER_NAME",
        "PAYMENT_AMOUNT",
        "PAYMENT_DATE",
        "PAYMENT_FORM",
        "PAYMENT_NATURE",
        F.year("PAYMENT_DATE").alias("PAYMENT_YEAR"),
        F.month("PAYMENT_DATE").alias("PAYMENT_MONTH"),
        "STUDY_NAME",
        "CLINICAL_TRIAL_ID",
        "INVESTMENT_AMOUNT",
        "INTEREST_VALUE",
        try_count(F.col("PROGRAM_YEAR").cast("string")).alias("PROGRAM_YEAR"),
        "IS_RECIPIENT_EXCLUDED",
        tier(F.col("PAYMENT_AMOUNT"), PAYMENT_TIERS, "MINIMAL").alias("PAYMENT_RISK_TIER"),
    )
    return stamp(result, loaded_at)
