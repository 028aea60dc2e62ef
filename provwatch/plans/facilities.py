"""Hospices, home health agencies, long-term care hospitals and nursing homes in one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provwatch.functions import ISO_DATE, concat_strict, ladder, percentage, surrogate_key, try_count, try_date
from provwatch.operators.filters import null_as, union_all
from provwatch.operators.windows import keep_latest
from provwatch.plans.common import stamp

_TEXT = "NAME ADDRESS_LINE_1 ADDRESS_LINE_2 CITY STATE ZIP_CODE COUNTY PHONE CMS_REGION OWNERSHIP_TYPE"
_COUNTS = "OVERALL_RATING HEALTH_INSPECTION_RATING STAFFING_RATING NUMBER_OF_BEDS NUMBER_OF_RESIDENTS"


def _common_shape(
    df: DataFrame,
    facility_type: str,
    ccn: str,
    certified: str | None = None,
    rated: dict[str, str] | None = None,
    **sources: str,
) -> DataFrame:
    """Map one source to the shared columns; what it does not report is a typed NULL."""
    rated = rated or {}

    def text(name: str) -> Column:
        return F.col(sources[name]) if name in sources else null_as("string")

    def count(name: str) -> Column:
        return try_count(F.col(rated[name])) if name in rated else null_as("bigint")

    date = try_date(F.col(certified), ISO_DATE) if certified else null_as("date")
    return df.filter(F.col(ccn).isNotNull()).select(
        F.lit(facility_type).alias("FACILITY_TYPE"),
        F.col(ccn).alias("CCN"),
        *[text(name).alias(name) for name in _TEXT.split()],
        date.alias("CERTIFICATION_DATE"),
        *[count(name).alias(name) for name in _COUNTS.split()],
        "_LOAD_TIMESTAMP",
    )


def _hospices(df: DataFrame) -> DataFrame:
    return _common_shape(
        df, "HOSPICE", "CMS_CERTIFICATION_NUMBER", "CERTIFICATION_DATE",
        NAME="FACILITY_NAME", ADDRESS_LINE_1="ADDRESS_LINE_1", ADDRESS_LINE_2="ADDRESS_LINE_2",
        CITY="CITY", STATE="STATE", ZIP_CODE="ZIP_CODE", COUNTY="COUNTY_NAME", PHONE="PHONE_NUMBER",
        CMS_REGION="CMS_REGION", OWNERSHIP_TYPE="OWNERSHIP_TYPE",
    )


def _home_health(df: DataFrame) -> DataFrame:
    return _common_shape(
        df, "HOME_HEALTH", "CMS_CERTIFICATION_NUMBER", "DATE_CERTIFIED",
        NAME="PROVIDER_NAME", ADDRESS_LINE_1="ADDRESS", CITY="CITY", STATE="STATE", ZIP_CODE="ZIP_CODE",
        PHONE="PHONE", OWNERSHIP_TYPE="TYPE_OF_OWNERSHIP",
    )


def _long_term_care(df: DataFrame) -> DataFrame:
    return _common_shape(
        df, "LTCH", "CMS_CERTIFICATION_NUMBER",
        NAME="FACILITY_NAME", ADDRESS_LINE_1="ADDRESS", CITY="CITY", STATE="STATE", ZIP_CODE="ZIP_CODE",
        COUNTY="COUNTY_NAME", PHONE="PHONE_NUMBER", CMS_REGION="CMS_REGION",
    )


def _nursing_homes(df: DataFrame) -> DataFrame:
    address = {
        name: f"PROVIDER_{name}" for name in ("NAME", "CITY", "STATE", "ZIP_CODE")
    }
    rated = {name: name for name in _COUNTS.split()}
    rated["NUMBER_OF_BEDS"] = "NUMBER_OF_CERTIFIED_BEDS"
    return _common_shape(
        df, "NURSING_HOME", "FEDERAL_PROVIDER_NUMBER", "DATE_FIRST_APPROVED", rated,
        ADDRESS_LINE_1="PROVIDER_ADDRESS", COUNTY="PROVIDER_COUNTY_NAME", PHONE="PROVIDER_PHONE_NUMBER",
        OWNERSHIP_TYPE="OWNERSHIP_TYPE", **address,
    )


def ownership_category(owner: Column) -> Column:
    """Category by substrings, first match wins; 'Not For Profit' thus counts as for-profit."""
    return ladder(
        [
            (owner.ilike("%profit%") & ~owner.ilike("%non%"), "FOR_PROFIT"),
            (owner.ilike("%non%profit%") | owner.ilike("%not%profit%"), "NON_PROFIT"),
            (owner.ilike("%government%") | owner.ilike("%state%") | owner.ilike("%county%"), "GOVERNMENT"),
        ],
        "OTHER",
    )


def union_facilities(
    hospice: DataFrame, home_health: DataFrame, ltch: DataFrame, nursing: DataFrame
) -> DataFrame:
    return union_all(
        [_hospices(hospice), _home_health(home_health), _long_term_care(ltch), _nursing_homes(nursing)]
    )


def build_facilities(
    hospice: DataFrame, home_health: DataFrame, ltch: DataFrame, nursing: DataFrame, loaded_at=None,
    keep_load_time: bool = False,
) -> DataFrame:
    """One row per certification number, the newest load; the number alone is the key, not the type."""
    rows = union_facilities(hospice, home_health, ltch, nursing)
    newest = keep_latest(rows, ["CCN"], F.col("_LOAD_TIMESTAMP").desc_nulls_first())
    beds, residents = F.col("NUMBER_OF_BEDS"), F.col("NUMBER_OF_RESIDENTS")
    result = newest.select(
        surrogate_key(F.col("FACILITY_TYPE"), F.col("CCN")).alias("FACILITY_ID"),
        "CCN",
        F.col("NAME").alias("FACILITY_NAME"),
        "FACILITY_TYPE",
        "ADDRESS_LINE_1",
        "ADDRESS_LINE_2",
        "CITY",
        "STATE",
        "ZIP_CODE",
        "COUNTY",
        concat_strict(", ", *[F.col(c) for c in ("ADDRESS_LINE_1", "CITY", "STATE", "ZIP_CODE")]).alias("FULL_ADDRESS"),
        "PHONE",
        "CMS_REGION",
        "OWNERSHIP_TYPE",
        ownership_category(F.col("OWNERSHIP_TYPE")).alias("OWNERSHIP_CATEGORY"),
        "CERTIFICATION_DATE",
        "OVERALL_RATING",
        "HEALTH_INSPECTION_RATING",
        "STAFFING_RATING",
        "NUMBER_OF_BEDS",
        "NUMBER_OF_RESIDENTS",
        F.when(beds > 0, percentage(residents, beds, 1)).alias("OCCUPANCY_RATE"),
        F.coalesce(F.col("OVERALL_RATING") == 1, F.lit(False)).alias("IS_LOW_QUALITY"),
        *(["_LOAD_TIMESTAMP"] if keep_load_time else []),
    )
    return stamp(result, loaded_at)
