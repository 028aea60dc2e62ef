"""Schemas of the landed tables.

All business columns are strings: the public files are parsed leniently later, in the silver models.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# The column names of the landed tables, in file order.
BRONZE_COLUMNS: dict[str, str] = {
    "LEIE": """
        LASTNAME FIRSTNAME MIDNAME BUSNAME GENERAL SPECIALTY UPIN NPI DOB ADDRESS CITY STATE ZIP
        EXCLTYPE EXCLDATE REINDATE WAIVERDATE WVRSTATE
    """,
    "MEDICARE_HOSPITAL_SPENDING": """
        FACILITY_ID FACILITY_NAME ADDRESS CITY STATE ZIP_CODE COUNTY_NAME PHONE_NUMBER CLAIM_TYPE PERIOD
        AVG_SPENDING_PER_EPISODE_HOSPITAL AVG_SPENDING_PER_EPISODE_STATE AVG_SPENDING_PER_EPISODE_NATION
        PERCENT_OF_SPENDING_HOSPITAL PERCENT_OF_SPENDING_STATE PERCENT_OF_SPENDING_NATION
        START_DATE END_DATE
    """,
    "PROVIDER_INFORMATION": """
        FEDERAL_PROVIDER_NUMBER PROVIDER_NAME PROVIDER_ADDRESS PROVIDER_CITY PROVIDER_STATE
        PROVIDER_ZIP_CODE PROVIDER_PHONE_NUMBER PROVIDER_SSA_COUNTY_CODE PROVIDER_COUNTY_NAME
        OWNERSHIP_TYPE NUMBER_OF_CERTIFIED_BEDS NUMBER_OF_RESIDENTS AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY
        PROVIDER_TYPE PROVIDER_RESIDES_IN_HOSPITAL LEGAL_BUSINESS_NAME DATE_FIRST_APPROVED
        CONTINUING_CARE_RETIREMENT_COMMUNITY SPECIAL_FOCUS_FACILITY OVERALL_RATING
        HEALTH_INSPECTION_RATING STAFFING_RATING QM_RATING LOCATION PROCESSING_DATE
    """,
    "LONGTERM_CARE_HOSPITAL": """
        CMS_CERTIFICATION_NUMBER FACILITY_NAME ADDRESS CITY STATE ZIP_CODE COUNTY_NAME PHONE_NUMBER
        CMS_REGION MEASURE_CODE SCORE FOOTNOTE START_DATE END_DATE
    """,
    "HOSPICE": """
        CMS_CERTIFICATION_NUMBER FACILITY_NAME ADDRESS_LINE_1 ADDRESS_LINE_2 CITY STATE ZIP_CODE
        COUNTY_NAME PHONE_NUMBER CMS_REGION OWNERSHIP_TYPE CERTIFICATION_DATE
    """,
    "HOME_HEALTH_CARE": """
        CMS_CERTIFICATION_NUMBER PROVIDER_NAME ADDRESS CITY STATE ZIP_CODE PHONE TYPE_OF_OWNERSHIP
        OFFERS_NURSING_CARE OFFERS_PHYSICAL_THERAPY OFFERS_OCCUPATIONAL_THERAPY OFFERS_SPEECH_PATHOLOGY
        OFFERS_MEDICAL_SOCIAL_SERVICES OFFERS_HOME_HEALTH_AIDE_SERVICES DATE_CERTIFIED
    """,
    "MEDICARE_PART_D_PRESCRIBERS": """
        PRSCRBR_NPI PRSCRBR_LAST_ORG_NAME PRSCRBR_FIRST_NAME PRSCRBR_CITY PRSCRBR_STATE_ABRVTN
        PRSCRBR_STATE_FIPS PRSCRBR_TYPE PRSCRBR_TYPE_SRC BRND_NAME GNRC_NAME TOT_CLMS TOT_30DAY_FILLS
        TOT_DAY_SUPLY TOT_DRUG_CST TOT_BENES GE65_SPRSN_FLAG GE65_TOT_CLMS GE65_TOT_30DAY_FILLS
        GE65_TOT_DAY_SUPLY GE65_TOT_DRUG_CST GE65_BENE_SPRSN_FLAG GE65_TOT_BENES
    """,
}

# Raw headers whose landed name is not just the header in snake case.
HEADER_EXCEPTIONS: dict[str, str] = {
    "CMS Certification Number (CCN)": "CMS_CERTIFICATION_NUMBER",
    "Date First Approved to Provide Medicare and Medicaid Services": "DATE_FIRST_APPROVED",
    "Offers Nursing Care Services": "OFFERS_NURSING_CARE",
    "Offers Physical Therapy Services": "OFFERS_PHYSICAL_THERAPY",
    "Offers Occupational Therapy Services": "OFFERS_OCCUPATIONAL_THERAPY",
    "Offers Speech Pathology Services": "OFFERS_SPEECH_PATHOLOGY",
    "Offers Medical Social Services": "OFFERS_MEDICAL_SOCIAL_SERVICES",
    "Offers Home Health Aide Services": "OFFERS_HOME_HEALTH_AIDE_SERVICES",
}

LOAD_TIMESTAMP = "_LOAD_TIMESTAMP"
SOURCE_FILE = "_SOURCE_FILE"


def bronze_columns(table: str) -> list[str]:
    return BRONZE_COLUMNS[table].split()


def bronze_schema(table: str) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in bronze_columns(table)]
    fields.append(T.StructField(LOAD_TIMESTAMP, T.TimestampNTZType()))
    fields.append(T.StructField(SOURCE_FILE, T.StringType()))
    return T.StructType(fields)


BRONZE_SCHEMAS: dict[str, T.StructType] = {table: bronze_schema(table) for table in BRONZE_COLUMNS}


def landed_name(header: str) -> str:
    """Column name for a raw header: a listed exception, else the header in upper snake case."""
    listed = HEADER_EXCEPTIONS.get(header)
    return listed or re.sub(r"[^0-9A-Za-z]+", "_", header).strip("_").upper()
