"""Rules of the models at their boundaries, on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.plans.alerts import build_alerts, paid_while_excluded_alerts
from provwatch.plans.exclusions import build_exclusions
from provwatch.plans.facilities import build_facilities, ownership_category
from provwatch.plans.hospital_spending import build_hospital_spending
from provwatch.plans.ml_features import build_drug_concentration, build_ml_features, build_peer_stats, build_pharma_diversity
from provwatch.plans.payments import build_payments
from provwatch.plans.prescriptions import build_prescriptions
from provwatch.plans.provider import ADDRESS_COLUMNS, PROVIDER_COLUMNS, TAXONOMY_COLUMNS, build_provider
from provwatch.plans.provider_360 import build_provider_360
from provwatch.plans.risk_score import build_risk_score
from provwatch.plans.summaries import build_payments_summary, build_prescriptions_summary
from provwatch.sources.schemas import BRONZE_SCHEMAS


def make(spark, columns, rows, **types):
    """Frame of string columns unless typed otherwise; rows are dicts, absent values NULL."""
    names = columns.split() if isinstance(columns, str) else list(columns)
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def bronze(spark, table, rows):
    schema = BRONZE_SCHEMAS[table]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def leie(spark, rows):
    return bronze(spark, "LEIE", [{"EXCLDATE": "20200101", **r} for r in rows])


def registry(spark, rows):
    dates = {"ENUMERATION_DATE": T.DateType(), "LAST_UPDATE_DATE": T.DateType(), "IS_ACTIVE": T.BooleanType()}
    return make(spark, f"NPI {PROVIDER_COLUMNS}", [{"IS_ACTIVE": True, **r} for r in rows], **dates)


def addresses(spark, rows):
    return make(spark, f"NPI IS_PRIMARY {ADDRESS_COLUMNS}", [{"IS_PRIMARY": True, **r} for r in rows], IS_PRIMARY=T.BooleanType())


def taxonomies(spark, rows):
    return make(
        spark,
        f"NPI IS_PRIMARY_TAXONOMY {TAXONOMY_COLUMNS}",
        [{"IS_PRIMARY_TAXONOMY": True, **r} for r in rows],
        IS_PRIMARY_TAXONOMY=T.BooleanType(),
    )


GENERAL = """Record_ID Covered_Recipient_NPI Covered_Recipient_Type Covered_Recipient_First_Name
    Covered_Recipient_Last_Name Covered_Recipient_Specialty_1 Recipient_City Recipient_State Recipient_Zip_Code
    Teaching_Hospital_Name Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name
    Total_Amount_of_Payment_USDollars Date_of_Payment Form_of_Payment_or_Transfer_of_Value
    Nature_of_Payment_or_Transfer_of_Value Program_Year"""
RESEARCH = GENERAL.replace("Nature_of_Payment_or_Transfer_of_Value", "Name_of_Study ClinicalTrials_Gov_Identifier")
OWNERSHIP = """Record_ID Physician_NPI Physician_First_Name Physician_Last_Name Physician_Specialty Recipient_City
    Recipient_State Recipient_Zip_Code Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name Program_Year
    Total_Amount_Invested_USDollars Value_of_Interest"""
PAYER = "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name"


def payments(spark, general=(), research=(), ownership=(), listed=()):
    return build_payments(
        make(spark, GENERAL, general),
        make(spark, RESEARCH, research),
        make(spark, OWNERSHIP, ownership),
        leie(spark, [{"NPI": n} for n in listed]),
    )


def by(df, key):
    return {r[key]: r for r in df.collect()}


# --- exclusions and providers -------------------------------------------------------------------------


def test_exclusion_status_and_match(spark):
    rows = [
        {"NPI": "1", "LASTNAME": " smith ", "FIRSTNAME": "al", "EXCLTYPE": "1128b5", "REINDATE": ""},
        {"NPI": "2", "LASTNAME": "b", "REINDATE": "20210101"},
        {"NPI": None, "LASTNAME": "c"},
        {"NPI": "9", "LASTNAME": "d", "REINDATE": "00000000"},
        {"NPI": "1", "LASTNAME": "gone", "EXCLDATE": ""},
        {"NPI": "1", "LASTNAME": "gone", "EXCLDATE": None},
    ]
    out = by(
        build_exclusions(leie(spark, rows), registry(spark, [{"NPI": "1"}, {"NPI": "2"}]), addresses(spark, [])), "LAST_NAME"
    )
    assert set(out) == {"SMITH", "B", "C", "D"}
    assert out["SMITH"]["MATCH_STATUS"] == "NPI_MATCH" and out["SMITH"]["IS_HIGH_RISK"]
    assert out["SMITH"]["EXCLUSION_REASON"].startswith("Exclusion or suspension")
    assert not out["B"]["IS_CURRENTLY_EXCLUDED"] and not out["B"]["IS_HIGH_RISK"]
    assert out["C"]["MATCH_STATUS"] == "NO_NPI_IN_LEIE" and out["C"]["IS_CURRENTLY_EXCLUDED"]
    assert out["C"]["EXCLUSION_REASON"] == "Other exclusion type"
    assert out["D"]["MATCH_STATUS"] == "NPI_NOT_FOUND_IN_NPPES"
    assert not out["D"]["IS_CURRENTLY_EXCLUDED"] and out["D"]["REINSTATEMENT_DATE"] is None


def test_reinstatement_placeholders_are_optional(spark):
    listed = leie(spark, [{"NPI": "1", "REINDATE": "00000000"}])
    frames = (listed, registry(spark, []), addresses(spark, []))
    assert not build_exclusions(*frames).first()["IS_CURRENTLY_EXCLUDED"]
    assert build_exclusions(*frames, placeholder_values=("00000000",)).first()["IS_CURRENTLY_EXCLUDED"]


def test_exclusions_are_not_multiplied(spark):
    listed = leie(spark, [{"NPI": "1", "LASTNAME": "a"}] * 3)
    places = addresses(spark, [{"NPI": "1", "ADDRESS_LINE_1": a, "CITY_NAME": a} for a in "cab"])
    out = build_exclusions(listed, registry(spark, [{"NPI": "1"}]), places).collect()
    assert [r["NPPES_CITY"] for r in out] == ["a"]


def test_provider_takes_newest_row_and_one_address(spark):
    people = registry(
        spark,
        [
            {"NPI": "1", "LAST_UPDATE_DATE": date(2020, 1, 1), "PROVIDER_FULL_NAME": "old", "ENTITY_TYPE_CODE": "1"},
            {"NPI": "1", "LAST_UPDATE_DATE": date(2021, 1, 1), "PROVIDER_FULL_NAME": "new", "ENTITY_TYPE_CODE": "2"},
            {"NPI": "1", "LAST_UPDATE_DATE": None, "PROVIDER_FULL_NAME": "undated", "ENTITY_TYPE_CODE": "1"},
            {"NPI": "2", "ENTITY_TYPE_CODE": None},
        ],
    )
    places = addresses(
        spark,
        [
            {"NPI": "1", "ADDRESS_LINE_1": "b", "STATE_CODE": "NY"},
            {"NPI": "1", "ADDRESS_LINE_1": "a", "STATE_CODE": "CA"},
            {"NPI": "1", "ADDRESS_LINE_1": "0", "STATE_CODE": "XX", "IS_PRIMARY": False},
        ],
    )
    kinds = taxonomies(spark, [{"NPI": "1", "TAXONOMY_CODE": "T2"}, {"NPI": "1", "TAXONOMY_CODE": "T1", "TAXONOMY_SPECIALIZATION": "S"}])
    out = by(build_provider(people, places, kinds, leie(spark, [{"NPI": "2"}, {"NPI": "2"}, {"NPI": ""}])), "NPI")
    assert len(out) == 2
    assert (out["1"]["FULL_NAME"], out["1"]["STATE"], out["1"]["SPECIALTY"]) == ("new", "CA", "S")
    assert (out["1"]["ENTITY_TYPE"], out["2"]["ENTITY_TYPE"]) == ("Organization", "Unknown")
    assert (out["1"]["IS_EXCLUDED"], out["2"]["IS_EXCLUDED"]) == (False, True)


# --- payments -----------------------------------------------------------------------------------------


def test_payment_tiers_and_sources(spark):
    amounts = ["100000", "99999.99", "10000", "1000", "100", "99.99", "bad", ""]
    general = [
        {"Record_ID": str(i), "Covered_Recipient_NPI": "1", "Total_Amount_of_Payment_USDollars": a, "Date_of_Payment": "02/29/2024"}
        for i, a in enumerate(amounts)
    ] + [{"Record_ID": None, "Total_Amount_of_Payment_USDollars": "5"}]
    owned = [{"Record_ID": "0", "Physician_NPI": "2", "Total_Amount_Invested_USDollars": "7.5", "Physician_First_Name": "A"}]
    out = payments(spark, general, [{"Record_ID": "0", "Name_of_Study": "S"}], owned, listed=["2"]).collect()
    tiers = {r["RECORD_ID"]: r["PAYMENT_RISK_TIER"] for r in out if r["PAYMENT_CATEGORY"] == "GENERAL"}
    assert [tiers[str(i)] for i in range(8)] == [
        "VERY_HIGH", "HIGH", "HIGH", "MEDIUM", "LOW", "MINIMAL", "MINIMAL", "MINIMAL",
    ]
    assert len(out) == 10 and len({r["PAYMENT_ID"] for r in out}) == 10
    stake = next(r for r in out if r["PAYMENT_CATEGORY"] == "OWNERSHIP")
    assert stake["INVESTMENT_AMOUNT"] == Decimal("7.50") and stake["PAYMENT_AMOUNT"] is None
    assert stake["RECIPIENT_TYPE"] == "Physician" and stake["IS_RECIPIENT_EXCLUDED"]
    assert stake["FULL_NAME"] is None and stake["PAYMENT_RISK_TIER"] == "MINIMAL"
    assert next(r for r in out if r["PAYMENT_CATEGORY"] == "RESEARCH")["STUDY_NAME"] == "S"


def test_payment_summary_keeps_the_blank_recipient(spark):
    general = [
        {"Record_ID": "1", "Covered_Recipient_NPI": "", "Total_Amount_of_Payment_USDollars": "1"},
        {"Record_ID": "2", "Covered_Recipient_NPI": None, "Total_Amount_of_Payment_USDollars": "1"},
        {"Record_ID": "3", "Covered_Recipient_NPI": "7", "Total_Amount_of_Payment_USDollars": "x"},
        {"Record_ID": "4", "Covered_Recipient_NPI": "8", "Total_Amount_of_Payment_USDollars": "10000", PAYER: "p"},
        {"Record_ID": "5", "Covered_Recipient_NPI": "8", "Total_Amount_of_Payment_USDollars": "0.01", PAYER: "p"},
        {"Record_ID": "6", "Covered_Recipient_NPI": "8", "Total_Amount_of_Payment_USDollars": "bad", PAYER: None},
    ]
    out = by(build_payments_summary(payments(spark, general)), "NPI")
    assert set(out) == {"", "7", "8"}
    assert out["7"]["TOTAL_PAYMENT_AMOUNT"] == 0 and out["7"]["AVG_PAYMENT_AMOUNT"] is None
    assert out["8"]["AVG_PAYMENT_AMOUNT"] == Decimal("5000.01")  # 5000.005 rounds away from zero
    assert (out["8"]["UNIQUE_PAYERS"], out["8"]["PCT_HIGH_RISK_PAYMENTS"]) == (1, Decimal("33.33"))
    assert (out["8"]["RECIPIENT_TIER"], out["7"]["RECIPIENT_TIER"]) == ("SIGNIFICANT_RECIPIENT", "MINOR_RECIPIENT")


def test_top_payer_share_is_per_category(spark):
    general = [{"Record_ID": "1", "Covered_Recipient_NPI": "1", PAYER: "p", "Total_Amount_of_Payment_USDollars": "60"}]
    research = [{"Record_ID": "2", "Covered_Recipient_NPI": "1", PAYER: "p", "Total_Amount_of_Payment_USDollars": "40"}]
    row = build_pharma_diversity(payments(spark, general, research)).first()
    assert (row["UNIQUE_PHARMA_COMPANIES"], row["TOTAL_PAYMENT_RECORDS"]) == (1, 2)
    assert (row["TOP_PAYER_PCT"], row["PCT_GENERAL_PAYMENTS"], row["PCT_RESEARCH_PAYMENTS"]) == (60, 60, 40)


# --- prescriptions ------------------------------------------------------------------------------------


def drug(npi="1", brand="b", generic="g", claims="10", cost="100", benes="5", **more):
    return {"PRSCRBR_NPI": npi, "BRND_NAME": brand, "GNRC_NAME": generic, "TOT_CLMS": claims, "TOT_DRUG_CST": cost, "TOT_BENES": benes, **more}


def prescriptions(spark, rows, listed=()):
    return build_prescriptions(
        bronze(spark, "MEDICARE_PART_D_PRESCRIBERS", rows), leie(spark, [{"NPI": n} for n in listed])
    )


def test_prescription_rules(spark):
    rows = [
        drug(brand="a", cost="1000000"),
        drug(brand="b", cost="1000000.01"),
        drug(brand="c", cost="100000.01"),
        drug(brand="d", cost="10000.01"),
        drug(brand="e", cost="10000", claims="0"),
        drug(brand="f", cost="*", claims="*", benes=""),
        drug(npi="2", brand="h", cost="1"),
        drug(npi="", brand="z"),
        drug(brand="g"),
        drug(brand="i", generic=None),
        drug(brand=None),
    ]
    out = prescriptions(spark, rows, listed=["2"]).collect()
    named = {r["BRAND_NAME"]: r for r in out}
    assert [named[b]["RISK_TIER"] for b in "abcdefh"] == ["HIGH", "VERY_HIGH", "HIGH", "MEDIUM", "LOW", "LOW", "CRITICAL"]
    assert "z" not in named
    assert (named["a"]["DRUG_TYPE"], named["g"]["DRUG_TYPE"], named["i"]["DRUG_TYPE"], named[None]["DRUG_TYPE"]) == (
        "BRAND", "GENERIC", "GENERIC", "GENERIC",
    )
    assert named["e"]["AVG_COST_PER_CLAIM"] == 0 and named["f"]["AVG_COST_PER_CLAIM"] == 0
    assert named["a"]["IS_HIGH_COST_PRESCRIBER"] and not named["f"]["IS_HIGH_COST_PRESCRIBER"]
    assert not named["a"]["IS_HIGH_VOLUME_PRESCRIBER"]


def test_prescription_summary(spark):
    rows = [drug(brand="g", claims="3", cost="10"), drug(brand="x", claims="1", cost="0"), drug(brand="y", generic="h", claims="*", cost="5")]
    row = build_prescriptions_summary(prescriptions(spark, rows)).first()
    assert (row["TOTAL_CLAIMS"], row["BRAND_CLAIMS"], row["PCT_BRAND_CLAIMS"]) == (4, 1, 25)
    assert (row["UNIQUE_DRUGS_PRESCRIBED"], row["TOTAL_DRUG_RECORDS"]) == (2, 3)
    # Mean of the row ratios 3.33, 0 and 0; cost per claim of the totals.
    assert (row["AVG_COST_PER_CLAIM"], row["COST_PER_CLAIM"]) == (Decimal("1.11"), Decimal("3.75"))


def test_unknown_claims_take_the_first_rank(spark):
    rows = [drug(generic="n", claims="*"), drug(generic="a", claims="6"), drug(generic="b", claims="3"), drug(generic="c", claims="1")]
    row = build_drug_concentration(prescriptions(spark, rows)).first()
    assert row["TOP_DRUG_PCT"] == 0 and row["TOP_3_DRUGS_PCT"] == 90
    assert row["DRUG_HHI"] == 4600.0 and row["UNIQUE_DRUGS"] == 4


def test_unnamed_drug_counts_in_concentration_only(spark):
    row = build_drug_concentration(prescriptions(spark, [drug(generic=None, claims="5"), drug(generic="a", claims="5")])).first()
    assert row["UNIQUE_DRUGS"] == 1 and row["DRUG_HHI"] == 5000.0


# --- facilities and spending --------------------------------------------------------------------------


def test_ownership_categories(spark):
    owners = {
        "For profit - Corporation": "FOR_PROFIT",
        "PROPRIETARY": "OTHER",
        "Non profit - Church": "NON_PROFIT",
        "Nonprofit": "NON_PROFIT",
        "Not For Profit": "FOR_PROFIT",
        "Government - County": "GOVERNMENT",
        None: "OTHER",
    }
    df = spark.createDataFrame([(k,) for k in owners], "o string")
    assert {r[0]: r[1] for r in df.select("o", ownership_category(F.col("o"))).collect()} == owners


def test_one_number_in_two_facility_types(spark):
    hospice = bronze(spark, "HOSPICE", [{"CMS_CERTIFICATION_NUMBER": "C1", "_LOAD_TIMESTAMP": datetime(2024, 1, 1)}])
    home = bronze(
        spark,
        "HOME_HEALTH_CARE",
        [{"CMS_CERTIFICATION_NUMBER": "C1", "ADDRESS": "a", "CITY": "c", "STATE": "s", "ZIP_CODE": "z", "_LOAD_TIMESTAMP": datetime(2024, 1, 2)}],
    )
    ltch = bronze(spark, "LONGTERM_CARE_HOSPITAL", [{"CMS_CERTIFICATION_NUMBER": None}])
    nursing = bronze(
        spark,
        "PROVIDER_INFORMATION",
        [
            {"FEDERAL_PROVIDER_NUMBER": "N1", "OVERALL_RATING": "1", "NUMBER_OF_CERTIFIED_BEDS": "8", "NUMBER_OF_RESIDENTS": "5", "DATE_FIRST_APPROVED": "2020-13-01"},
            {"FEDERAL_PROVIDER_NUMBER": "N2", "OVERALL_RATING": "x", "NUMBER_OF_CERTIFIED_BEDS": "0", "NUMBER_OF_RESIDENTS": "5"},
        ],
    )
    out = by(build_facilities(hospice, home, ltch, nursing), "CCN")
    assert set(out) == {"C1", "N1", "N2"}
    assert out["C1"]["FACILITY_TYPE"] == "HOME_HEALTH" and out["C1"]["FULL_ADDRESS"] == "a, c, s, z"
    assert out["N1"]["OCCUPANCY_RATE"] == Decimal("62.5") and out["N1"]["IS_LOW_QUALITY"]
    assert out["N1"]["CERTIFICATION_DATE"] is None and out["N1"]["FULL_ADDRESS"] is None
    assert out["N2"]["OCCUPANCY_RATE"] is None and not out["N2"]["IS_LOW_QUALITY"]


@pytest.mark.parametrize(
    ("own", "state", "nation", "expected"),
    [
        ("150", "100", "100", ("ABOVE_STATE_AVG_20PCT", "ABOVE_NATIONAL_AVG_20PCT", False, "MEDIUM", Decimal("50.00"))),
        ("150.01", "100", "100", ("ABOVE_STATE_AVG_20PCT", "ABOVE_NATIONAL_AVG_20PCT", True, "HIGH", Decimal("50.01"))),
        ("120", "100", "100", ("AT_STATE_AVG", "AT_NATIONAL_AVG", False, "NORMAL", Decimal("20.00"))),
        ("79.99", "100", "100", ("BELOW_STATE_AVG", "BELOW_NATIONAL_AVG", False, "LOW", Decimal("-20.01"))),
        ("80", "x", "0", ("AT_STATE_AVG", "ABOVE_NATIONAL_AVG_20PCT", False, "NORMAL", None)),
    ],
)
def test_spending_benchmarks(spark, own, state, nation, expected):
    row = {
        "FACILITY_ID": "1", "STATE": "NY", "AVG_SPENDING_PER_EPISODE_HOSPITAL": own,
        "AVG_SPENDING_PER_EPISODE_STATE": state, "AVG_SPENDING_PER_EPISODE_NATION": nation,
    }
    out = build_hospital_spending(bronze(spark, "MEDICARE_HOSPITAL_SPENDING", [row, {**row, "STATE": None}])).collect()
    assert len(out) == 1
    names = "STATE_BENCHMARK_STATUS NATIONAL_BENCHMARK_STATUS IS_HIGH_SPENDER SPENDING_RISK_TIER PCT_VARIANCE_FROM_NATION"
    assert tuple(out[0][n] for n in names.split()) == expected


# --- profile, score, alerts, features -----------------------------------------------------------------

_MONEY = T.DecimalType(28, 2)
_PCT = T.DecimalType(9, 2)
PROFILE_TYPES = {
    "IS_NPI_ACTIVE": T.BooleanType(), "IS_EXCLUDED": T.BooleanType(), "IS_EXCLUDED_HIGH_RISK": T.BooleanType(),
    "HAS_PHARMA_PAYMENTS": T.BooleanType(), "HAS_PRESCRIPTIONS": T.BooleanType(),
    "PCT_HIGH_RISK_PAYMENTS": _PCT, "PCT_BRAND_CLAIMS": _PCT, "TOTAL_HIGH_RISK_DRUGS": T.LongType(),
    "TOTAL_PAYMENT_AMOUNT": _MONEY, "TOTAL_PRESCRIPTION_COST": _MONEY, "TOTAL_FINANCIAL_EXPOSURE": _MONEY,
    "TOTAL_PRESCRIPTION_CLAIMS": T.LongType(),
}
PROFILE = ["NPI", "FULL_NAME", "ORGANIZATION_NAME", "ENTITY_TYPE", "SPECIALTY", "STATE", "RECIPIENT_TIER", *PROFILE_TYPES]


def profiles(spark, rows):
    base = {
        "IS_NPI_ACTIVE": True, "IS_EXCLUDED": False, "IS_EXCLUDED_HIGH_RISK": False, "HAS_PHARMA_PAYMENTS": False,
        "HAS_PRESCRIPTIONS": False, "TOTAL_HIGH_RISK_DRUGS": 0, "TOTAL_PRESCRIPTION_CLAIMS": 0,
        "STATE": "NY", "SPECIALTY": "S",
        **{n: Decimal(0) for n, t in PROFILE_TYPES.items() if isinstance(t, T.DecimalType)},
    }
    return make(spark, PROFILE, [{"NPI": str(i), **base, **r} for i, r in enumerate(rows)], **PROFILE_TYPES)


def score_of(spark, **profile):
    row = build_risk_score(profiles(spark, [profile])).first()
    return row["FRAUD_RISK_SCORE"], row["RISK_TIER"]


def test_score_parts(spark):
    assert score_of(spark) == (0, "MINIMAL")
    assert score_of(spark, PCT_HIGH_RISK_PAYMENTS=Decimal("49.90")) == (5, "MINIMAL")
    assert score_of(spark, PCT_HIGH_RISK_PAYMENTS=Decimal("50")) == (10, "LOW")
    assert score_of(spark, PCT_BRAND_CLAIMS=Decimal("79.99")) == (8, "MINIMAL")
    assert score_of(spark, PCT_BRAND_CLAIMS=Decimal("80")) == (10, "LOW")
    assert score_of(spark, TOTAL_HIGH_RISK_DRUGS=11) == (10, "LOW")
    assert score_of(spark, RECIPIENT_TIER="MAJOR_RECIPIENT") == (5, "MINIMAL")
    assert score_of(spark, HAS_PHARMA_PAYMENTS=True, HAS_PRESCRIPTIONS=True) == (10, "LOW")
    assert score_of(spark, HAS_PHARMA_PAYMENTS=True, IS_NPI_ACTIVE=False) == (10, "LOW")
    assert score_of(spark, IS_NPI_ACTIVE=False) == (0, "MINIMAL")


def test_tier_uses_the_unrounded_score(spark):
    parts = {
        "IS_EXCLUDED": True, "IS_EXCLUDED_HIGH_RISK": True, "RECIPIENT_TIER": "MEGA_RECIPIENT",
        "PCT_HIGH_RISK_PAYMENTS": Decimal("50"), "PCT_BRAND_CLAIMS": Decimal("16"), "TOTAL_HIGH_RISK_DRUGS": 8,
    }
    assert score_of(spark, **parts) == (70, "HIGH")  # raw score 69.6
    assert score_of(spark, **{**parts, "PCT_BRAND_CLAIMS": Decimal("20")}) == (70, "CRITICAL")


def test_profile_defaults(spark):
    people = build_provider(
        registry(spark, [{"NPI": "1"}, {"NPI": "2"}]), addresses(spark, []), taxonomies(spark, []), leie(spark, [])
    )
    paid = build_payments_summary(
        payments(spark, [{"Record_ID": "1", "Covered_Recipient_NPI": "1", "Total_Amount_of_Payment_USDollars": "12.5"}])
    )
    prescribed = build_prescriptions_summary(prescriptions(spark, [drug(npi="1", cost="7.25")]))
    excluded = build_exclusions(
        leie(spark, [{"NPI": "1", "LASTNAME": "a", "EXCLDATE": "20200101"}, {"NPI": "1", "LASTNAME": "b", "EXCLDATE": "20209999"}]),
        registry(spark, [{"NPI": "1"}]),
        addresses(spark, []),
    )
    out = by(build_provider_360(people, paid, prescribed, excluded), "NPI")
    assert out["1"]["TOTAL_FINANCIAL_EXPOSURE"] == Decimal("19.75")
    assert out["1"]["EXCLUSION_DATE"] is None and out["1"]["IS_EXCLUDED_HIGH_RISK"]  # unreadable date is the latest
    assert out["2"]["TOTAL_PAYMENTS"] == 0 and out["2"]["RECIPIENT_TIER"] is None
    assert not out["2"]["HAS_PHARMA_PAYMENTS"] and out["2"]["IS_CURRENTLY_EXCLUDED"] is None
    assert not out["2"]["IS_EXCLUDED_HIGH_RISK"]


def test_alert_rows_with_one_id_keep_the_largest(spark):
    general = [
        {"Record_ID": "1", "Covered_Recipient_NPI": "1", "Covered_Recipient_First_Name": "A", "Covered_Recipient_Last_Name": "B", PAYER: "p", "Total_Amount_of_Payment_USDollars": "5"},
        {"Record_ID": "2", "Covered_Recipient_NPI": "1", "Covered_Recipient_First_Name": "A", "Covered_Recipient_Last_Name": "C", PAYER: "p", "Total_Amount_of_Payment_USDollars": "7"},
        {"Record_ID": "3", "Covered_Recipient_NPI": "5", PAYER: "p", "Total_Amount_of_Payment_USDollars": "7"},
    ]
    paid = payments(spark, general, listed=["1", "5"])
    profile = profiles(spark, [{"NPI": "1"}])
    assert paid_while_excluded_alerts(paid, profile.select("NPI")).count() == 2
    no_drugs = prescriptions(spark, [])
    exclusions = build_exclusions(leie(spark, [{"NPI": "1", "LASTNAME": "x"}]), registry(spark, [{"NPI": "1"}]), addresses(spark, []))
    out = by(build_alerts(profile, build_risk_score(profile), exclusions, paid, no_drugs, F.lit(date(2024, 1, 2))), "ALERT_TYPE")
    assert set(out) == {"PAYMENT_TO_EXCLUDED", "EXCLUDED_STILL_ACTIVE"}
    kept = out["PAYMENT_TO_EXCLUDED"]
    assert (kept["PROVIDER_NAME"], kept["FINANCIAL_EXPOSURE"], kept["PRIORITY_RANK"]) == ("A C", Decimal("7.00"), 3)
    assert kept["ALERT_DESCRIPTION"] == "Excluded provider received 1 payments totaling $7.00 from p"
    active = out["EXCLUDED_STILL_ACTIVE"]
    assert active["ALERT_DESCRIPTION"] == (
        'Provider excluded on 2020-01-01 for "Other exclusion type" but still active in NPPES'
    )
    assert active["PROVIDER_NAME"] is None and active["FINANCIAL_EXPOSURE"] is None
    assert kept["ALERT_DATE"] == date(2024, 1, 2) and kept["ALERT_STATUS"] == "PENDING"


def test_brand_alert_text_and_exclusion(spark):
    rows = [{"PCT_BRAND_CLAIMS": Decimal("85"), "ORGANIZATION_NAME": "ORG"}, {"PCT_BRAND_CLAIMS": Decimal("85"), "IS_EXCLUDED": True}]
    profile = profiles(spark, rows)
    empty = build_exclusions(leie(spark, []), registry(spark, []), addresses(spark, []))
    out = build_alerts(profile, build_risk_score(profile), empty, payments(spark), prescriptions(spark, [])).collect()
    assert [(r["NPI"], r["PROVIDER_NAME"], r["PRIORITY_RANK"]) for r in out] == [("0", "ORG", 5)]
    assert out[0]["ALERT_DESCRIPTION"].startswith("Provider has 85.00% brand prescription rate")


def test_peer_groups_need_five_active_members(spark):
    five = [{"TOTAL_PAYMENT_AMOUNT": Decimal(10)}] * 5
    four = [{"STATE": "CA", "TOTAL_PAYMENT_AMOUNT": Decimal(10)}] * 4 + [{"STATE": "CA"}]
    unknown = [{"STATE": None, "SPECIALTY": None, "TOTAL_PRESCRIPTION_COST": Decimal(1)}] * 5
    out = {(r["SPECIALTY_GROUP"], r["STATE_GROUP"]): r for r in build_peer_stats(profiles(spark, five + four + unknown)).collect()}
    assert set(out) == {("S", "NY"), ("UNKNOWN", "UNKNOWN")}
    assert out["S", "NY"]["PEER_STDDEV_PAYMENT"] == 0.0


def test_features_without_spread_or_activity(spark):
    rows = [{"TOTAL_PAYMENT_AMOUNT": Decimal(10), "IS_EXCLUDED": i == 0} for i in range(5)] + [{}]
    out = by(build_ml_features(profiles(spark, rows), prescriptions(spark, []), payments(spark)), "NPI")
    assert out["1"]["PAYMENT_ZSCORE"] == 0.0 and out["1"]["PEER_COUNT"] == 5
    assert (out["0"]["ANOMALY_FLAG_COUNT"], out["1"]["ANOMALY_FLAG_COUNT"]) == (1, 0)
    assert out["1"]["PAYMENT_VS_PEER_RATIO"] == 1.0 and out["1"]["PAYMENT_TO_RX_RATIO"] is None
    assert out["5"]["PAYMENT_PERCENTILE"] == 0.0 and out["1"]["PAYMENT_PERCENTILE"] == 20.0
    assert out["1"]["UNIQUE_DRUGS_PRESCRIBED"] == 0 and not out["1"]["IS_SINGLE_PAYER_RECIPIENT"]
