"""Expected results as DuckDB SQL over the generated tables.

Written independently of the Spark plans. Money is kept in integer cents and ratios are rounded with
integer arithmetic, so that results are exact; amounts turn into doubles only in the final select.
"""

from __future__ import annotations

import re

from verify.fixtures import SOURCES, fixture_sql

NULL_PART = "_dbt_utils_surrogate_key_null_"


def sk(*parts: str) -> str:
    filled = [f"coalesce(cast({p} as varchar), '{NULL_PART}')" for p in parts]
    return f"md5({' || chr(45) || '.join(filled)})"


def rq(num: str, den: str) -> str:
    """num / den, both integers and den positive, rounded half away from zero."""
    n, d = f"cast({num} as hugeint)", f"cast({den} as hugeint)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def cents(text: str) -> str:
    return f"cast(try_cast({text} as decimal(18,2)) * 100 as bigint)"


def count(text: str) -> str:
    return f"try_cast(try_cast({text} as decimal(38,0)) as bigint)"


def day(text: str, layout: str) -> str:
    return f"cast(try_strptime({text}, '{layout}') as date)"


def money(expr: str) -> str:
    return f"({expr}) / 100e0"


def half_away(value: str, digits: int) -> str:
    p = f"1e{digits}"
    return f"(sign({value}) * (floor(abs({value}) * {p} + 0.5e0) / {p}) + 0e0)"


def tiers(value: str, steps: list[tuple[int, str]], default: str, op: str = ">=") -> str:
    arms = " ".join(f"when {value} {op} {bound} then '{label}'" for bound, label in steps)
    return f"case {arms} else '{default}' end"


_PAYER = "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name"
_SIZE = [(10000000, "VERY_HIGH"), (1000000, "HIGH"), (100000, "MEDIUM"), (10000, "LOW")]

CTES: dict[str, str] = {f"src_{name}": fixture_sql(name) for name in SOURCES}

CTES["src_nppes_provider_active"] = "select * from src_nppes_provider where IS_ACTIVE"
CTES["m_listed"] = "select distinct NPI from src_leie where NPI <> ''"

CTES["m_exclusions"] = f"""
    select
        {sk("l.NPI", "l.EXCLDATE", "l.LASTNAME", "l.FIRSTNAME")} as EXCLUSION_ID,
        l.NPI, l.UPIN,
        upper(trim(l.LASTNAME)) as LAST_NAME, upper(trim(l.FIRSTNAME)) as FIRST_NAME,
        upper(trim(l.MIDNAME)) as MIDDLE_NAME, upper(trim(l.BUSNAME)) as BUSINESS_NAME,
        r.PROVIDER_FULL_NAME as NPPES_FULL_NAME, r.ORGANIZATION_NAME_LBN as NPPES_ORGANIZATION,
        l.GENERAL as PROVIDER_GENERAL_TYPE, l.SPECIALTY as PROVIDER_SPECIALTY,
        r.ENTITY_TYPE_DESC as NPPES_ENTITY_TYPE, r.PRIMARY_TAXONOMY_CODE as NPPES_TAXONOMY_CODE,
        upper(trim(l.ADDRESS)) as ADDRESS, upper(trim(l.CITY)) as CITY, upper(trim(l.STATE)) as STATE,
        trim(l.ZIP) as ZIP_CODE,
        a.CITY_NAME as NPPES_CITY, a.STATE_CODE as NPPES_STATE, a.POSTAL_CODE_5 as NPPES_ZIP,
        l.EXCLTYPE as EXCLUSION_TYPE_CODE,
        coalesce(t.reason, 'Other exclusion type') as EXCLUSION_REASON,
        {day("l.EXCLDATE", "%Y%m%d")} as EXCLUSION_DATE,
        {day("l.REINDATE", "%Y%m%d")} as REINSTATEMENT_DATE,
        {day("l.WAIVERDATE", "%Y%m%d")} as WAIVER_DATE,
        l.WVRSTATE as WAIVER_STATE,
        {day("l.DOB", "%Y%m%d")} as DATE_OF_BIRTH,
        coalesce(l.REINDATE, '') = '' as IS_CURRENTLY_EXCLUDED,
        r.IS_ACTIVE as NPPES_IS_ACTIVE,
        coalesce(l.REINDATE, '') = '' and coalesce(r.IS_ACTIVE, false) as IS_HIGH_RISK,
        if(l.NPI is null, 'NO_NPI_IN_LEIE', if(r.NPI is null, 'NPI_NOT_FOUND_IN_NPPES', 'NPI_MATCH')) as MATCH_STATUS
    from src_leie l
    left join src_nppes_provider_active r on r.NPI = l.NPI
    left join src_nppes_address a on a.NPI = l.NPI and a.IS_PRIMARY
    left join (values
        ('1128a1', 'Conviction of program-related crimes'),
        ('1128b4', 'License revocation or suspension'),
        ('1128b14', 'Default on health education loan or scholarship obligations')
    ) t(code, reason) on t.code = l.EXCLTYPE
    where l.EXCLDATE <> ''
    qualify row_number() over (partition by EXCLUSION_ID
        order by EXCLUSION_DATE desc nulls last, a.ADDRESS_LINE_1, a.ADDRESS_LINE_2 nulls last, a.CITY_NAME) = 1
"""

CTES["m_provider"] = """
    select
        p.NPI, p.ENTITY_TYPE_CODE, p.ENTITY_TYPE_DESC,
        case p.ENTITY_TYPE_CODE when '1' then 'Individual' when '2' then 'Organization' else 'Unknown' end as ENTITY_TYPE,
        p.ORGANIZATION_NAME_LBN as ORGANIZATION_NAME, p.PROVIDER_LAST_NAME as LAST_NAME,
        p.PROVIDER_FIRST_NAME as FIRST_NAME, p.PROVIDER_MIDDLE_NAME as MIDDLE_NAME,
        p.PROVIDER_FULL_NAME as FULL_NAME, p.PROVIDER_CREDENTIAL as CREDENTIAL,
        p.PROVIDER_SEX_CODE as GENDER_CODE, p.PROVIDER_SEX_DESC as GENDER,
        p.IS_SOLE_PROPRIETOR, p.PARENT_ORGANIZATION_LBN as PARENT_ORGANIZATION, p.EIN,
        a.ADDRESS_LINE_1, a.ADDRESS_LINE_2, a.CITY_NAME as CITY, a.STATE_CODE as STATE,
        a.POSTAL_CODE_5 as ZIP_CODE, a.TELEPHONE_NUMBER as PHONE, a.FULL_ADDRESS,
        p.PRIMARY_TAXONOMY_CODE, t.TAXONOMY_CODE, t.TAXONOMY_CLASSIFICATION as SPECIALTY_CLASSIFICATION,
        t.TAXONOMY_SPECIALIZATION as SPECIALTY, t.PROVIDER_TYPE,
        p.ENUMERATION_DATE as NPI_ENUMERATION_DATE, p.LAST_UPDATE_DATE as NPI_LAST_UPDATE_DATE,
        p.IS_ACTIVE as IS_NPI_ACTIVE,
        p.NPI in (select NPI from m_listed) as IS_EXCLUDED
    from src_nppes_provider_active p
    left join src_nppes_address a on a.NPI = p.NPI and a.IS_PRIMARY
    left join src_nppes_taxonomy t on t.NPI = p.NPI and t.IS_PRIMARY_TAXONOMY
    qualify row_number() over (partition by p.NPI
        order by p.LAST_UPDATE_DATE desc nulls last, a.ADDRESS_LINE_1, a.ADDRESS_LINE_2 nulls last,
                 a.CITY_NAME, t.TAXONOMY_CODE) = 1
"""


def _payment_branch(kind: str) -> str:
    owner = kind == "OWNERSHIP"
    person = "Physician" if owner else "Covered_Recipient"
    amount = "null" if owner else cents("Total_Amount_of_Payment_USDollars")
    when = "null" if owner else day("Date_of_Payment", "%m/%d/%Y")
    return f"""
        select '{kind}' as PAYMENT_CATEGORY, Record_ID as RECORD_ID, {person}_NPI as NPI,
            {"'Physician'" if owner else "Covered_Recipient_Type"} as RECIPIENT_TYPE,
            {person}_First_Name as FIRST_NAME, {person}_Last_Name as LAST_NAME,
            {"Physician_Specialty" if owner else "Covered_Recipient_Specialty_1"} as SPECIALTY,
            Recipient_City as CITY, Recipient_State as STATE, Recipient_Zip_Code as ZIP_CODE,
            {"null" if owner else "Teaching_Hospital_Name"} as TEACHING_HOSPITAL, {_PAYER} as PAYER_NAME,
            cast({amount} as bigint) as amount_c, cast({when} as date) as PAYMENT_DATE,
            {"null" if owner else "Form_of_Payment_or_Transfer_of_Value"} as PAYMENT_FORM,
            {"Nature_of_Payment_or_Transfer_of_Value" if kind == "GENERAL" else "null"} as PAYMENT_NATURE,
            {"Name_of_Study" if kind == "RESEARCH" else "null"} as STUDY_NAME,
            {"ClinicalTrials_Gov_Identifier" if kind == "RESEARCH" else "null"} as CLINICAL_TRIAL_ID,
            cast({cents("Total_Amount_Invested_USDollars") if owner else "null"} as bigint) as invested_c,
            {"Value_of_Interest" if owner else "null"} as INTEREST_VALUE,
            {count("Program_Year")} as PROGRAM_YEAR
        from src_open_payments_{kind.lower()}
        where Record_ID is not null
    """


CTES["m_payments"] = f"""
    select {sk("PAYMENT_CATEGORY", "RECORD_ID")} as PAYMENT_ID, u.*,
        FIRST_NAME || ' ' || LAST_NAME as FULL_NAME,
        cast(year(PAYMENT_DATE) as integer) as PAYMENT_YEAR, cast(month(PAYMENT_DATE) as integer) as PAYMENT_MONTH,
        coalesce(NPI in (select NPI from m_listed), false) as IS_RECIPIENT_EXCLUDED,
        {tiers("amount_c", _SIZE, "MINIMAL")} as PAYMENT_RISK_TIER
    from ({" union all by name ".join(_payment_branch(k) for k in ("GENERAL", "RESEARCH", "OWNERSHIP"))}) u
"""

CTES["m_drug_rows"] = f"""
    select {sk("PRSCRBR_NPI", "BRND_NAME", "GNRC_NAME")} as PRESCRIPTION_ID, PRSCRBR_NPI as NPI,
        PRSCRBR_LAST_ORG_NAME as PRESCRIBER_LAST_NAME, PRSCRBR_FIRST_NAME as PRESCRIBER_FIRST_NAME,
        PRSCRBR_FIRST_NAME || ' ' || PRSCRBR_LAST_ORG_NAME as PRESCRIBER_FULL_NAME,
        PRSCRBR_CITY as CITY, PRSCRBR_STATE_ABRVTN as STATE, PRSCRBR_TYPE as PRESCRIBER_TYPE,
        BRND_NAME as BRAND_NAME, GNRC_NAME as GENERIC_NAME,
        if(coalesce(BRND_NAME <> GNRC_NAME, false), 'BRAND', 'GENERIC') as DRUG_TYPE,
        {count("TOT_CLMS")} as claims, {cents("TOT_30DAY_FILLS")} as fills_c, {count("TOT_DAY_SUPLY")} as days,
        {cents("TOT_DRUG_CST")} as cost_c, {count("TOT_BENES")} as benes,
        {count("GE65_TOT_CLMS")} as claims65, {cents("GE65_TOT_30DAY_FILLS")} as fills65_c,
        {count("GE65_TOT_DAY_SUPLY")} as days65, {cents("GE65_TOT_DRUG_CST")} as cost65_c,
        {count("GE65_TOT_BENES")} as benes65,
        PRSCRBR_NPI in (select NPI from m_listed) as IS_PRESCRIBER_EXCLUDED
    from src_part_d
    where PRSCRBR_NPI <> ''
"""
CTES["m_prescriptions"] = f"""
    select *,
        case when claims > 0 then {rq("cost_c", "claims")} else 0 end as cost_per_claim_c,
        case when benes > 0 then {rq("cost_c", "benes")} else 0 end as cost_per_bene_c,
        case when benes > 0 then {rq("claims * 100", "benes")} else 0 end as claims_per_bene_h,
        case when fills_c > 0 then {rq("days::hugeint * 10000", "fills_c")} else 0 end as days_per_fill_h,
        if(IS_PRESCRIBER_EXCLUDED, 'CRITICAL',
           {tiers("cost_c", [(100000000, "VERY_HIGH"), (10000000, "HIGH"), (1000000, "MEDIUM")], "LOW", ">")}) as RISK_TIER
    from m_drug_rows
"""

_FACILITY_COLUMNS = (
    "FACILITY_TYPE CCN NAME ADDRESS_LINE_1 ADDRESS_LINE_2 CITY STATE ZIP_CODE COUNTY PHONE CMS_REGION"
    " OWNERSHIP_TYPE opened rating inspection staffing beds residents loaded"
)


def _facility_branch(source: str, *values: str) -> str:
    names = _FACILITY_COLUMNS.split()
    return f"select {', '.join(f'{v} as {n}' for v, n in zip(values, names, strict=True))} from src_{source}"


CTES["m_facility_rows"] = " union all ".join(
    [
        _facility_branch(
            "hospice", "'HOSPICE'", "CMS_CERTIFICATION_NUMBER", "FACILITY_NAME", "ADDRESS_LINE_1", "ADDRESS_LINE_2",
            "CITY", "STATE", "ZIP_CODE", "COUNTY_NAME", "PHONE_NUMBER", "CMS_REGION", "OWNERSHIP_TYPE",
            "CERTIFICATION_DATE", "null", "null", "null", "null", "null", "_LOAD_TIMESTAMP",
        ),
        _facility_branch(
            "home_health", "'HOME_HEALTH'", "CMS_CERTIFICATION_NUMBER", "PROVIDER_NAME", "ADDRESS", "null",
            "CITY", "STATE", "ZIP_CODE", "null", "PHONE", "null", "TYPE_OF_OWNERSHIP",
            "DATE_CERTIFIED", "null", "null", "null", "null", "null", "_LOAD_TIMESTAMP",
        ),
        _facility_branch(
            "ltch", "'LTCH'", "CMS_CERTIFICATION_NUMBER", "FACILITY_NAME", "ADDRESS", "null",
            "CITY", "STATE", "ZIP_CODE", "COUNTY_NAME", "PHONE_NUMBER", "CMS_REGION", "null",
            "null", "null", "null", "null", "null", "null", "_LOAD_TIMESTAMP",
        ),
        _facility_branch(
            "nursing_home", "'NURSING_HOME'", "FEDERAL_PROVIDER_NUMBER", "PROVIDER_NAME", "PROVIDER_ADDRESS", "null",
            "PROVIDER_CITY", "PROVIDER_STATE", "PROVIDER_ZIP_CODE", "PROVIDER_COUNTY_NAME", "PROVIDER_PHONE_NUMBER",
            "null", "OWNERSHIP_TYPE", "DATE_FIRST_APPROVED", count("OVERALL_RATING"),
            count("HEALTH_INSPECTION_RATING"), count("STAFFING_RATING"), count("NUMBER_OF_CERTIFIED_BEDS"),
            count("NUMBER_OF_RESIDENTS"), "_LOAD_TIMESTAMP",
        ),
    ]
)
CTES["m_facilities"] = f"""
    select {sk("FACILITY_TYPE", "CCN")} as FACILITY_ID, *,
        ADDRESS_LINE_1 || ', ' || CITY || ', ' || STATE || ', ' || ZIP_CODE as FULL_ADDRESS,
        case when contains(lower(OWNERSHIP_TYPE), 'profit') and not contains(lower(OWNERSHIP_TYPE), 'non') then 'FOR_PROFIT'
             when regexp_matches(lower(OWNERSHIP_TYPE), '(non|not).*profit') then 'NON_PROFIT'
             when regexp_matches(lower(OWNERSHIP_TYPE), 'government|state|county') then 'GOVERNMENT'
             else 'OTHER' end as OWNERSHIP_CATEGORY,
        {day("opened", "%Y-%m-%d")} as CERTIFICATION_DATE,
        case when beds > 0 then {rq("residents * 1000", "beds")} / 10e0 end as OCCUPANCY_RATE,
        coalesce(rating = 1, false) as IS_LOW_QUALITY
    from m_facility_rows
    where CCN is not null
    qualify row_number() over (partition by CCN order by loaded desc nulls first, FACILITY_TYPE) = 1
"""


def _variance(base: str) -> str:
    return f"case when {base} > 0 then {rq(f'(own_c - {base})::hugeint * 10000', base)} end"


CTES["m_spending"] = f"""
    with typed as (
        select *, {cents("AVG_SPENDING_PER_EPISODE_HOSPITAL")} as own_c,
            {cents("AVG_SPENDING_PER_EPISODE_STATE")} as state_c, {cents("AVG_SPENDING_PER_EPISODE_NATION")} as nation_c
        from src_spending where STATE is not null and FACILITY_ID is not null
    )
    select {sk("FACILITY_ID", "CLAIM_TYPE", "PERIOD")} as SPENDING_ID, *,
        {_variance("state_c")} as state_h, {_variance("nation_c")} as nation_h,
        case when own_c < state_c then 'BELOW_STATE_AVG' when own_c * 10 > state_c * 12 then 'ABOVE_STATE_AVG_20PCT'
             else 'AT_STATE_AVG' end as STATE_BENCHMARK_STATUS,
        case when own_c < nation_c then 'BELOW_NATIONAL_AVG' when own_c * 10 > nation_c * 12 then 'ABOVE_NATIONAL_AVG_20PCT'
             else 'AT_NATIONAL_AVG' end as NATIONAL_BENCHMARK_STATUS
    from typed
    qualify row_number() over (partition by SPENDING_ID order by _LOAD_TIMESTAMP desc nulls first) = 1
"""

CTES["m_pay_sum"] = f"""
    select *,
        case when priced > 0 then {rq("total_c", "priced")} end as avg_c,
        {rq("high_risk * 10000", "n")} as high_risk_h,
        {tiers("total_c", [(100000000, "MEGA_RECIPIENT"), (10000000, "MAJOR_RECIPIENT"),
                           (1000000, "SIGNIFICANT_RECIPIENT"), (100000, "MODERATE_RECIPIENT")],
               "MINOR_RECIPIENT")} as RECIPIENT_TIER
    from (
        select NPI, count(*) as n,
            count(*) filter (PAYMENT_CATEGORY = 'GENERAL') as n_general,
            count(*) filter (PAYMENT_CATEGORY = 'RESEARCH') as n_research,
            count(*) filter (PAYMENT_CATEGORY = 'OWNERSHIP') as n_ownership,
            coalesce(sum(amount_c), 0) as total_c,
            coalesce(sum(amount_c) filter (PAYMENT_CATEGORY = 'GENERAL'), 0) as general_c,
            coalesce(sum(amount_c) filter (PAYMENT_CATEGORY = 'RESEARCH'), 0) as research_c,
            coalesce(sum(invested_c), 0) as invested_c,
            count(amount_c) as priced, max(amount_c) as max_c,
            count(distinct PAYER_NAME) as payers,
            count(*) filter (PAYMENT_RISK_TIER = 'VERY_HIGH') as very_high,
            count(*) filter (PAYMENT_RISK_TIER = 'HIGH') as high,
            count(*) filter (PAYMENT_RISK_TIER in ('VERY_HIGH', 'HIGH')) as high_risk,
            min(PAYMENT_DATE) as first_day, max(PAYMENT_DATE) as last_day,
            count(distinct PAYMENT_YEAR) as years, bool_or(IS_RECIPIENT_EXCLUDED) as listed
        from m_payments where NPI is not null group by NPI
    )
"""

CTES["m_rx_sum"] = f"""
    select *,
        case when claims > 0 then {rq("cost_c", "claims")} else 0 end as cost_per_claim_c,
        case when claims > 0 then {rq("brand_claims * 10000", "claims")} else 0 end as brand_claims_h,
        case when cost_c > 0 then {rq("brand_cost_c * 10000", "cost_c")} else 0 end as brand_cost_h,
        critical + very_high + high as high_risk,
        {tiers("claims", [(100000, "VERY_HIGH_VOLUME"), (10000, "HIGH_VOLUME"), (1000, "MEDIUM_VOLUME")],
               "LOW_VOLUME")} as PRESCRIBER_VOLUME_TIER
    from (
        select NPI, max(PRESCRIBER_FULL_NAME) as PRESCRIBER_NAME, max(PRESCRIBER_TYPE) as SPECIALTY, max(STATE) as STATE,
            count(*) as n, sum(claims) as claims, sum(benes) as benes, sum(fills_c) as fills_c, sum(cost_c) as cost_c,
            {rq("sum(cost_per_claim_c)", "count(cost_per_claim_c)")} as mean_cost_c,
            count(distinct GENERIC_NAME) as drugs,
            sum(case when DRUG_TYPE = 'BRAND' then claims else 0 end) as brand_claims,
            sum(case when DRUG_TYPE = 'BRAND' then cost_c else 0 end) as brand_cost_c,
            count(*) filter (RISK_TIER = 'CRITICAL') as critical,
            count(*) filter (RISK_TIER = 'VERY_HIGH') as very_high,
            count(*) filter (RISK_TIER = 'HIGH') as high,
            bool_or(IS_PRESCRIBER_EXCLUDED) as listed
        from m_prescriptions group by NPI
    )
"""

CTES["m_last_exclusion"] = """
    from m_exclusions where NPI is not null
    qualify row_number() over (partition by NPI order by EXCLUSION_DATE desc nulls first, EXCLUSION_ID) = 1
"""
CTES["m_360"] = """
    select p.NPI, p.ENTITY_TYPE, p.FULL_NAME, p.ORGANIZATION_NAME, p.CREDENTIAL, p.GENDER, p.CITY, p.STATE,
        p.ZIP_CODE, p.PHONE, p.SPECIALTY_CLASSIFICATION, p.SPECIALTY, p.PROVIDER_TYPE, p.IS_NPI_ACTIVE,
        p.NPI_ENUMERATION_DATE, p.IS_EXCLUDED, e.EXCLUSION_REASON, e.EXCLUSION_DATE, e.IS_CURRENTLY_EXCLUDED,
        coalesce(e.IS_HIGH_RISK, false) as IS_EXCLUDED_HIGH_RISK,
        coalesce(y.n, 0) as payments, coalesce(y.total_c, 0) as pay_c, coalesce(y.payers, 0) as payers,
        y.RECIPIENT_TIER, coalesce(y.high_risk_h, 0) as high_risk_h, y.first_day, y.last_day,
        coalesce(x.claims, 0) as claims, coalesce(x.cost_c, 0) as rx_c, coalesce(x.drugs, 0) as drugs,
        coalesce(x.brand_claims_h, 0) as brand_h, x.PRESCRIBER_VOLUME_TIER, coalesce(x.high_risk, 0) as risky_drugs,
        y.NPI is not null as HAS_PHARMA_PAYMENTS, x.NPI is not null as HAS_PRESCRIPTIONS,
        coalesce(y.total_c, 0) + coalesce(x.cost_c, 0) as exposure_c,
        coalesce(p.FULL_NAME, p.ORGANIZATION_NAME) as NAME
    from m_provider p
    left join m_pay_sum y on y.NPI = p.NPI
    left join m_rx_sum x on x.NPI = p.NPI
    left join m_last_exclusion e on e.NPI = p.NPI
"""

# The raw score is kept in thousandths: a percentage in hundredths counts one thousandth of a point each.
CTES["m_score"] = f"""
    select *, cast(least({rq("raw_m", "1000")}, 100) as integer) as FRAUD_RISK_SCORE,
        {tiers("raw_m", [(70000, "CRITICAL"), (50000, "HIGH"), (30000, "MEDIUM"), (10000, "LOW")], "MINIMAL")} as RISK_TIER,
        brand_h >= 8000 as IS_HIGH_BRAND_PRESCRIBER,
        coalesce(RECIPIENT_TIER in ('MEGA_RECIPIENT', 'MAJOR_RECIPIENT'), false) as IS_MAJOR_PAYMENT_RECIPIENT
    from (
        select *,
            if(IS_EXCLUDED, 25000, 0) + if(IS_EXCLUDED_HIGH_RISK, 15000, 0)
            + case RECIPIENT_TIER when 'MEGA_RECIPIENT' then 10000 when 'MAJOR_RECIPIENT' then 5000 else 0 end
            + if(high_risk_h >= 5000, 10000, high_risk_h) + if(brand_h >= 8000, 10000, brand_h)
            + least(risky_drugs, 10) * 1000
            + if(HAS_PHARMA_PAYMENTS and HAS_PRESCRIPTIONS, 10000, 0)
            + if(not IS_NPI_ACTIVE and (HAS_PHARMA_PAYMENTS or HAS_PRESCRIPTIONS), 10000, 0) as raw_m
        from m_360
    )
"""


def _dollar_text(value: str) -> str:
    return f"(cast({value} // 100 as varchar) || '.' || lpad(cast({value} % 100 as varchar), 2, '0'))"


CTES["m_alerts"] = f"""
    with found as (
        select {sk("NPI", "'HIGH_RISK_SCORE'")} as ALERT_ID, 'HIGH_RISK_SCORE' as ALERT_TYPE, NPI, NAME as PROVIDER_NAME,
            SPECIALTY, STATE, FRAUD_RISK_SCORE as RISK_SCORE, RISK_TIER,
            'Provider has fraud risk score of ' || FRAUD_RISK_SCORE || ' (' || RISK_TIER || ')' as ALERT_DESCRIPTION,
            exposure_c, case RISK_TIER when 'CRITICAL' then 4 else 6 end as PRIORITY_RANK
        from m_score where RISK_TIER in ('CRITICAL', 'HIGH')
        union all
        select {sk("NPI", "'HIGH_BRAND_PRESCRIBER'")}, 'HIGH_BRAND_PRESCRIBER', NPI, NAME, SPECIALTY, STATE,
            FRAUD_RISK_SCORE, 'HIGH',
            'Provider has ' || {_dollar_text("brand_h")} || '% brand prescription rate (potential kickback indicator)',
            rx_c, 5
        from m_score where brand_h >= 8000 and not IS_EXCLUDED
        union all
        select {sk("NPI", "'EXCLUDED_STILL_ACTIVE'")}, 'EXCLUDED_STILL_ACTIVE', NPI,
            coalesce(NPPES_FULL_NAME, LAST_NAME || ' ' || FIRST_NAME), PROVIDER_SPECIALTY, STATE, 100, 'CRITICAL',
            'Provider excluded on ' || EXCLUSION_DATE || ' for "' || EXCLUSION_REASON || '" but still active in NPPES',
            null, 1
        from (
            from m_exclusions where IS_CURRENTLY_EXCLUDED and NPI in (select NPI from m_360)
            qualify row_number() over (partition by NPI order by EXCLUSION_DATE desc nulls first, EXCLUSION_ID) = 1
        ) where IS_HIGH_RISK
        union all
        select {sk("NPI", "PAYER_NAME", "'PAYMENT_TO_EXCLUDED'")}, 'PAYMENT_TO_EXCLUDED', NPI, FULL_NAME, SPECIALTY, STATE,
            90, 'CRITICAL',
            'Excluded provider received ' || count(*) || ' payments totaling $' || {_dollar_text("sum(amount_c)")}
                || ' from ' || PAYER_NAME,
            sum(amount_c), 3
        from m_payments where IS_RECIPIENT_EXCLUDED and NPI in (select NPI from m_360)
        group by NPI, FULL_NAME, SPECIALTY, STATE, PAYER_NAME
        union all
        select {sk("NPI", "'PRESCRIPTION_BY_EXCLUDED'")}, 'PRESCRIPTION_BY_EXCLUDED', NPI, PRESCRIBER_FULL_NAME,
            PRESCRIBER_TYPE, STATE, 95, 'CRITICAL',
            'Excluded provider prescribed ' || sum(claims) || ' claims totaling $' || {_dollar_text("sum(cost_c)")},
            sum(cost_c), 2
        from m_prescriptions where IS_PRESCRIBER_EXCLUDED and NPI in (select NPI from m_360)
        group by NPI, PRESCRIBER_FULL_NAME, PRESCRIBER_TYPE, STATE
    )
    from found
    qualify row_number() over (partition by ALERT_ID order by PRIORITY_RANK, exposure_c desc nulls last,
        PROVIDER_NAME nulls last, SPECIALTY nulls last, STATE nulls last, ALERT_DESCRIPTION nulls last) = 1
"""

MEASURES = {"PAYMENT": "pay_c / 100e0", "RX_COST": "rx_c / 100e0", "BRAND_PCT": "brand_h / 100e0", "CLAIMS": "claims::double"}
_SUMS = {"PAYMENT": "pay_c", "RX_COST": "rx_c", "BRAND_PCT": "brand_h", "CLAIMS": "claims"}

CTES["m_grouped"] = f"""
    select *, coalesce(SPECIALTY, 'UNKNOWN') as sg, coalesce(STATE, 'UNKNOWN') as stg,
        {", ".join(f"{expr} as v_{name}" for name, expr in MEASURES.items())}
    from m_360
"""


def _exact_mean(name: str) -> str:
    scale = "1e0" if name == "CLAIMS" else "100e0"
    return f"(cast(sum({_SUMS[name]}) as double) / {scale}) / count(*)"


CTES["m_peers"] = f"""
    select sg, stg, count(*) as PEER_COUNT,
        {", ".join(f"{_exact_mean(n)} as PEER_AVG_{n}" for n in MEASURES)},
        {", ".join(f"stddev_samp(v_{n}) as PEER_STDDEV_{n}" for n in MEASURES)},
        median(v_PAYMENT) as PEER_MEDIAN_PAYMENT, median(v_RX_COST) as PEER_MEDIAN_RX_COST
    from m_grouped where pay_c > 0 or rx_c > 0
    group by sg, stg
"""

CTES["m_drugs"] = """
    select NPI, GENERIC_NAME, sum(claims) as c,
        row_number() over (partition by NPI order by sum(claims) desc nulls first, GENERIC_NAME nulls last) as rn
    from m_prescriptions group by NPI, GENERIC_NAME
"""
CTES["m_concentration"] = """
    select NPI, count(distinct GENERIC_NAME) as UNIQUE_DRUGS, sum(c) as t,
        cast(sum(c * c) as double) * 10000e0 / nullif(cast(sum(c) as double) * cast(sum(c) as double), 0) as hhi,
        coalesce(max(c) filter (rn = 1), 0) as top1, coalesce(sum(c) filter (rn <= 3), 0) as top3
    from m_drugs group by NPI
"""
CTES["m_diversity"] = """
    select NPI, count(distinct PAYER_NAME) as companies, count(*) as records, max(s) as biggest, sum(s) as t,
        sum(case when PAYMENT_CATEGORY = 'GENERAL' then s else 0 end) as general,
        sum(case when PAYMENT_CATEGORY = 'RESEARCH' then s else 0 end) as research
    from (select NPI, PAYER_NAME, PAYMENT_CATEGORY, sum(amount_c) as s from m_payments
          where NPI is not null group by all)
    group by NPI
"""
CTES["m_percentiles"] = f"""
    select NPI, {", ".join(
        f"percent_rank() over (partition by sg, stg order by {_SUMS[n]}) * 100e0 as {n}_PERCENTILE" for n in MEASURES)}
    from m_grouped
"""


def _share(part: str, total: str, digits: int) -> str:
    """part / total in percent, rounded, as a double; NULL for an unknown or zero total."""
    return f"case when {total} > 0 then {rq(f'({part})::hugeint * {100 * 10**digits}', total)} / 1e{digits} end"


def _zscore(name: str) -> str:
    return (
        f"case when q.PEER_STDDEV_{name} > 0 then (g.v_{name} - q.PEER_AVG_{name}) / q.PEER_STDDEV_{name} else 0e0 end"
    )


CTES["m_z"] = f"""
    select g.NPI, q.PEER_COUNT, q.PEER_AVG_PAYMENT, {", ".join(f"{_zscore(n)} as z_{n}" for n in MEASURES)}
    from m_grouped g left join m_peers q on q.sg = g.sg and q.stg = g.stg and q.PEER_COUNT >= 5
"""
CTES["m_ml"] = f"""
    select g.NPI, g.FULL_NAME, g.ORGANIZATION_NAME, g.ENTITY_TYPE, g.SPECIALTY, g.STATE,
        {money("g.pay_c")} as TOTAL_PAYMENT_AMOUNT, {money("g.rx_c")} as TOTAL_PRESCRIPTION_COST,
        cast(g.claims as bigint) as TOTAL_PRESCRIPTION_CLAIMS, {money("g.brand_h")} as PCT_BRAND_CLAIMS, g.IS_EXCLUDED,
        coalesce(z.PEER_COUNT, 0) as PEER_COUNT,
        {", ".join(f"{half_away(f'z.z_{n}', 2)} as {n}_ZSCORE" for n in MEASURES)},
        case when g.rx_c > 0 then {rq("g.pay_c * 10000", "g.rx_c")} / 1e4 end as PAYMENT_TO_RX_RATIO,
        case when g.claims > 0 then {rq("g.rx_c", "g.claims")} / 1e2 end as AVG_COST_PER_CLAIM,
        case when z.PEER_AVG_PAYMENT > 0 then {half_away("(g.v_PAYMENT / z.PEER_AVG_PAYMENT)", 2)} end as PAYMENT_VS_PEER_RATIO,
        coalesce(c.UNIQUE_DRUGS, 0) as UNIQUE_DRUGS_PRESCRIBED,
        {half_away("coalesce(c.hhi, 0e0)", 0)} as DRUG_CONCENTRATION_HHI,
        coalesce({_share("c.top1", "c.t", 1)}, 0e0) as TOP_DRUG_PCT,
        coalesce({_share("c.top3", "c.t", 1)}, 0e0) as TOP_3_DRUGS_PCT,
        coalesce(c.hhi > 2500, false) as IS_CONCENTRATED_PRESCRIBER,
        coalesce(d.companies, 0) as UNIQUE_PHARMA_COMPANIES,
        coalesce({_share("d.biggest", "d.t", 1)}, 0e0) as TOP_PAYER_PCT,
        coalesce({_share("d.general", "d.t", 1)}, 0e0) as PCT_GENERAL_PAYMENTS,
        coalesce({_share("d.research", "d.t", 1)}, 0e0) as PCT_RESEARCH_PAYMENTS,
        coalesce(d.companies = 1, false) as IS_SINGLE_PAYER_RECIPIENT,
        {", ".join(f"{half_away(f'r.{n}_PERCENTILE', 1)} as {n}_PERCENTILE" for n in MEASURES)},
        {" + ".join(f"(z.z_{n} > 2)::int" for n in MEASURES)} >= 2 as IS_MULTI_DIMENSION_OUTLIER,
        cast((z.z_PAYMENT > 2)::int + (z.z_RX_COST > 2)::int + (z.z_BRAND_PCT > 2)::int
            + coalesce(c.hhi > 2500, false)::int + (coalesce(d.companies, 0) = 1 and g.pay_c > 1000000)::int
            + g.IS_EXCLUDED::int as integer) as ANOMALY_FLAG_COUNT
    from m_grouped g
    join m_z z on z.NPI = g.NPI
    join m_percentiles r on r.NPI = g.NPI
    left join m_concentration c on c.NPI = g.NPI
    left join m_diversity d on d.NPI = g.NPI
"""

_IDENTIFIER = re.compile(r"\b(?:src|m|o|f)_\w+\b")


def compose(select: str) -> str:
    """A statement with every common table expression it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_IDENTIFIER.findall(text)):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(select)
    if not ordered:
        return select
    parts = ",\n".join(f"{name} as materialized ({CTES[name]})" for name in ordered)
    return f"with {parts}\n{select}"
