"""Domain-shaped inputs derived from the generated tables.

The test data has no healthcare tables, so each one is a projection of a generated table, written once in
the subset of SQL that Spark and DuckDB share. Names in braces stand for generated tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_NULL = "cast(null as string)"


def _npi(key: str) -> str:
    return f"cast(1000000000 + {key} as string)"


def _p2(number: str) -> str:
    return f"lpad(cast({number} as string), 2, '0')"


def _power(exponent: str, highest: int) -> str:
    cases = " ".join(f"when {exponent} = {n} then {10**n}" for n in range(highest))
    return f"case {cases} else {10**highest} end"


def _exclusion(copy: int, condition: str) -> str:
    return f"""
        select
            ' last' || cast(c_custkey as string) as LASTNAME,
            case when c_custkey % 6 = 0 then {_NULL} else 'first ' end as FIRSTNAME,
            'm' as MIDNAME,
            case when c_custkey % 9 = 0 then c_name end as BUSNAME,
            'GENERAL ' || cast(c_custkey % 3 as string) as GENERAL,
            c_mktsegment as SPECIALTY,
            'U' || cast(c_custkey as string) as UPIN,
            case when c_custkey % 11 = 0 then '' when c_custkey % 37 = 0 then {_NULL} else {_npi("c_custkey")} end as NPI,
            case when c_custkey % 8 = 0 then '00000000'
                 else cast(1940 + c_custkey % 50 as string) || '0615' end as DOB,
            cast(c_custkey as string) || ' main st ' as ADDRESS,
            'city ' || cast(c_custkey % 9 as string) as CITY,
            ' st' || cast(c_nationkey as string) as STATE,
            lpad(cast(c_custkey % 100000 as string), 5, '0') || ' ' as ZIP,
            case c_custkey % 4 when 0 then '1128a1' when 1 then '1128b4' when 2 then '1128b14' else 'zzz' end as EXCLTYPE,
            case when c_custkey % 19 = 0 then ''
                 else cast(2010 + c_custkey % 10 + {copy} as string)
                      || {_p2("1 + c_custkey % 12")} || {_p2("1 + c_custkey % 30")} end as EXCLDATE,
            case when c_custkey % 5 = 0 then '20220115' else '' end as REINDATE,
            case when c_custkey % 10 = 0 then '20230101' else '' end as WAIVERDATE,
            case when c_custkey % 10 = 0 then 'NY' else '' end as WVRSTATE
        from {{customer}}
        where c_acctbal < 0 and {condition}
    """


def _address(copy: int) -> str:
    return f"""
        select
            {_npi("c_custkey")} as NPI,
            {"true" if copy == 0 else "c_custkey % 17 = 0"} as IS_PRIMARY,
            cast(c_custkey + {copy} as string) || ' oak ave' as ADDRESS_LINE_1,
            case when c_custkey % 3 = {copy} then 'suite ' || cast(c_custkey % 7 as string) end as ADDRESS_LINE_2,
            'CITY ' || cast((c_custkey + {copy}) % 9 as string) as CITY_NAME,
            n_name as STATE_CODE,
            lpad(cast((c_custkey * 7 + {copy}) % 100000 as string), 5, '0') as POSTAL_CODE_5,
            '555' || lpad(cast(c_custkey % 10000000 as string), 7, '0') as TELEPHONE_NUMBER,
            cast(c_custkey + {copy} as string) || ' oak ave, ' || n_name as FULL_ADDRESS
        from {{customer}} join {{nation}} on c_nationkey = n_nationkey
    """


_PAYER_NUMBER = "case when o_custkey % 9 = 0 then o_custkey % 6 else o_orderkey % 6 end"
_AMOUNT = f"""case when o_orderkey % 97 = 0 then 'N/A' else
    cast(cast(floor(o_totalprice / {_power("o_custkey % 5", 4)}) as bigint) as string)
    || '.' || {_p2("o_orderkey % 100")} end"""
_ORDER_DAY = (
    f"{_p2('month(o_orderdate)')} || '/' || {_p2('day(o_orderdate)')}"
    " || '/' || cast(year(o_orderdate) as string)"
)
_ORDER_NPI = f"case when o_orderkey % 23 = 0 then '' else {_npi('o_custkey')} end"


def _payments(status: str, person: str, specialty: str, columns: str) -> str:
    return f"""
        select
            cast(o_orderkey as string) as Record_ID,
            {_ORDER_NPI} as {person}_NPI,
            'First' || cast(o_custkey % 50 as string) as {person}_First_Name,
            case when o_orderkey % 41 = 0 then {_NULL} else 'Last' || cast(o_custkey as string) end as {person}_Last_Name,
            'SPEC ' || cast(o_custkey % 5 as string) as {specialty},
            'CITY ' || cast(o_custkey % 9 as string) as Recipient_City,
            'ST' || cast(o_custkey % 25 as string) as Recipient_State,
            lpad(cast(o_custkey % 100000 as string), 5, '0') as Recipient_Zip_Code,
            'PAYER ' || cast({_PAYER_NUMBER} as string)
                as Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name,
            cast(year(o_orderdate) as string) as Program_Year,
            {columns}
        from {{orders}}
        where o_orderstatus = '{status}'
    """


_TRANSFER = f"""
            case when o_orderkey % 6 = 0 then 'Covered Recipient Non-Physician Practitioner'
                 else 'Covered Recipient Physician' end as Covered_Recipient_Type,
            case when o_orderkey % 15 = 0 then 'HOSPITAL ' || cast(o_custkey % 4 as string) else '' end as Teaching_Hospital_Name,
            {_AMOUNT} as Total_Amount_of_Payment_USDollars,
            {_ORDER_DAY} as Date_of_Payment,
            o_orderpriority as Form_of_Payment_or_Transfer_of_Value"""

_SUPPLIER_CCN = "'C' || lpad(cast(case when s_suppkey % 10 = 0 then s_suppkey + 1 else s_suppkey end as string), 6, '0')"
_SUPPLIER_OWNER = """case s_suppkey % 7 when 0 then 'For profit - Corporation' when 1 then 'Non profit - Church'
    when 2 then 'Government - County' when 3 then 'Not For Profit' when 4 then 'PROPRIETARY' when 5 then 'Nonprofit' end"""
_SUPPLIER_DATE = f"case when s_suppkey % 9 = 0 then '2020-13-01' else '2020-' || {_p2('1 + s_suppkey % 12')} || '-15' end"
_SUPPLIER_LOADED = (
    "make_date(cast(2000 + floor(s_suppkey / 300) as int), cast(1 + s_suppkey % 12 as int),"
    " cast(1 + s_suppkey % 28 as int))"
)


def _facility(remainder: int, columns: str) -> str:
    return f"""
        select {columns}, {_SUPPLIER_LOADED} as _LOAD_TIMESTAMP
        from {{supplier}} join {{nation}} on s_nationkey = n_nationkey
        where s_suppkey % 4 = {remainder}
    """


def _place(prefix: str = "") -> str:
    return f"""
        'CITY ' || cast(s_suppkey % 9 as string) as {prefix}CITY,
        n_name as {prefix}STATE,
        lpad(cast(s_suppkey % 100000 as string), 5, '0') as {prefix}ZIP_CODE"""


def _measure(code: str) -> str:
    return _facility(
        2,
        f"""{_SUPPLIER_CCN} as CMS_CERTIFICATION_NUMBER, s_name as FACILITY_NAME, 'elm st' as ADDRESS, {_place()},
        'COUNTY ' || cast(s_suppkey % 3 as string) as COUNTY_NAME, '555' as PHONE_NUMBER, 'R1' as CMS_REGION,
        '{code}' as MEASURE_CODE""",
    )


def _cents(number: str) -> str:
    return f"cast(cast(floor({number} / 100e0) as bigint) as string) || '.' || {_p2(f'{number} % 100')}"


SOURCES: dict[str, str] = {
    "leie": f"{_exclusion(0, 'true')} union all {_exclusion(1, 'c_custkey % 7 = 0')}",
    "nppes_provider": f"""
        select
            {_npi("c_custkey")} as NPI,
            case when c_custkey % 20 = 0 then '2' when c_custkey % 20 = 1 then '9' else '1' end as ENTITY_TYPE_CODE,
            case when c_custkey % 20 = 0 then 'Organization' else 'Individual' end as ENTITY_TYPE_DESC,
            case when c_custkey % 20 = 0 then c_name end as ORGANIZATION_NAME_LBN,
            'LAST' || cast(c_custkey as string) as PROVIDER_LAST_NAME,
            'FIRST' || cast(c_custkey % 40 as string) as PROVIDER_FIRST_NAME,
            {_NULL} as PROVIDER_MIDDLE_NAME,
            case when c_custkey % 20 <> 0 then c_name end as PROVIDER_FULL_NAME,
            case when c_custkey % 3 = 0 then 'MD' when c_custkey % 3 = 1 then 'DO' end as PROVIDER_CREDENTIAL,
            case when c_custkey % 2 = 0 then 'F' else 'M' end as PROVIDER_SEX_CODE,
            case when c_custkey % 2 = 0 then 'Female' else 'Male' end as PROVIDER_SEX_DESC,
            'N' as IS_SOLE_PROPRIETOR,
            {_NULL} as PARENT_ORGANIZATION_LBN,
            {_NULL} as EIN,
            'TX' || cast(c_custkey % 12 as string) as PRIMARY_TAXONOMY_CODE,
            make_date(cast(2000 + c_custkey % 15 as int), 5, 1) as ENUMERATION_DATE,
            make_date(cast(2005 + c_custkey % 15 as int), cast(1 + c_custkey % 12 as int),
                      cast(1 + c_custkey % 28 as int)) as LAST_UPDATE_DATE,
            c_custkey % 25 <> 0 as IS_ACTIVE
        from {{customer}}
    """,
    "nppes_address": f"{_address(0)} union all {_address(1)}",
    "nppes_taxonomy": f"""
        select
            {_npi("c_custkey")} as NPI,
            'TX' || cast(c_custkey % 12 as string) as TAXONOMY_CODE,
            'CLASS ' || cast(c_custkey % 3 as string) as TAXONOMY_CLASSIFICATION,
            case when c_custkey % 13 <> 0 then c_mktsegment end as TAXONOMY_SPECIALIZATION,
            'PTYPE ' || cast(c_custkey % 2 as string) as PROVIDER_TYPE,
            true as IS_PRIMARY_TAXONOMY
        from {{customer}}
    """,
    "taxonomy_code": """
        select 'TX' || cast(c_custkey % 12 as string) as TAXONOMY_CODE,
               max('CLASS ' || cast(c_custkey % 3 as string)) as TAXONOMY_CLASSIFICATION,
               max(c_custkey % 12) <> 5 as IS_ACTIVE
        from {customer}
        group by 'TX' || cast(c_custkey % 12 as string)
    """,
    "open_payments_general": _payments(
        "O",
        "Covered_Recipient",
        "Covered_Recipient_Specialty_1",
        _TRANSFER
        + """,
            'NATURE ' || cast(o_orderkey % 4 as string) as Nature_of_Payment_or_Transfer_of_Value""",
    ),
    "open_payments_research": _payments(
        "F",
        "Covered_Recipient",
        "Covered_Recipient_Specialty_1",
        _TRANSFER
        + """,
            'STUDY ' || cast(o_orderkey % 10 as string) as Name_of_Study,
            'NCT' || lpad(cast(o_orderkey as string), 8, '0') as ClinicalTrials_Gov_Identifier""",
    ),
    "open_payments_ownership": _payments(
        "P",
        "Physician",
        "Physician_Specialty",
        f"""
            {_AMOUNT} as Total_Amount_Invested_USDollars,
            cast(o_orderkey % 1000 as string) || '.5' as Value_of_Interest""",
    ),
    "part_d": f"""
        with drugs as (
            select
                o_custkey as k,
                case when o_custkey % 10 = 0 or l_partkey % 2 = 0 then p_brand else p_name end as brand,
                p_name as generic,
                min(l_orderkey) as first_order,
                count(*) as n,
                sum(cast(l_quantity as bigint)) as quantity,
                sum(cast(floor(l_extendedprice) as bigint) * (1 + l_partkey % 20)) as cost
            from {{lineitem}}
            join {{orders}} on l_orderkey = o_orderkey
            join {{part}} on l_partkey = p_partkey
            where o_custkey % 3 <> 0 and (o_custkey % 8 <> 1 or l_partkey % 16 = 0)
            group by o_custkey, case when o_custkey % 10 = 0 or l_partkey % 2 = 0 then p_brand else p_name end, p_name
        )
        select
            {_npi("k")} as PRSCRBR_NPI,
            case when k % 31 = 0 then {_NULL} else 'Prescriber' || cast(k as string) end as PRSCRBR_LAST_ORG_NAME,
            'Doc' || cast(k % 7 as string) as PRSCRBR_FIRST_NAME,
            'CITY ' || cast(k % 9 as string) as PRSCRBR_CITY,
            'ST' || cast(k % 25 as string) as PRSCRBR_STATE_ABRVTN,
            'TYPE ' || cast(k % 5 as string) as PRSCRBR_TYPE,
            brand as BRND_NAME,
            generic as GNRC_NAME,
            case when first_order % 89 = 0 then '*' else cast(quantity * {_power("k % 4", 3)} as string) end as TOT_CLMS,
            cast(quantity as string) || '.5' as TOT_30DAY_FILLS,
            cast(quantity * 28 as string) || '.4' as TOT_DAY_SUPLY,
            cast(cost as string) || '.25' as TOT_DRUG_CST,
            case when first_order % 7 = 0 then '' else cast(11 * n as string) end as TOT_BENES,
            case when first_order % 5 = 0 then '*' else '' end as GE65_SPRSN_FLAG,
            case when first_order % 5 = 0 then '' else cast(quantity as string) end as GE65_TOT_CLMS,
            case when first_order % 5 = 0 then '' else cast(quantity as string) || '.255' end as GE65_TOT_30DAY_FILLS,
            case when first_order % 5 = 0 then '' else cast(quantity * 30 as string) end as GE65_TOT_DAY_SUPLY,
            case when first_order % 5 = 0 then '' else cast(cost as string) || '.125' end as GE65_TOT_DRUG_CST,
            case when first_order % 3 = 0 then '#' else '' end as GE65_BENE_SPRSN_FLAG,
            case when first_order % 3 = 0 then '' else cast(n as string) end as GE65_TOT_BENES,
            make_date(2024, 1, cast(1 + first_order % 2 as int)) as _LOAD_TIMESTAMP
        from drugs
    """,
    "hospice": _facility(
        0,
        f"""{_SUPPLIER_CCN} as CMS_CERTIFICATION_NUMBER, s_name as FACILITY_NAME,
        case when s_suppkey % 16 <> 0 then cast(s_suppkey as string) || ' pine rd' end as ADDRESS_LINE_1,
        'unit ' || cast(s_suppkey % 5 as string) as ADDRESS_LINE_2, {_place()},
        'COUNTY ' || cast(s_suppkey % 3 as string) as COUNTY_NAME, '555' as PHONE_NUMBER, 'R2' as CMS_REGION,
        {_SUPPLIER_OWNER} as OWNERSHIP_TYPE, {_SUPPLIER_DATE} as CERTIFICATION_DATE""",
    ),
    "home_health": _facility(
        1,
        f"""{_SUPPLIER_CCN} as CMS_CERTIFICATION_NUMBER, s_name as PROVIDER_NAME,
        cast(s_suppkey as string) || ' ash ln' as ADDRESS, {_place()}, '556' as PHONE,
        {_SUPPLIER_OWNER} as TYPE_OF_OWNERSHIP, {_SUPPLIER_DATE} as DATE_CERTIFIED""",
    ),
    "ltch": f"{_measure('M1')} union all {_measure('M2')}",
    "nursing_home": _facility(
        3,
        f"""{_SUPPLIER_CCN} as FEDERAL_PROVIDER_NUMBER, s_name as PROVIDER_NAME,
        cast(s_suppkey as string) || ' fir ct' as PROVIDER_ADDRESS, {_place("PROVIDER_")},
        'COUNTY ' || cast(s_suppkey % 3 as string) as PROVIDER_COUNTY_NAME, '557' as PROVIDER_PHONE_NUMBER,
        {_SUPPLIER_OWNER} as OWNERSHIP_TYPE, {_SUPPLIER_DATE} as DATE_FIRST_APPROVED,
        cast(s_suppkey % 6 as string) as OVERALL_RATING, cast(s_suppkey % 5 as string) as HEALTH_INSPECTION_RATING,
        case when s_suppkey % 5 = 0 then 'n/a' else '3' end as STAFFING_RATING,
        cast(s_suppkey % 40 as string) as NUMBER_OF_CERTIFIED_BEDS, cast(s_suppkey % 37 as string) as NUMBER_OF_RESIDENTS""",
    ),
    "spending": f"""
        with own as (
            select s_suppkey as s, s_name, n_name, l_returnflag, l_linestatus,
                   cast(floor(cast(sum(cast(floor(l_extendedprice) as bigint)) as double) * 100e0
                        / (count(*) * case when s_suppkey % 3 = 0 then 1 else 2 end)) as bigint) as cents
            from {{lineitem}}
            join {{supplier}} on l_suppkey = s_suppkey
            join {{nation}} on s_nationkey = n_nationkey
            group by s_suppkey, s_name, n_name, l_returnflag, l_linestatus
        ),
        by_state as (
            select n_name as state_name,
                   cast(floor(cast(sum(cents) as double) / count(*)) as bigint) as state_cents
            from own group by n_name
        ),
        overall as (
            select cast(floor(cast(sum(state_total) as double) / sum(state_rows)) as bigint) as nation_cents
            from (select sum(cents) as state_total, count(*) as state_rows from own group by n_name) sums
        )
        select
            lpad(cast(s as string), 6, '0') as FACILITY_ID,
            s_name as FACILITY_NAME,
            cast(s as string) || ' hospital dr' as ADDRESS,
            'CITY ' || cast(s % 9 as string) as CITY,
            n_name as STATE,
            lpad(cast(s % 100000 as string), 5, '0') as ZIP_CODE,
            'COUNTY ' || cast(s % 3 as string) as COUNTY_NAME,
            '558' as PHONE_NUMBER,
            l_returnflag as CLAIM_TYPE,
            l_linestatus as PERIOD,
            {_cents("cents")} as AVG_SPENDING_PER_EPISODE_HOSPITAL,
            case when s % 21 = 0 then 'Not Available' else {_cents("state_cents")} end as AVG_SPENDING_PER_EPISODE_STATE,
            {_cents("(select nation_cents from overall)")} as AVG_SPENDING_PER_EPISODE_NATION,
            cast(s % 100 as string) || '.12345' as PERCENT_OF_SPENDING_HOSPITAL,
            cast(s % 10 as string) || '.5' as PERCENT_OF_SPENDING_STATE,
            case when s % 4 = 0 then '' else '7.25' end as PERCENT_OF_SPENDING_NATION,
            '2023-01-01' as START_DATE,
            case when s % 5 = 0 then 'pending' else '2023-12-31' end as END_DATE,
            make_date(2024, 1, 1) as _LOAD_TIMESTAMP
        from own join by_state on n_name = state_name
    """,
}


def generated_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in TABLES}


def fixture(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One derived input as a lazy DataFrame."""
    text = SOURCES[name]
    used = set(re.findall(r"\{(\w+)\}", text))
    tables = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in used}
    df = spark.sql(text, **tables)
    if "_LOAD_TIMESTAMP" in df.columns:
        df = df.withColumn("_LOAD_TIMESTAMP", F.col("_LOAD_TIMESTAMP").cast("timestamp_ntz"))
    if name == "leie":
        df = df.withColumn("_LOAD_TIMESTAMP", F.lit(None).cast("timestamp_ntz"))
    return df


def fixture_sources(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    return {name: (lambda name=name: fixture(spark, folder, name)) for name in SOURCES}


def fixture_sql(name: str) -> str:
    """The same projection for DuckDB."""
    return SOURCES[name].format(**{t: t for t in TABLES})
