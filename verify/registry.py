"""All registered queries: how Spark answers them, and the SQL that gives the expected answer.

Model tables are built once per session and input folder, in the shared work folder; a model's own query
runs its plan over its written inputs, a report reads the written tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.operators import aggregates, bitmaps, filters, joins, ordering, ranking, scans, windows
from provwatch.functions import (
    clean,
    concat_strict,
    describe,
    flag_count,
    pct_change,
    ratio_or_zero,
    round_half_away,
    surrogate_key,
    tier,
    try_count,
    try_date,
    try_money,
    try_number,
)
from provwatch.functions.categories import order_index
from provwatch.plans import quality, serving
from provwatch.plans.facilities import build_facilities, union_facilities
from provwatch.plans.hospital_spending import build_hospital_spending
from provwatch.plans.ml_features import (
    build_drug_concentration,
    build_peer_medians,
    build_peer_stats,
    build_percentiles,
    build_pharma_diversity,
    with_peer_groups,
    with_zscores,
)
from provwatch.plans.payments import PAYMENT_TIERS
from provwatch.plans.lake import MODELS, Lake
from provwatch.plans.prescriptions import build_prescriptions
from provwatch.plans.search import ProviderSearch
from provwatch.plans.summaries import RECIPIENT_TIERS
from provwatch.sources import bronze, layout, readers, sinks
from provwatch.sources.schemas import HEADER_EXCEPTIONS, bronze_columns
from provwatch.streaming.incremental import (
    MergedTable,
    append_new_columns,
    latest_part_d_rows,
    stream_upserts,
    upsert,
)
from verify import oracle as o
from verify.fixtures import SOURCES, fixture, fixture_sources


LANDED = ("part_d", "spending")


class Inputs:
    """Everything a query can read for one input folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    @cached_property
    def lake(self) -> Lake:
        return Lake(self.spark, {name: lambda name=name: self.source(name) for name in SOURCES}, self.scratch("lake"))

    @cached_property
    def _landed(self) -> dict[str, DataFrame]:
        return {}

    @cached_property
    def search(self) -> ProviderSearch:
        return ProviderSearch.build(self.provider_360, self.high_risk_alerts, self.fraud_risk_score, self.scratch("search"))

    def scratch(self, name: str) -> str:
        return sinks.work_folder(self.spark, name)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def source(self, name: str) -> DataFrame:
        """A derived input; those that join the largest tables are landed once, as deliveries would be."""
        if name not in LANDED:
            return fixture(self.spark, self.folder, name)
        if name not in self._landed:
            self._landed[name] = sinks.write_table(fixture(self.spark, self.folder, name), self.scratch(f"landed-{name}"))
        return self._landed[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in MODELS:
            return self.lake[name]
        raise AttributeError(name)


_INPUTS: dict[tuple[str, str], Inputs] = {}


def inputs_for(spark: SparkSession, folder: str) -> Inputs:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _INPUTS:
        _INPUTS[key] = Inputs(spark, folder)
    return _INPUTS[key]


@dataclass(frozen=True)
class Query:
    run: Callable[[Inputs], DataFrame]
    sql: str


QUERIES: dict[str, Query] = {}


def add(name: str, run: Callable[[Inputs], DataFrame], sql: str) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = Query(run, o.compose(sql))


def comparable(df: DataFrame) -> DataFrame:
    """Plain types for the comparison: decimals as doubles, dates and times as text, no load time."""
    columns = []
    for field in df.schema.fields:
        if field.name == "_loaded_at":
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def big(*names: str) -> str:
    """``expr:NAME`` items as bigint columns."""
    return ", ".join("cast({0} as bigint) as {1}".format(*n.split(":")) for n in names)


def usd(*names: str) -> str:
    """``expr:NAME`` items, given in cents or hundredths, as doubles."""
    return ", ".join("cast({0} as double) / 100e0 as {1}".format(*n.split(":")) for n in names)


def txt(*names: str) -> str:
    """Dates as text."""
    return ", ".join("cast({0} as varchar) as {1}".format(*(n.split(":") * 2)[:2]) for n in names)


# --- models -----------------------------------------------------------------------------------------


def _model(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda x: x.lake.plan(name)


EXCLUSIONS = f"""
    EXCLUSION_ID, NPI, UPIN, LAST_NAME, FIRST_NAME, MIDDLE_NAME, BUSINESS_NAME, NPPES_FULL_NAME, NPPES_ORGANIZATION,
    PROVIDER_GENERAL_TYPE, PROVIDER_SPECIALTY, NPPES_ENTITY_TYPE, NPPES_TAXONOMY_CODE, ADDRESS, CITY, STATE, ZIP_CODE,
    NPPES_CITY, NPPES_STATE, NPPES_ZIP, EXCLUSION_TYPE_CODE, EXCLUSION_REASON,
    {txt("EXCLUSION_DATE", "REINSTATEMENT_DATE", "WAIVER_DATE")}, WAIVER_STATE, {txt("DATE_OF_BIRTH")},
    IS_CURRENTLY_EXCLUDED, NPPES_IS_ACTIVE, IS_HIGH_RISK, MATCH_STATUS"""
PROVIDER = f"* replace ({txt('NPI_ENUMERATION_DATE', 'NPI_LAST_UPDATE_DATE')})"
PAYMENTS = f"""
    * exclude (amount_c, invested_c, PAYMENT_DATE), {txt("PAYMENT_DATE")},
    {usd("amount_c:PAYMENT_AMOUNT", "invested_c:INVESTMENT_AMOUNT")}"""
PRESCRIPTIONS = f"""
    PRESCRIPTION_ID, NPI, PRESCRIBER_LAST_NAME, PRESCRIBER_FIRST_NAME, PRESCRIBER_FULL_NAME, CITY, STATE, PRESCRIBER_TYPE,
    BRAND_NAME, GENERIC_NAME, DRUG_TYPE, claims as TOTAL_CLAIMS, {usd("fills_c:TOTAL_30DAY_FILLS")},
    days as TOTAL_DAYS_SUPPLY, {usd("cost_c:TOTAL_DRUG_COST")}, benes as TOTAL_BENEFICIARIES,
    claims65 as TOTAL_CLAIMS_65PLUS, {usd("fills65_c:TOTAL_30DAY_FILLS_65PLUS")}, days65 as TOTAL_DAYS_SUPPLY_65PLUS,
    {usd("cost65_c:TOTAL_DRUG_COST_65PLUS")}, benes65 as TOTAL_BENEFICIARIES_65PLUS,
    {usd("cost_per_claim_c:AVG_COST_PER_CLAIM", "cost_per_bene_c:AVG_COST_PER_BENEFICIARY",
         "claims_per_bene_h:AVG_CLAIMS_PER_BENEFICIARY", "days_per_fill_h:AVG_DAYS_PER_FILL")},
    IS_PRESCRIBER_EXCLUDED, coalesce(claims > 1000, false) as IS_HIGH_VOLUME_PRESCRIBER,
    coalesce(cost_per_claim_c > 50000, false) as IS_HIGH_COST_PRESCRIBER,
    coalesce(claims_per_bene_h > 1000, false) as IS_HIGH_CLAIMS_PER_BENE, RISK_TIER"""
FACILITIES = f"""
    FACILITY_ID, CCN, NAME as FACILITY_NAME, FACILITY_TYPE, ADDRESS_LINE_1, ADDRESS_LINE_2, CITY, STATE, ZIP_CODE, COUNTY,
    FULL_ADDRESS, PHONE, CMS_REGION, OWNERSHIP_TYPE, OWNERSHIP_CATEGORY, {txt("CERTIFICATION_DATE")},
    rating as OVERALL_RATING, inspection as HEALTH_INSPECTION_RATING, staffing as STAFFING_RATING,
    beds as NUMBER_OF_BEDS, residents as NUMBER_OF_RESIDENTS, OCCUPANCY_RATE, IS_LOW_QUALITY"""
SPENDING = f"""
    SPENDING_ID, FACILITY_ID as CCN, FACILITY_NAME as HOSPITAL_NAME, ADDRESS, CITY, STATE, ZIP_CODE, COUNTY_NAME as COUNTY,
    PHONE_NUMBER as PHONE, CLAIM_TYPE, PERIOD,
    {usd("own_c:AVG_SPENDING_HOSPITAL", "state_c:AVG_SPENDING_STATE", "nation_c:AVG_SPENDING_NATION")},
    {", ".join(f"cast(try_cast(PERCENT_OF_SPENDING_{n} as decimal(18,4)) as double) as PCT_SPENDING_{n}"
               for n in ("HOSPITAL", "STATE", "NATION"))},
    {usd("state_h:PCT_VARIANCE_FROM_STATE", "nation_h:PCT_VARIANCE_FROM_NATION")},
    STATE_BENCHMARK_STATUS, NATIONAL_BENCHMARK_STATUS, coalesce(nation_h > 5000, false) as IS_HIGH_SPENDER,
    case when nation_h > 5000 then 'HIGH' when nation_h > 2000 then 'MEDIUM' when nation_h < -2000 then 'LOW'
         else 'NORMAL' end as SPENDING_RISK_TIER,
    cast({o.day("START_DATE", "%Y-%m-%d")} as varchar) as PERIOD_START_DATE,
    cast({o.day("END_DATE", "%Y-%m-%d")} as varchar) as PERIOD_END_DATE"""
PAY_SUM = f"""
    {o.sk("NPI")} as PROVIDER_PAYMENT_KEY, NPI,
    {big("n:TOTAL_PAYMENTS", "n_general:GENERAL_PAYMENTS", "n_research:RESEARCH_PAYMENTS", "n_ownership:OWNERSHIP_PAYMENTS",
         "payers:UNIQUE_PAYERS", "very_high:VERY_HIGH_RISK_PAYMENTS", "high:HIGH_RISK_PAYMENTS",
         "high_risk:TOTAL_HIGH_RISK_PAYMENTS", "years:YEARS_WITH_PAYMENTS")},
    {usd("total_c:TOTAL_PAYMENT_AMOUNT", "general_c:GENERAL_PAYMENT_AMOUNT", "research_c:RESEARCH_PAYMENT_AMOUNT",
         "invested_c:TOTAL_INVESTMENT_AMOUNT", "avg_c:AVG_PAYMENT_AMOUNT", "max_c:MAX_PAYMENT_AMOUNT",
         "high_risk_h:PCT_HIGH_RISK_PAYMENTS")},
    {txt("first_day:FIRST_PAYMENT_DATE", "last_day:LAST_PAYMENT_DATE")},
    listed as IS_EXCLUDED_PROVIDER, RECIPIENT_TIER"""
RX_SUM = f"""
    {o.sk("NPI")} as PROVIDER_PRESCRIPTION_KEY, NPI, PRESCRIBER_NAME, SPECIALTY, STATE,
    {big("n:TOTAL_DRUG_RECORDS", "claims:TOTAL_CLAIMS", "benes:TOTAL_BENEFICIARIES", "drugs:UNIQUE_DRUGS_PRESCRIBED",
         "brand_claims:BRAND_CLAIMS", "critical:CRITICAL_RISK_DRUGS", "very_high:VERY_HIGH_RISK_DRUGS",
         "high:HIGH_RISK_DRUGS", "high_risk:TOTAL_HIGH_RISK_DRUGS")},
    {usd("fills_c:TOTAL_30_DAY_FILLS", "cost_c:TOTAL_COST", "mean_cost_c:AVG_COST_PER_CLAIM", "cost_per_claim_c:COST_PER_CLAIM",
         "brand_cost_c:BRAND_COST", "brand_claims_h:PCT_BRAND_CLAIMS", "brand_cost_h:PCT_BRAND_COST")},
    listed as IS_EXCLUDED_PROVIDER, PRESCRIBER_VOLUME_TIER"""
PROFILE = f"""
    NPI, ENTITY_TYPE, FULL_NAME, ORGANIZATION_NAME, CREDENTIAL, GENDER, CITY, STATE, ZIP_CODE, PHONE,
    SPECIALTY_CLASSIFICATION, SPECIALTY, PROVIDER_TYPE, IS_NPI_ACTIVE, {txt("NPI_ENUMERATION_DATE")}, IS_EXCLUDED,
    EXCLUSION_REASON, {txt("EXCLUSION_DATE")}, IS_CURRENTLY_EXCLUDED, IS_EXCLUDED_HIGH_RISK,
    {big("payments:TOTAL_PAYMENTS", "payers:UNIQUE_PAYERS", "claims:TOTAL_PRESCRIPTION_CLAIMS",
         "drugs:UNIQUE_DRUGS_PRESCRIBED", "risky_drugs:TOTAL_HIGH_RISK_DRUGS")},
    {usd("pay_c:TOTAL_PAYMENT_AMOUNT", "high_risk_h:PCT_HIGH_RISK_PAYMENTS", "rx_c:TOTAL_PRESCRIPTION_COST",
         "brand_h:PCT_BRAND_CLAIMS", "exposure_c:TOTAL_FINANCIAL_EXPOSURE")},
    RECIPIENT_TIER, {txt("first_day:FIRST_PAYMENT_DATE", "last_day:LAST_PAYMENT_DATE")}, PRESCRIBER_VOLUME_TIER,
    HAS_PHARMA_PAYMENTS, HAS_PRESCRIPTIONS"""
SCORE = f"""
    NPI, FULL_NAME, ORGANIZATION_NAME, ENTITY_TYPE, SPECIALTY, STATE, FRAUD_RISK_SCORE, RISK_TIER, IS_EXCLUDED,
    IS_EXCLUDED_HIGH_RISK, IS_HIGH_BRAND_PRESCRIBER, IS_MAJOR_PAYMENT_RECIPIENT,
    {usd("pay_c:TOTAL_PAYMENT_AMOUNT", "rx_c:TOTAL_PRESCRIPTION_COST", "exposure_c:TOTAL_FINANCIAL_EXPOSURE",
         "high_risk_h:PCT_HIGH_RISK_PAYMENTS", "brand_h:PCT_BRAND_CLAIMS")},
    RECIPIENT_TIER, {big("risky_drugs:TOTAL_HIGH_RISK_DRUGS")}, HAS_PHARMA_PAYMENTS, HAS_PRESCRIPTIONS, IS_NPI_ACTIVE"""
ALERT_LIST = f"""
    ALERT_ID, ALERT_TYPE, NPI, PROVIDER_NAME, SPECIALTY, STATE, RISK_SCORE, RISK_TIER, ALERT_DESCRIPTION,
    {usd("exposure_c:FINANCIAL_EXPOSURE")}, PRIORITY_RANK"""
ALERTS = f"{ALERT_LIST}, 'PENDING' as ALERT_STATUS"

add("exclusions", _model("excluded_providers"), f"select {EXCLUSIONS} from m_exclusions")
add("provider_master", _model("provider"), f"select {PROVIDER} from m_provider")
add("payments", _model("payments"), f"select {PAYMENTS} from m_payments")
add("prescriptions", _model("prescriptions"), f"select {PRESCRIPTIONS} from m_prescriptions")
add("facilities", _model("facilities"), f"select {FACILITIES} from m_facilities")
add("hospital_spending", _model("hospital_spending"), f"select {SPENDING} from m_spending")
add("payments_summary", _model("payments_summary"), f"select {PAY_SUM} from m_pay_sum")
add("prescriptions_summary", _model("prescriptions_summary"), f"select {RX_SUM} from m_rx_sum")
add("provider_360", _model("provider_360"), f"select {PROFILE} from m_360")
add("fraud_risk_score", _model("fraud_risk_score"), f"select {SCORE} from m_score")
add(
    "high_risk_alerts",
    lambda x: x.lake.plan("high_risk_alerts").drop("ALERT_DATE"),
    f"select {ALERTS} from m_alerts",
)
add("provider_ml_features", _model("provider_ml_features"), "select * from m_ml")


def _given_times(x: Inputs) -> DataFrame:
    """Run date and load time given by the caller, over all alerts and all spending rows."""
    at = F.lit("2024-05-06 07:08:09").cast("timestamp_ntz")
    inputs = [x.lake[i] for i in MODELS["high_risk_alerts"].inputs]
    alerts = MODELS["high_risk_alerts"].build(*inputs, alert_date=F.lit("2024-02-29").cast("date"), loaded_at=at)
    spending = MODELS["hospital_spending"].build(x.source("spending"), loaded_at=at)
    return alerts.select(F.col("ALERT_ID").alias("ID"), F.col("ALERT_DATE").alias("DAY"), F.col("_loaded_at").alias("LOADED")).unionByName(
        spending.select(F.col("SPENDING_ID").alias("ID"), F.lit(None).cast("date").alias("DAY"), F.col("_loaded_at").alias("LOADED"))
    )


add(
    "given_run_times",
    _given_times,
    f"""select ALERT_ID as ID, '2024-02-29' as DAY, '2024-05-06 07:08:09' as LOADED from (select {ALERTS} from m_alerts)
        union all select SPENDING_ID, null, '2024-05-06 07:08:09' from (select {SPENDING} from m_spending)""",
)

_PEER = [f"PEER_{s}_{n}" for s in ("AVG", "STDDEV") for n in o.MEASURES]
_MEDIANS = ["PEER_MEDIAN_PAYMENT", "PEER_MEDIAN_RX_COST"]


def _peer_stats(x: Inputs) -> DataFrame:
    stats = joins.inner_join(
        build_peer_stats(x.provider_360), build_peer_medians(x.provider_360), ["SPECIALTY_GROUP", "STATE_GROUP"]
    )
    return stats.select(
        "SPECIALTY_GROUP", "STATE_GROUP", "PEER_COUNT",
        *[round_half_away(F.col(c), 4).alias(c) for c in _PEER + _MEDIANS],
    )


add(
    "peer_stats",
    _peer_stats,
    f"""select sg as SPECIALTY_GROUP, stg as STATE_GROUP, PEER_COUNT,
        {", ".join(f"{o.half_away(c, 4)} as {c}" for c in _PEER + _MEDIANS)} from m_peers where PEER_COUNT >= 5""",
)
add(
    "zscores",
    lambda x: with_zscores(with_peer_groups(x.provider_360), build_peer_stats(x.provider_360)).select(
        "NPI", "PEER_COUNT", *[round_half_away(F.col(f"Z_{n}"), 2).alias(f"{n}_ZSCORE") for n in o.MEASURES]
    ),
    f"select NPI, PEER_COUNT, {', '.join(f'{o.half_away(f"z_{n}", 2)} as {n}_ZSCORE' for n in o.MEASURES)} from m_z",
)
add(
    "feature_ratios",
    lambda x: x.provider_ml_features.select(
        "NPI", "PAYMENT_TO_RX_RATIO", "AVG_COST_PER_CLAIM", "PAYMENT_VS_PEER_RATIO"
    ),
    "select NPI, PAYMENT_TO_RX_RATIO, AVG_COST_PER_CLAIM, PAYMENT_VS_PEER_RATIO from m_ml",
)
add(
    "drug_concentration",
    lambda x: build_drug_concentration(x.prescriptions).select(
        "NPI", "UNIQUE_DRUGS", "TOTAL_CLAIMS", round_half_away(F.col("DRUG_HHI"), 4).alias("DRUG_HHI"),
        F.round("TOP_DRUG_PCT", 4).alias("TOP_DRUG_PCT"), F.round("TOP_3_DRUGS_PCT", 4).alias("TOP_3_DRUGS_PCT"),
    ),
    f"""select NPI, UNIQUE_DRUGS, {big("t:TOTAL_CLAIMS")}, {o.half_away("hhi", 4)} as DRUG_HHI,
        {o._share("top1", "t", 4)} as TOP_DRUG_PCT, {o._share("top3", "t", 4)} as TOP_3_DRUGS_PCT from m_concentration""",
)
add(
    "pharma_diversity",
    lambda x: build_pharma_diversity(x.payments).select(
        "NPI", "UNIQUE_PHARMA_COMPANIES", "TOTAL_PAYMENT_RECORDS",
        *[F.round(c, 4).alias(c) for c in ("TOP_PAYER_PCT", "PCT_GENERAL_PAYMENTS", "PCT_RESEARCH_PAYMENTS")],
    ),
    f"""select NPI, companies as UNIQUE_PHARMA_COMPANIES, records as TOTAL_PAYMENT_RECORDS,
        {o._share("biggest", "t", 4)} as TOP_PAYER_PCT, {o._share("general", "t", 4)} as PCT_GENERAL_PAYMENTS,
        {o._share("research", "t", 4)} as PCT_RESEARCH_PAYMENTS from m_diversity""",
)
add(
    "percentiles",
    lambda x: build_percentiles(x.provider_360).select(
        "NPI", *[round_half_away(F.col(f"{n}_PERCENTILE"), 4).alias(f"{n}_PERCENTILE") for n in o.MEASURES]
    ),
    f"select NPI, {', '.join(f'{o.half_away(f"{n}_PERCENTILE", 4)} as {n}_PERCENTILE' for n in o.MEASURES)} from m_percentiles",
)

# --- reports ----------------------------------------------------------------------------------------

# A provider with payments, prescriptions and alerts at every scale.
NPI = "1000000070"


def whole(cents: str, name: str) -> str:
    return f"cast({o.rq(cents, '100')} as double) as {name}"


add(
    "kpis",
    lambda x: serving.kpis(x.provider_360),
    f"""select count(*) as TOTAL_PROVIDERS, count_if(HAS_PHARMA_PAYMENTS)::bigint as PROVIDERS_WITH_PAYMENTS,
        count_if(HAS_PRESCRIPTIONS)::bigint as PROVIDERS_WITH_PRESCRIPTIONS, count_if(IS_EXCLUDED)::bigint as EXCLUDED_PROVIDERS,
        count_if(IS_EXCLUDED and (HAS_PHARMA_PAYMENTS or HAS_PRESCRIPTIONS))::bigint as EXCLUDED_WITH_ACTIVITY,
        {whole("sum(pay_c)", "TOTAL_PHARMA_PAYMENTS")}, {whole("sum(rx_c)", "TOTAL_PRESCRIPTION_COSTS")},
        {o.rq("sum(brand_h)", "count(*) * 10")} / 10e0 as AVG_BRAND_PCT,
        count_if(brand_h >= 8000)::bigint as HIGH_BRAND_PRESCRIBERS from m_360""",
)
o.CTES["m_tiers"] = f"""
    select RISK_TIER, count(*) as COUNT, {o.rq("sum(FRAUD_RISK_SCORE) * 10", "count(*)")} as score_t,
        {o.rq("sum(exposure_c)", "100")} as exposure
    from m_score group by RISK_TIER
"""
o.CTES["m_alert_groups"] = f"""
    select ALERT_TYPE, RISK_TIER, count(*) as NB_ALERTS,
        case when count(exposure_c) > 0 then {o.rq("sum(exposure_c)", "100")} end as exposure
    from m_alerts group by ALERT_TYPE, RISK_TIER
"""
add(
    "risk_distribution",
    lambda x: serving.risk_distribution(x.fraud_risk_score),
    "select RISK_TIER, COUNT, score_t / 10e0 as AVG_SCORE, cast(exposure as double) as TOTAL_EXPOSURE from m_tiers",
)
add(
    "alerts_summary",
    lambda x: serving.alerts_summary(x.high_risk_alerts),
    "select ALERT_TYPE, RISK_TIER, NB_ALERTS, cast(exposure as double) as TOTAL_EXPOSURE from m_alert_groups",
)
add(
    "alerts_by_type",
    lambda x: serving.alerts_by_type(x.high_risk_alerts),
    f"""select ALERT_TYPE, {big("sum(NB_ALERTS):NB_ALERTS")}, cast(coalesce(sum(exposure), 0) as double) as TOTAL_EXPOSURE
        from m_alert_groups group by ALERT_TYPE""",
)
add(
    "exposure_totals",
    lambda x: serving.exposure_totals(x.fraud_risk_score, x.high_risk_alerts),
    """select cast(coalesce(sum(exposure), 0) as double) as TOTAL_EXPOSURE,
        cast(coalesce(sum(exposure) filter (RISK_TIER in ('CRITICAL', 'HIGH')), 0) as double) as CRITICAL_HIGH_EXPOSURE,
        (select cast(coalesce(sum(exposure), 0) as double) from m_alert_groups) as ALERTS_EXPOSURE from m_tiers""",
)
_ALERT_ORDER = "order by PRIORITY_RANK, RISK_SCORE desc, ALERT_ID"
add(
    "alerts_list",
    lambda x: serving.alerts_list(x.high_risk_alerts),
    f"select {ALERT_LIST} from m_alerts {_ALERT_ORDER} limit 100",
)
add(
    "alerts_list_of_type",
    lambda x: serving.alerts_list(x.high_risk_alerts, "PAYMENT_TO_EXCLUDED", 50),
    f"select {ALERT_LIST} from m_alerts where ALERT_TYPE = 'PAYMENT_TO_EXCLUDED' {_ALERT_ORDER} limit 50",
)
add(
    "alerts_filtered",
    lambda x: serving.alerts_filtered(
        x.high_risk_alerts, None, ["ST1", "ST2", "ST10", "NATION_10", "NATION_16"], ["CRITICAL", "HIGH"], 200
    ),
    f"""select {ALERT_LIST} from m_alerts where STATE in ('ST1', 'ST2', 'ST10', 'NATION_10', 'NATION_16')
        and RISK_TIER in ('CRITICAL', 'HIGH') {_ALERT_ORDER} limit 200""",
)
add(
    "provider_details",
    lambda x: serving.provider_details(x.provider_360, NPI),
    f"select {PROFILE} from m_360 where NPI = '{NPI}'",
)
add(
    "provider_alerts",
    lambda x: serving.provider_alerts(x.high_risk_alerts, NPI).drop("ALERT_DATE"),
    f"select {ALERTS} from m_alerts where NPI = '{NPI}'",
)
add(
    "alert_filter_options",
    lambda x: serving.alert_filter_options(x.high_risk_alerts),
    """select 'STATE' as FILTER, STATE as VALUE from m_alerts where STATE is not null
        union select 'RISK_TIER', RISK_TIER from m_alerts where RISK_TIER is not null""",
)
add(
    "alert_batch_metrics",
    lambda x: serving.alert_batch_metrics(x.high_risk_alerts.filter(F.col("RISK_TIER").isNotNull())),
    f"""select count(*) as TOTAL_ALERTS, count_if(RISK_TIER = 'CRITICAL')::bigint as CRITICAL_ALERTS,
        count_if(RISK_TIER = 'HIGH')::bigint as HIGH_ALERTS, {usd("coalesce(sum(exposure_c), 0):TOTAL_EXPOSURE")}
        from m_alerts where RISK_TIER is not null""",
)
add(
    "alerts_by_priority",
    lambda x: serving.alerts_by_priority(x.high_risk_alerts),
    "select PRIORITY_RANK, count(*) as COUNT from m_alerts group by PRIORITY_RANK",
)
add(
    "alerts_by_tier",
    lambda x: serving.alerts_by_tier(x.high_risk_alerts),
    "select RISK_TIER, count(*) as COUNT from m_alerts group by RISK_TIER",
)
_SEARCH = f"NPI, NAME, ENTITY_TYPE, SPECIALTY, STATE, IS_EXCLUDED, {usd('exposure_c:TOTAL_FINANCIAL_EXPOSURE')}"
add(
    "search_providers",
    lambda x: serving.search_providers(x.provider_360, "customer#0000001"),
    f"""select {_SEARCH} from m_360 where NPI like '%CUSTOMER#0000001%' or upper(FULL_NAME) like '%CUSTOMER#0000001%'
        or upper(ORGANIZATION_NAME) like '%CUSTOMER#0000001%' order by exposure_c desc nulls last, NPI limit 50""",
)
add(
    "search_providers_by_npi",
    lambda x: serving.search_providers(x.provider_360, "0012", 100),
    f"select {_SEARCH} from m_360 where NPI like '%0012%' or upper(NAME) like '%0012%' order by exposure_c desc, NPI limit 100",
)
add(
    "compare_search",
    lambda x: serving.compare_search(x.provider_360, "omer#00000010"),
    "select NPI, NAME, SPECIALTY, STATE, CITY from m_360 where upper(NAME) like '%OMER#00000010%' order by NPI limit 20",
)
_ACTIVE_EXCLUDED = "from m_360 where IS_EXCLUDED and (HAS_PHARMA_PAYMENTS or HAS_PRESCRIPTIONS) order by exposure_c desc, NPI"
add(
    "excluded_with_activity",
    lambda x: serving.excluded_with_activity(x.provider_360),
    f"""select NPI, NAME, SPECIALTY, STATE, EXCLUSION_REASON, {txt("EXCLUSION_DATE")},
        {usd("pay_c:TOTAL_PAYMENT_AMOUNT", "rx_c:TOTAL_PRESCRIPTION_COST", "exposure_c:TOTAL_FINANCIAL_EXPOSURE")}
        {_ACTIVE_EXCLUDED} limit 100""",
)
add(
    "high_risk_examples",
    lambda x: serving.high_risk_examples(x.provider_360),
    f"""select NPI, NAME, SPECIALTY, STATE, EXCLUSION_REASON, {usd("exposure_c:TOTAL_FINANCIAL_EXPOSURE")}
        {_ACTIVE_EXCLUDED} limit 10""",
)
add(
    "risk_score",
    lambda x: serving.risk_score(x.fraud_risk_score, NPI),
    f"select FRAUD_RISK_SCORE, RISK_TIER from m_score where NPI = '{NPI}'",
)
add(
    "ml_features",
    lambda x: serving.ml_features(x.provider_ml_features, NPI),
    f"""select * exclude (FULL_NAME, ORGANIZATION_NAME, ENTITY_TYPE, SPECIALTY, STATE, TOTAL_PAYMENT_AMOUNT,
        TOTAL_PRESCRIPTION_COST, TOTAL_PRESCRIPTION_CLAIMS, PCT_BRAND_CLAIMS, IS_EXCLUDED) from m_ml where NPI = '{NPI}'""",
)
add(
    "anomaly_banner",
    lambda x: serving.anomaly_banner(x.provider_ml_features),
    """select NPI, ANOMALY_FLAG_COUNT, IS_MULTI_DIMENSION_OUTLIER,
        case when ANOMALY_FLAG_COUNT >= 3 or IS_MULTI_DIMENSION_OUTLIER then 'RED'
             when ANOMALY_FLAG_COUNT >= 1 then 'ORANGE' else 'GREEN' end as BANNER from m_ml""",
)
add(
    "outlier_labels",
    lambda x: serving.outlier_labels(x.provider_ml_features),
    f"select NPI, {', '.join(f"if({n}_ZSCORE > 2, 'Outlier', null) as {n}_LABEL" for n in o.MEASURES)} from m_ml",
)
add(
    "percentile_bands",
    lambda x: serving.percentile_bands(x.provider_ml_features),
    f"""select NPI, {", ".join(f"if({n}_PERCENTILE >= 90, 'RED', if({n}_PERCENTILE >= 75, 'YELLOW', 'GREEN')) as {n}_BAND"
                               for n in o.MEASURES)} from m_ml""",
)
o.CTES["m_states"] = """
    select STATE, count(*) as n, sum(y.total_c) as c from m_pay_sum y join m_360 p on p.NPI = y.NPI
    where STATE is not null group by STATE
"""
_STATES = """select STATE, n as PROVIDER_COUNT, cast(c as double) / 100e0 as TOTAL_PAYMENTS,
    (cast(c as double) / 100e0) / n as AVG_PAYMENT from m_states"""
add("payments_by_state", lambda x: serving.payments_by_state(x.payments_summary, x.provider_360), _STATES)
add(
    "top_states",
    lambda x: serving.top_states(x.payments_summary, x.provider_360),
    f"{_STATES} order by c desc, STATE limit 15",
)
o.CTES["m_top_recipients"] = """
    select p.NPI, p.NAME, p.SPECIALTY, p.STATE, y.total_c, y.RECIPIENT_TIER, p.IS_EXCLUDED
    from m_pay_sum y join m_360 p on p.NPI = y.NPI
    order by p.IS_EXCLUDED desc, y.total_c desc, p.NPI limit 100
"""
add(
    "top_recipients",
    lambda x: serving.top_recipients(x.payments_summary, x.provider_360),
    f"select * exclude (total_c), {usd('total_c:TOTAL_PAYMENT_AMOUNT')} from m_top_recipients",
)
add(
    "recipient_tiers",
    lambda x: serving.recipient_tiers(x.payments_summary),
    f"select RECIPIENT_TIER, count(*) as COUNT, {usd('sum(total_c):TOTAL')} from m_pay_sum group by RECIPIENT_TIER",
)


def _histogram_sql(rows: str, unit: int, bins: int = 50) -> str:
    """Equal-width bins over integer column ``v`` of ``rows``; ``unit`` is its value of 1."""
    return f"""
        with v as ({rows}), lim as (select min(v) as lo, max(v) as hi from v),
        b as (select lo, hi, case when lo = hi then 1
                else least(((v - lo) * {bins}) // (hi - lo), {bins - 1}) + 1 end as b from v, lim where v is not null)
        select cast(b as integer) as BIN,
            lo / {unit}e0 + (cast(b as integer) - 1) * (cast(hi - lo as double) / {bins * unit}e0) as BIN_START,
            lo / {unit}e0 + cast(b as integer) * (cast(hi - lo as double) / {bins * unit}e0) as BIN_END,
            count(*) as COUNT
        from b group by all"""


add(
    "payment_histogram",
    lambda x: serving.payment_histogram(x.payments_summary, x.provider_360),
    f"""select * from ({_histogram_sql(
        'select cast(total_c as bigint) as v from m_pay_sum where NPI in (select NPI from m_360)', 100)})""",
)
add(
    "score_histogram",
    lambda x: serving.score_histogram(x.fraud_risk_score),
    f"""select * from ({_histogram_sql(
        'select cast(FRAUD_RISK_SCORE * 100 as bigint) as v from m_score where FRAUD_RISK_SCORE > 0', 100)})""",
)
add(
    "volume_tiers",
    lambda x: serving.volume_tiers(x.prescriptions_summary),
    f"""select PRESCRIBER_VOLUME_TIER, count(*) as COUNT, {usd("sum(cost_c):TOTAL_COST")}
        from m_rx_sum group by PRESCRIBER_VOLUME_TIER""",
)
add(
    "brand_buckets",
    lambda x: serving.brand_buckets(x.prescriptions_summary),
    """select if(brand_claims_h >= 8000, 'High Brand (>=80%)', if(brand_claims_h >= 5000, 'Medium Brand (50-80%)',
        'Low Brand (<50%)')) as BRAND_CATEGORY, count(*) as COUNT from m_rx_sum group by all""",
)
add(
    "top_prescribers",
    lambda x: serving.top_prescribers(x.prescriptions_summary),
    f"""select NPI, PRESCRIBER_NAME, SPECIALTY, STATE, {big("claims:TOTAL_CLAIMS")},
        {usd("cost_c:TOTAL_COST", "brand_claims_h:PCT_BRAND_CLAIMS")}, listed as IS_EXCLUDED_PROVIDER
        from m_rx_sum order by cost_c desc nulls first, NPI limit 25""",
)
_TIER_POSITION = "list_position(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'MINIMAL'], RISK_TIER)"
add(
    "risk_funnel",
    lambda x: serving.risk_funnel(x.fraud_risk_score),
    f"""select RISK_TIER, COUNT, score_t / 10e0 as AVG_SCORE, cast(exposure as double) as TOTAL_EXPOSURE,
        {o.rq("COUNT * 10000", f"(select arg_min(COUNT, {_TIER_POSITION}) from m_tiers)")} / 100e0 as PERCENT_OF_FIRST
        from m_tiers""",
)
add(
    "risk_summary",
    lambda x: serving.risk_summary(x.fraud_risk_score),
    f"""select {big("coalesce(sum(COUNT) filter (RISK_TIER = 'CRITICAL'), 0):CRITICAL_COUNT",
                    "coalesce(sum(COUNT) filter (RISK_TIER = 'HIGH'), 0):HIGH_COUNT")},
        cast(sum(exposure) as double) as TOTAL_EXPOSURE,
        {o.rq("sum(score_t)", "count(*)")} / 10e0 as AVG_RISK_SCORE from m_tiers""",
)
_WITH_SCORE = f"select {PROFILE}, FRAUD_RISK_SCORE, RISK_TIER from m_score"
add(
    "provider_with_score",
    lambda x: serving.provider_with_score(x.provider_360, x.fraud_risk_score, NPI),
    f"{_WITH_SCORE} where NPI = '{NPI}'",
)
_BENCH = """(cast(sum(pay_c) as double) / 100e0) / count(*) as AVG_PAYMENTS,
    (cast(sum(rx_c) as double) / 100e0) / count(*) as AVG_RX_COST,
    (cast(sum(brand_h) as double) / 100e0) / count(*) as AVG_BRAND_PCT,
    cast(sum(FRAUD_RISK_SCORE) as double) / count(*) as AVG_RISK_SCORE, count(*) as PEER_COUNT"""
add(
    "peer_benchmark",
    lambda x: serving.peer_benchmark(x.provider_360, x.fraud_risk_score, "MACHINERY", "NATION_16"),
    f"""select {_BENCH.replace("/ count(*) as", "/ nullif(count(*), 0) as")} from m_score
        where SPECIALTY = 'MACHINERY' and STATE = 'NATION_16'""",
)
add(
    "peer_benchmarks",
    lambda x: serving.peer_benchmarks(x.provider_360, x.fraud_risk_score),
    f"""select SPECIALTY, STATE, {_BENCH} from m_score where SPECIALTY is not null and STATE is not null
        group by SPECIALTY, STATE""",
)


def _neighbours(x: Inputs) -> DataFrame:
    """Each provider paired with the holder of the next number."""
    npi = F.col("NPI")
    return x.provider_360.select(npi.alias("npi1"), (npi.cast("bigint") + 1).cast("string").alias("npi2"))


o.CTES["m_pairs"] = """
    select a.NPI as npi1, b.NPI as npi2, a.pay_c as p1, b.pay_c as p2, a.rx_c as r1, b.rx_c as r2,
        a.brand_h as b1, b.brand_h as b2, a.FRAUD_RISK_SCORE as s1, b.FRAUD_RISK_SCORE as s2,
        coalesce(a.NAME, 'Unknown') as n1, coalesce(b.NAME, 'Unknown') as n2, a.IS_EXCLUDED as e1, b.IS_EXCLUDED as e2
    from m_score a join m_score b on cast(b.NPI as bigint) = cast(a.NPI as bigint) + 1
"""
add(
    "compare_pairs",
    lambda x: serving.compare_pairs(_neighbours(x), x.provider_360, x.fraud_risk_score),
    "select npi1, npi2, "
    + ", ".join(
        f"{v}2 > 0 and ({v}1 - {v}2) * 2 > {v}2 as {n}_FLAG_1, {v}2 > 0 and ({v}2 - {v}1) * 2 > {v}2 as {n}_FLAG_2"
        for v, n in (("p", "PAY"), ("r", "RX"), ("b", "BRAND"))
    )
    + " from m_pairs",
)


def _scaled(v: str, side: int) -> str:
    return f"{o.rq(f'{v}{side} * 10000', f'greatest({v}1, {v}2, 100)')} / 100e0"


add(
    "compare_normalised",
    lambda x: serving.compare_normalised(_neighbours(x), x.provider_360, x.fraud_risk_score),
    f"""select npi1, npi2, {_scaled("p", 1)} as PAY_1, {_scaled("p", 2)} as PAY_2, {_scaled("r", 1)} as RX_1,
        {_scaled("r", 2)} as RX_2, {usd("b1:BRAND_1", "b2:BRAND_2")}, s1 as SCORE_1, s2 as SCORE_2 from m_pairs""",
)
add(
    "compare_findings",
    lambda x: serving.compare_findings(_neighbours(x), x.provider_360, x.fraud_risk_score),
    f"""select npi1, npi2,
        case when least(p1, p2) > 0 and greatest(p1, p2) > 3 * least(p1, p2) then if(p1 > p2, n1, n2) end as MORE_PAYMENTS,
        case when least(p1, p2) > 0 and greatest(p1, p2) > 3 * least(p1, p2)
             then {o.rq("greatest(p1, p2) * 10", "least(p1, p2)")} / 10e0 end as PAYMENT_RATIO,
        case when greatest(b1, b2) >= 8000 then if(b1 > b2, n1, n2) end as HIGH_BRAND,
        case when greatest(s1, s2) >= 70 then if(s1 > s2, n1, n2) end as HIGH_RISK,
        if(e1, n1, if(e2, n2, null)) as EXCLUDED from m_pairs""",
)

# --- data quality -----------------------------------------------------------------------------------

# Model tables in terms of the expected results, with the columns the checks look at.
_CHECKED = {
    "provider": f"select {PROVIDER} from m_provider",
    "excluded_providers": "select * from m_exclusions",
    "payments": f"select {PAYMENTS} from m_payments",
    "prescriptions": f"select {PRESCRIPTIONS} from m_prescriptions",
    "facilities": f"select {FACILITIES} from m_facilities",
    "hospital_spending": f"select {SPENDING} from m_spending",
    "provider_360": f"select {PROFILE} from m_360",
    "fraud_risk_score": f"select {SCORE} from m_score",
    "high_risk_alerts": f"select {ALERTS} from m_alerts",
    "payments_summary": f"select {PAY_SUM} from m_pay_sum",
    "prescriptions_summary": f"select {RX_SUM} from m_rx_sum",
    "provider_ml_features": "select * from m_ml",
}
for _name, _sql in _CHECKED.items():
    o.CTES[f"o_{_name}"] = _sql


def _check_sql(table: str, column: str, kind: str, violations: str) -> str:
    return (
        f"select '{table}' as TABLE_NAME, '{column}' as COLUMN_NAME, '{kind}' as CHECK_KIND,"
        f" cast(({violations}) as bigint) as VIOLATIONS"
    )


def _row_checks_sql(kind: str) -> str:
    if kind == "not_null":
        rows = [(t, c, f"{c} is null") for t, cs in quality.NOT_NULL.items() for c in cs.split()]
    elif kind == "accepted":
        rows = [
            (t, c, f"{c} not in ({', '.join(repr(v) for v in vs.split())})") for (t, c), vs in quality.ACCEPTED.items()
        ]
    else:
        rows = [
            (t, c, " or ".join([f"{c} < {lo}"] * (lo is not None) + [f"{c} > {hi}"] * (hi is not None)))
            for (t, c), (lo, hi) in quality.RANGES.items()
        ]
    return " union all ".join(
        _check_sql(t, c, kind, f"select count(*) from o_{t} where {failing}") for t, c, failing in rows
    )


for _kind in ("not_null", "accepted", "range"):
    add(f"dq_{_kind}", lambda x, kind=_kind: quality.count_row_checks(x.lake, [kind]), _row_checks_sql(_kind))
_UNIQUE_SQL = " union all ".join(
    _check_sql(
        t, c, "unique", f"select count(*) from (select {c} from o_{t} where {c} is not null group by {c} having count(*) > 1)"
    )
    for t, c in quality.UNIQUE.items()
)
add("dq_unique", lambda x: quality.count_unique_checks(x.lake), _UNIQUE_SQL)
_RELATIONSHIP_SQL = " union all ".join(
    _check_sql(c, k, "relationship", f"select count(*) from o_{c} where {k} not in (select {k} from o_{p})")
    for c, p, k in quality.RELATIONSHIPS
)
add("dq_relationship", lambda x: quality.count_relationship_checks(x.lake), _RELATIONSHIP_SQL)
_INVARIANTS = {
    "alerts_have_provider": "select count(*) from m_alerts where NPI not in (select NPI from m_360)",
    "critical_is_excluded": "select count(*) from m_score where RISK_TIER = 'CRITICAL' and not IS_EXCLUDED and FRAUD_RISK_SCORE >= 70",
    "exposure_adds_up": "select count(*) from m_360 where exposure_c <> pay_c + rx_c",
    "no_negative_amounts": "select count(*) from m_360 where least(pay_c, rx_c, exposure_c) < 0",
}
add(
    "dq_invariants",
    lambda x: quality.count_invariants(x.lake),
    " union all ".join(f"select '{n}' as INVARIANT, ({q}) as VIOLATIONS" for n, q in _INVARIANTS.items()),
)
add(
    "dq_report",
    lambda x: quality.run_expectations(x.lake),
    " union all ".join(
        [_row_checks_sql(k) for k in ("not_null", "accepted", "range")]
        + [_UNIQUE_SQL, _RELATIONSHIP_SQL]
        + [
            f"select cast(null as varchar), '{n}', 'invariant', cast(({q}) as bigint)" for n, q in _INVARIANTS.items()
        ]
    ),
)

# The same checks over tables with faults: which rows get which follows from the last character of the key.
_FAULT = "(ascii(right({key}, 1)) % 5)"


def _faults(table: str) -> tuple[str, dict[str, str]]:
    """The rows to repeat, and the columns to replace, as SQL that both engines read alike."""
    key = quality.UNIQUE[table]
    fault, cases = _FAULT.format(key=key), {}
    for column in quality.NOT_NULL[table].split():
        if column != key:
            cases.setdefault(column, []).append(f"when {fault} = 2 then null")
    for t, column in quality.ACCEPTED:
        if t == table:
            cases.setdefault(column, []).append(f"when {fault} = 3 then 'NOT A VALUE'")
    for (t, column), (low, high) in quality.RANGES.items():
        if t == table:
            cases.setdefault(column, []).append(f"when {fault} = 4 then {low - 1}")
            if high is not None:
                cases[column].append(f"when {fault} = 0 then {high + 1}")
    if table in {child for child, _, _ in quality.RELATIONSHIPS}:
        cases.setdefault(key, []).append(f"when {fault} = 0 then concat({key}, '?')")
    return f"{fault} = 1", {c: f"case {' '.join(w)} else {c} end" for c, w in cases.items()}


def _faulty(x: Inputs) -> dict[str, DataFrame]:
    tables = {}
    for table in quality.UNIQUE:
        repeated, columns = _faults(table)
        rows = x.lake[table]
        broken = rows.withColumns({c: F.expr(e).cast(rows.schema[c].dataType) for c, e in columns.items()})
        tables[table] = broken.unionByName(rows.filter(repeated))
    return tables


for _name in quality.UNIQUE:
    _repeated, _columns = _faults(_name)
    _replaced = ", ".join(f"{e} as {c}" for c, e in _columns.items())
    o.CTES[f"f_{_name}"] = f"""select {f"* replace ({_replaced})" if _replaced else "*"} from o_{_name}
        union all select * from o_{_name} where {_repeated}"""


def _over_faults(sql: str) -> str:
    return sql.replace("from o_", "from f_")


_FAULTY_INVARIANTS = {
    "alerts_have_provider": """select count(*) from f_high_risk_alerts a
        where not exists (select 1 from f_provider_360 p where p.NPI = a.NPI)""",
    "critical_is_excluded": """select count(*) from f_fraud_risk_score
        where RISK_TIER = 'CRITICAL' and not IS_EXCLUDED and FRAUD_RISK_SCORE >= 70""",
    "exposure_adds_up": """select count(*) from f_provider_360 where round(TOTAL_FINANCIAL_EXPOSURE * 100)
        <> round(TOTAL_PAYMENT_AMOUNT * 100) + round(TOTAL_PRESCRIPTION_COST * 100)""",
    "no_negative_amounts": """select count(*) from f_provider_360
        where least(TOTAL_PAYMENT_AMOUNT, TOTAL_PRESCRIPTION_COST, TOTAL_FINANCIAL_EXPOSURE) < 0""",
}
add(
    "dq_faulty_report",
    lambda x: quality.run_expectations(_faulty(x)),
    " union all ".join(
        [_over_faults(_row_checks_sql(k)) for k in ("not_null", "accepted", "range")]
        + [_over_faults(_UNIQUE_SQL), _over_faults(_RELATIONSHIP_SQL)]
        + [
            f"select cast(null as varchar), '{n}', 'invariant', cast(({q}) as bigint)"
            for n, q in _FAULTY_INVARIANTS.items()
        ]
    ),
)

# --- sources and sinks ------------------------------------------------------------------------------


def _csv_folder(x: Inputs, df: DataFrame, name: str) -> str:
    path = x.scratch(name)
    sinks.export_csv(df, path)
    return path


add(
    "csv_inferred_scan",
    lambda x: readers.read_csv_inferred(
        x.spark, _csv_folder(x, x.raw("supplier").withColumn("code", F.lpad("s_suppkey", 8, "0")), "csv")
    ),
    """select cast(s_suppkey as integer) as s_suppkey, s_name, s_nationkey, s_acctbal, cast(s_suppkey as integer) as code
        from supplier""",
)
_AS_TEXT = "coalesce(cast(columns(*) as varchar), '')"  # every column, missing fields as empty text
add(
    "csv_string_scan",
    lambda x: readers.read_csv_strings(x.spark, _csv_folder(x, x.source("open_payments_ownership"), "csv")),
    f"select {_AS_TEXT} from src_open_payments_ownership",
)
add(
    "csv_roundtrip",
    lambda x: sinks.csv_to_parquet(
        x.spark, _csv_folder(x, x.source("open_payments_general"), "csv"), x.scratch("parquet"), max_records_per_file=50_000
    ),
    f"select {_AS_TEXT} from src_open_payments_general",
)


def _raw_headers(df: DataFrame, table: str) -> DataFrame:
    """Fixture columns under the headers of the public files, as far as the fixture has them."""
    exceptions = {landed: raw for raw, landed in HEADER_EXCEPTIONS.items()}
    if table == "LONGTERM_CARE_HOSPITAL":
        exceptions = {}
    return df.select(
        *[
            F.col(c).alias(exceptions.get(c, c.replace("_", " ").title()))
            for c in bronze_columns(table)
            if c in df.columns
        ]
    )


def _bronze(x: Inputs, source: str, table: str) -> DataFrame:
    folder = x.scratch("landing")
    sinks.write_versioned(_raw_headers(x.source(source), table), folder, source, "20240101_000000")
    loaded = bronze.load_bronze(x.spark, folder, table)
    return loaded.withColumns(
        {
            "_SOURCE_FILE": F.col("_SOURCE_FILE").contains("_LATEST"),
            "_LOAD_TIMESTAMP": F.col("_LOAD_TIMESTAMP").isNotNull(),
        }
    )


def _bronze_sql(source: str, table: str, present: set[str]) -> str:
    columns = ", ".join(
        f"cast({c if c in present else 'null'} as varchar) as {c}" for c in bronze_columns(table)
    )
    return f"select {columns}, true as _SOURCE_FILE, true as _LOAD_TIMESTAMP from src_{source}"


_LANDED = {
    "hospice": ("HOSPICE", set(bronze_columns("HOSPICE"))),
    "home_health": (
        "HOME_HEALTH_CARE",
        {c for c in bronze_columns("HOME_HEALTH_CARE") if not c.startswith("OFFERS_")},
    ),
    "ltch": (
        "LONGTERM_CARE_HOSPITAL",
        set(bronze_columns("LONGTERM_CARE_HOSPITAL")) - {"SCORE", "FOOTNOTE", "START_DATE", "END_DATE"},
    ),
    "spending": ("MEDICARE_HOSPITAL_SPENDING", set(bronze_columns("MEDICARE_HOSPITAL_SPENDING"))),
    "leie": ("LEIE", set(bronze_columns("LEIE"))),
    "part_d": (
        "MEDICARE_PART_D_PRESCRIBERS",
        set(bronze_columns("MEDICARE_PART_D_PRESCRIBERS")) - {"PRSCRBR_STATE_FIPS", "PRSCRBR_TYPE_SRC"},
    ),
    "nursing_home": (
        "PROVIDER_INFORMATION",
        set(
            "FEDERAL_PROVIDER_NUMBER PROVIDER_NAME PROVIDER_ADDRESS PROVIDER_CITY PROVIDER_STATE PROVIDER_ZIP_CODE"
            " PROVIDER_COUNTY_NAME PROVIDER_PHONE_NUMBER OWNERSHIP_TYPE DATE_FIRST_APPROVED OVERALL_RATING"
            " HEALTH_INSPECTION_RATING STAFFING_RATING NUMBER_OF_CERTIFIED_BEDS NUMBER_OF_RESIDENTS".split()
        ),
    ),
}
for _source, (_table, _present) in _LANDED.items():
    add(
        f"bronze_latest_load_{_source}",
        lambda x, s=_source, t=_table: _bronze(x, s, t),
        _bronze_sql(_source, _table, _present),
    )


def _aligned(x: Inputs) -> DataFrame:
    """Research payments, under upper-case names, loaded into the schema inferred from general ones."""
    general, research = x.scratch("general"), x.scratch("research")
    sinks.write_table(x.source("open_payments_general"), general)
    source = x.source("open_payments_research")
    landed = sinks.write_table(source.toDF(*[c.upper() for c in source.columns]), research)
    return bronze.align_by_name(landed, readers.infer_bronze(x.spark, general))


# Every column of general payments, by name, and no other.
add(
    "aligned_by_name",
    _aligned,
    """select * exclude (ClinicalTrials_Gov_Identifier, Name_of_Study) from (
        select * from src_open_payments_general where false union all by name select * from src_open_payments_research)""",
)


def _refreshed(x: Inputs) -> DataFrame:
    path = x.scratch("refresh")
    sinks.write_table(x.source("ltch"), path)
    return sinks.write_table(x.source("home_health"), path)


add(
    "full_refresh",
    _refreshed,
    "select * replace (cast(cast(_LOAD_TIMESTAMP as timestamp) as varchar) as _LOAD_TIMESTAMP) from src_home_health",
)
add(
    "staged_providers",
    lambda x: x.lake.source("nppes_provider").select("NPI", "ENTITY_TYPE_CODE", "IS_ACTIVE"),
    "select NPI, ENTITY_TYPE_CODE, IS_ACTIVE from src_nppes_provider where IS_ACTIVE",
)
add(
    "staged_taxonomy_codes",
    lambda x: bronze.stage(x.source("taxonomy_code"), active_only=True),
    "select * from src_taxonomy_code where IS_ACTIVE",
)
add(
    "clustered_payments",
    lambda x: sinks.write_clustered(
        x.payments, x.scratch("clustered"), ["STATE", "NPI", "PAYMENT_CATEGORY"], spread=["PAYMENT_ID"]
    ),
    f"select {PAYMENTS} from m_payments",
)


def _layout(x: Inputs) -> DataFrame:
    """Searches of the clustered payments by each of its three columns: the value, and whether most row groups are skipped.

    A third of all payments have the rarest category, so no layout skips more than two thirds for it.
    """
    table = sinks.write_clustered(
        x.payments, x.scratch("layout"), ["STATE", "NPI", "PAYMENT_CATEGORY"], partitions=64, spread=["PAYMENT_ID"]
    )
    known = table.filter("STATE is not null and NPI is not null and PAYMENT_CATEGORY is not null")
    rare = known.groupBy("PAYMENT_CATEGORY").agg(F.count("*").alias("n")).agg(F.min_by("PAYMENT_CATEGORY", F.struct("n", "PAYMENT_CATEGORY")))
    limits = known.agg(F.min("STATE"), F.max("NPI")).first()
    wanted = dict(zip(("STATE", "NPI", "PAYMENT_CATEGORY"), (*limits, rare.first()[0]), strict=True))
    groups = layout.groups_read(table, wanted)
    value = F.create_map(*[F.lit(v) for pair in wanted.items() for v in pair])[F.col("COLUMN")]
    return groups.select(F.col("COLUMN").alias("SEARCHED"), value.alias("VALUE"), (F.col("READ") * 5 < F.col("GROUPS") * 2).alias("SKIPS_MOST"))


_KNOWN_PAYMENTS = "m_payments where STATE is not null and NPI is not null and PAYMENT_CATEGORY is not null"
add(
    "clustered_layout",
    _layout,
    f"""select 'STATE' as SEARCHED, min(STATE) as VALUE, true as SKIPS_MOST from {_KNOWN_PAYMENTS}
        union all select 'NPI', max(NPI), true from {_KNOWN_PAYMENTS}
        union all (select 'PAYMENT_CATEGORY', PAYMENT_CATEGORY, true from {_KNOWN_PAYMENTS}
            group by PAYMENT_CATEGORY order by count(*), PAYMENT_CATEGORY limit 1)""",
)
def _exported(x: Inputs) -> DataFrame:
    """Alerts written as CSV, read as text, and brought back to their types by name."""
    alerts = x.high_risk_alerts.drop("ALERT_DATE", "_loaded_at")
    text = readers.read_csv_strings(x.spark, _csv_folder(x, alerts, "csv"), missing=None)
    return bronze.align_by_name(text, alerts.schema)


add("exported_alerts", _exported, f"select {ALERTS} from m_alerts")
_COUNTED = tuple(sorted({i for m in MODELS.values() for i in m.inputs} - set(MODELS)))
add(
    "load_metrics",
    lambda x: filters.union_all(
        [
            bronze.load_metrics(x.source(s), required=s).withColumn("SOURCE", F.lit(s))
            for s in _COUNTED
        ]
    ),
    " union all ".join(
        f"select '{s}' as SOURCE, count(*) as ROW_COUNT, cast(len(any_value(json_keys(to_json(t)))) + {int(s == 'leie')} as integer)"
        f" as COLUMN_COUNT from src_{s} t"  # exclusions get an empty load time in Spark
        for s in _COUNTED
    ),
)

# --- operators --------------------------------------------------------------------------------------

add(
    "facility_union",
    lambda x: union_facilities(*[x.source(s) for s in ("hospice", "home_health", "ltch", "nursing_home")]),
    f"""select FACILITY_TYPE, CCN, NAME, ADDRESS_LINE_1, ADDRESS_LINE_2, CITY, STATE, ZIP_CODE, COUNTY, PHONE, CMS_REGION,
        OWNERSHIP_TYPE, cast({o.day("opened", "%Y-%m-%d")} as varchar) as CERTIFICATION_DATE, rating as OVERALL_RATING,
        inspection as HEALTH_INSPECTION_RATING, staffing as STAFFING_RATING, beds as NUMBER_OF_BEDS,
        residents as NUMBER_OF_RESIDENTS, cast(cast(loaded as timestamp) as varchar) as _LOAD_TIMESTAMP
        from m_facility_rows where CCN is not null""",
)
add(
    "renamed_orders",
    lambda x: filters.with_constant(
        filters.select_renamed(x.raw("orders"), {"ORDER_ID": "o_orderkey", "STATUS": "o_orderstatus"}), "KIND", "ORDER"
    ),
    "select o_orderkey as ORDER_ID, o_orderstatus as STATUS, 'ORDER' as KIND from orders",
)
add(
    "present_recipients",
    lambda x: filters.filter_present(x.source("open_payments_general"), "Covered_Recipient_NPI").select(
        "Record_ID", "Covered_Recipient_NPI"
    ),
    "select Record_ID, Covered_Recipient_NPI from src_open_payments_general where Covered_Recipient_NPI <> ''",
)
add(
    "primary_addresses",
    lambda x: filters.filter_true(x.source("nppes_address"), "IS_PRIMARY").select("NPI", "ADDRESS_LINE_1"),
    "select NPI, ADDRESS_LINE_1 from src_nppes_address where IS_PRIMARY",
)
add(
    "alerts_in_tiers",
    lambda x: filters.filter_in(x.high_risk_alerts, "RISK_TIER", ["HIGH", "MEDIUM"]).select("ALERT_ID", "RISK_TIER"),
    "select ALERT_ID, RISK_TIER from m_alerts where RISK_TIER in ('HIGH', 'MEDIUM')",
)
add(
    "like_owners",
    lambda x: filters.filter_like(x.facilities, ["OWNERSHIP_TYPE", "FACILITY_NAME"], "%PROFIT%", ignore_case=True).select(
        "CCN", "OWNERSHIP_TYPE"
    ),
    "select CCN, OWNERSHIP_TYPE from m_facilities where OWNERSHIP_TYPE ilike '%profit%' or NAME ilike '%profit%'",
)
add(
    "optional_filters",
    lambda x: filters.apply_filters(
        x.raw("orders"), o_orderstatus=None, o_orderpriority=["1-URGENT", "2-HIGH"], o_custkey=[]
    ).select("o_orderkey", "o_orderpriority"),
    "select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH')",
)
add(
    "payment_tiers",
    lambda x: aggregates.group_by_bucket(
        x.raw("lineitem"),
        "TIER",
        tier(F.col("l_extendedprice"), [(50000, "VERY_HIGH"), *PAYMENT_TIERS[1:]], "MINIMAL"),
        [F.count("*").alias("COUNT")],
    ),
    f"""select {o.tiers("l_extendedprice", [(50000, "VERY_HIGH"), (10000, "HIGH"), (1000, "MEDIUM"), (100, "LOW")], "MINIMAL")}
        as TIER, count(*) as COUNT from lineitem group by 1""",
)
add(
    "exclusion_reasons",
    lambda x: x.excluded_providers.groupBy("EXCLUSION_TYPE_CODE", "EXCLUSION_REASON").agg(F.count("*").alias("COUNT")),
    "select EXCLUSION_TYPE_CODE, EXCLUSION_REASON, count(*) as COUNT from m_exclusions group by all",
)
add(
    "customers_with_many_orders",
    lambda x: filters.having(
        x.raw("orders").groupBy("o_custkey").agg(F.count("*").alias("ORDERS")), F.col("ORDERS") >= 5
    ),
    "select o_custkey, count(*) as ORDERS from orders group by o_custkey having count(*) >= 5",
)
add(
    "left_join_taxonomy",
    lambda x: joins.left_join(
        x.source("nppes_address").select("NPI", "CITY_NAME"),
        x.lake.source("nppes_provider").select("NPI", "ENTITY_TYPE_CODE"),
        "NPI",
    ),
    """select a.NPI, CITY_NAME, ENTITY_TYPE_CODE from src_nppes_address a
        left join src_nppes_provider_active p on p.NPI = a.NPI""",
)
add(
    "payments_to_known_providers",
    lambda x: joins.semi_join(x.payments, x.provider, "NPI").select("PAYMENT_ID", "NPI"),
    "select PAYMENT_ID, NPI from m_payments where NPI in (select NPI from m_provider)",
)
add(
    "payments_to_unknown_providers",
    lambda x: joins.anti_join(x.payments, x.provider, "NPI").select("PAYMENT_ID", "NPI"),
    "select PAYMENT_ID, NPI from m_payments where NPI not in (select NPI from m_provider)",
)
add(
    "orders_of_excluded",
    lambda x: joins.flag_member(
        x.raw("orders").select("o_orderkey", (F.lit(1000000000) + F.col("o_custkey")).cast("string").alias("NPI")),
        x.source("leie"), "NPI", "IS_LISTED", spread=["o_orderkey"],
    ),
    """select o_orderkey, cast(1000000000 + o_custkey as varchar) as NPI,
        cast(1000000000 + o_custkey as varchar) in (select NPI from m_listed) as IS_LISTED from orders""",
)
add(
    "star_join_totals",
    lambda x: joins.star_join(
        x.provider.select("NPI"),
        [x.payments_summary.select("NPI", "TOTAL_PAYMENTS"), x.prescriptions_summary.select("NPI", "TOTAL_CLAIMS")],
        "NPI",
    ),
    f"""select p.NPI, y.n as TOTAL_PAYMENTS, {big("x.claims:TOTAL_CLAIMS")} from m_provider p
        left join m_pay_sum y on y.NPI = p.NPI left join m_rx_sum x on x.NPI = p.NPI""",
)
add(
    "lineitem_aggregates",
    lambda x: x.raw("lineitem")
    .withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))
    .groupBy("l_returnflag", "l_linestatus")
    .agg(
        F.count("*").alias("N"),
        aggregates.count_where(F.col("l_quantity") > 25).alias("LARGE"),
        F.count_distinct("l_suppkey").alias("SUPPLIERS"),
        F.sum("price").alias("TOTAL"),
        aggregates.sum_where(F.col("price"), F.col("l_quantity") > 99).alias("NONE_TOTAL"),
        aggregates.sum_where(F.col("price"), F.col("l_quantity") > 25, 0).alias("LARGE_TOTAL"),
        aggregates.mean(F.col("price")).alias("MEAN"),
        F.min("price").alias("LOWEST"),
        F.max("price").alias("HIGHEST"),
        aggregates.any_true(F.col("l_discount") > 0.05).alias("DISCOUNTED"),
        round_half_away(F.stddev_samp("l_extendedprice"), 4).alias("DEVIATION"),
    ),
    f"""select l_returnflag, l_linestatus, count(*) as N, count_if(l_quantity > 25)::bigint as LARGE,
        count(distinct l_suppkey) as SUPPLIERS, cast(sum(p) as double) as TOTAL,
        cast(sum(p) filter (l_quantity > 99) as double) as NONE_TOTAL,
        cast(coalesce(sum(p) filter (l_quantity > 25), 0) as double) as LARGE_TOTAL,
        cast(sum(p) as double) / count(*) as MEAN, cast(min(p) as double) as LOWEST, cast(max(p) as double) as HIGHEST,
        bool_or(l_discount > 0.05) as DISCOUNTED, {o.half_away("stddev_samp(l_extendedprice)", 4)} as DEVIATION
        from (select *, cast(l_extendedprice as decimal(18,2)) as p from lineitem) group by all""",
)
add(
    "median_price_by_flag",
    lambda x: ranking.exact_medians(
        x.raw("lineitem"), ["l_returnflag", "l_linestatus"], {"MEDIAN_PRICE": "l_extendedprice", "MEDIAN_QTY": "l_quantity"}
    ),
    """select l_returnflag, l_linestatus, (p[(n + 1) // 2] + p[(n + 2) // 2]) / 2e0 as MEDIAN_PRICE,
        (q[(n + 1) // 2] + q[(n + 2) // 2]) / 2e0 as MEDIAN_QTY from (
            select l_returnflag, l_linestatus, count(*) as n, list_sort(list(l_extendedprice::double)) as p,
                list_sort(list(l_quantity::double)) as q from lineitem group by all)""",
)
add(
    "distinct_claim_types",
    lambda x: aggregates.distinct(x.raw("lineitem"), ["l_returnflag", "l_linestatus"]),
    "select distinct l_returnflag, l_linestatus from lineitem",
)
add(
    "two_stage_quantities",
    lambda x: aggregates.two_stage(
        x.raw("lineitem"),
        ["l_suppkey", "l_partkey"],
        [F.sum(F.col("l_quantity").cast("bigint")).alias("q")],
        ["l_suppkey"],
        [F.count("*").alias("PARTS"), F.max("q").alias("LARGEST"), F.sum("q").alias("TOTAL")],
    ),
    f"""select l_suppkey, count(*) as PARTS, {big("max(q):LARGEST", "sum(q):TOTAL")} from (
        select l_suppkey, l_partkey, sum(l_quantity::bigint) as q from lineitem group by all) group by l_suppkey""",
)
add(
    "supplier_hhi",
    lambda x: aggregates.hhi(x.raw("lineitem"), "l_suppkey", "l_partkey", "l_quantity").select(
        "l_suppkey", round_half_away(F.col("HHI"), 4).alias("HHI")
    ),
    f"""select l_suppkey, {o.half_away("(sum(q * q)::double * 1e4 / (sum(q)::double * sum(q)::double))", 4)} as HHI from (
        select l_suppkey, l_partkey, sum(l_quantity::bigint) as q from lineitem group by all) group by l_suppkey""",
)
add(
    "price_histogram",
    lambda x: aggregates.histogram(x.raw("orders"), "o_totalprice", 50),
    """with lim as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders),
        b as (select lo, hi, cast(least(floor((o_totalprice - lo) * 50 / (hi - lo)), 49) + 1 as integer) as b from orders, lim)
        select b as BIN, lo + (b - 1) * ((hi - lo) / 50e0) as BIN_START, lo + b * ((hi - lo) / 50e0) as BIN_END,
            count(*) as COUNT from b group by all""",
)
add(
    "summary_rollup",
    lambda x: aggregates.rollup_summary(
        x.raw("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("N")),
        ["o_orderstatus"],
        {"N": F.sum("N"), "GROUPS": F.count("*")},
    ),
    """select o_orderstatus, count(*) as N, count(distinct o_orderpriority) as GROUPS from orders group by o_orderstatus""",
)
add(
    "latest_order_per_customer",
    lambda x: windows.keep_latest(
        x.raw("orders"), ["o_custkey"], F.col("o_orderdate").desc_nulls_last(), ["o_orderkey"]
    ).select("o_custkey", "o_orderkey"),
    """select o_custkey, o_orderkey from orders
        qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1""",
)
add(
    "first_by_priority",
    lambda x: windows.keep_by_priority(
        x.raw("orders"),
        ["o_custkey"],
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(3),
        [F.col("o_orderkey").asc()],
    ).select("o_custkey", "o_orderkey", "o_orderpriority"),
    """select o_custkey, o_orderkey, o_orderpriority from orders qualify row_number() over (partition by o_custkey
        order by case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 3 end, o_orderkey) = 1""",
)
o.CTES["m_supplier_parts"] = (
    "select l_suppkey, l_partkey, cast(sum(l_quantity::bigint) as bigint) as q from lineitem group by all"
)


def _supplier_parts(x: Inputs) -> DataFrame:
    return x.raw("lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))


add(
    "top_parts_per_supplier",
    lambda x: windows.rank_in_group(
        _supplier_parts(x), ["l_suppkey"], [F.col("q").desc_nulls_first(), F.col("l_partkey").asc()], 5, "RN"
    ),
    """select *, cast(row_number() over (partition by l_suppkey order by q desc nulls first, l_partkey) as integer) as RN
        from m_supplier_parts qualify RN <= 5""",
)
add(
    "supplier_part_totals",
    lambda x: windows.partition_total(_supplier_parts(x), ["l_suppkey"], "q", "TOTAL", ["l_partkey"]),
    f"select l_suppkey, l_partkey, q, {big('sum(q) over (partition by l_suppkey):TOTAL')} from m_supplier_parts",
)
add(
    "top_part_sums",
    lambda x: windows.top_sums(_supplier_parts(x), ["l_suppkey"], "q", ["l_partkey"], [1, 3]),
    f"""select l_suppkey, {big("max(q):TOP_1", "sum(q):TOP_3")} from (from m_supplier_parts
        qualify row_number() over (partition by l_suppkey order by q desc, l_partkey) <= 3) group by l_suppkey""",
)
add(
    "top_k_share",
    lambda x: windows.top_k_share(x.raw("lineitem"), "l_suppkey", "l_partkey", "l_quantity", [1, 3]).select(
        "l_suppkey", F.round("TOP_1_PCT", 4).alias("TOP_1_PCT"), F.round("TOP_3_PCT", 4).alias("TOP_3_PCT")
    ),
    f"""select l_suppkey, {o._share("a", "t", 4)} as TOP_1_PCT, {o._share("b", "t", 4)} as TOP_3_PCT from (
        select l_suppkey, sum(q) as t, max(q) as a, sum(q) filter (rn <= 3) as b from (
            select *, row_number() over (partition by l_suppkey order by q desc, l_partkey) as rn from m_supplier_parts)
        group by l_suppkey)""",
)
add(
    "order_price_percentiles",
    lambda x: ranking.percentile_ranks(
        x.raw("orders").withColumn("price", F.col("o_totalprice")),
        "o_orderkey",
        ["o_orderstatus", "o_orderpriority"],
        {"PRICE_PERCENTILE": "price", "CUSTOMER_PERCENTILE": "o_custkey"},
    ),
    """select o_orderkey,
        percent_rank() over (partition by o_orderstatus, o_orderpriority order by o_totalprice) * 100e0 as PRICE_PERCENTILE,
        percent_rank() over (partition by o_orderstatus, o_orderpriority order by o_custkey) * 100e0 as CUSTOMER_PERCENTILE
        from orders""",
)
add(
    "top_orders",
    lambda x: ordering.top_k(
        x.raw("orders").select("o_orderkey", "o_orderpriority", "o_totalprice"),
        [("o_orderpriority",), ("o_totalprice", "desc", "last"), ("o_orderkey",)],
        100,
    ),
    """select o_orderkey, o_orderpriority, o_totalprice from orders
        order by o_orderpriority, o_totalprice desc nulls last, o_orderkey limit 100""",
)


def _positions(x: Inputs, df: DataFrame, order: list) -> DataFrame:
    """With each row's place in the order, from 1."""
    return scans.numbered(df, order, x.scratch("numbered"), "POSITION").withColumn("POSITION", F.col("POSITION") + 1)


add(
    "alerts_in_order",
    lambda x: _positions(
        x,
        x.high_risk_alerts.select("ALERT_ID", "PRIORITY_RANK", "RISK_SCORE"),
        [F.col("PRIORITY_RANK"), F.col("RISK_SCORE").desc_nulls_first(), F.col("ALERT_ID")],
    ),
    f"""select ALERT_ID, PRIORITY_RANK, RISK_SCORE,
        row_number() over (order by PRIORITY_RANK, RISK_SCORE desc nulls first, ALERT_ID) as POSITION
        from (select {ALERTS} from m_alerts)""",
)
add(
    "running_exposure",
    lambda x: scans.running(
        _positions(
            x,
            x.provider_360.select("STATE", "NPI", F.col("TOTAL_FINANCIAL_EXPOSURE").alias("EXPOSURE")),
            [F.col("STATE").asc_nulls_first(), F.col("NPI")],
        ),
        "POSITION",
        {"RUNNING_EXPOSURE": ("sum", F.col("EXPOSURE").cast("decimal(38,2)"))},
        size=256,
    ),
    """select STATE, NPI, exposure_c / 100e0 as EXPOSURE, row_number() over w as POSITION,
        cast(sum(exposure_c) over w as double) / 100e0 as RUNNING_EXPOSURE
        from m_360 window w as (order by STATE nulls first, NPI rows between unbounded preceding and current row)""",
)
_RECIPIENT_TIERS = [name for _, name in RECIPIENT_TIERS] + ["MINOR_RECIPIENT"]
add(
    "tiers_in_order",
    lambda x: _positions(
        x,
        ordering.order_by_category(
            x.provider_360.groupBy("RECIPIENT_TIER").agg(F.count("*").alias("COUNT")), "RECIPIENT_TIER", _RECIPIENT_TIERS
        ),
        [order_index(F.col("RECIPIENT_TIER"), _RECIPIENT_TIERS)],
    ),
    f"""select RECIPIENT_TIER, count(*) as COUNT,
        row_number() over (order by list_position({_RECIPIENT_TIERS}, RECIPIENT_TIER)) as POSITION from m_360
        where RECIPIENT_TIER in (select unnest({_RECIPIENT_TIERS})) group by RECIPIENT_TIER""",
)

# --- scalar functions -------------------------------------------------------------------------------

add(
    "try_number",
    lambda x: x.source("part_d").select(
        "PRSCRBR_NPI", "BRND_NAME", "GNRC_NAME",
        try_count(F.col("TOT_DAY_SUPLY")).alias("DAYS"),
        try_count(F.col("TOT_CLMS")).alias("CLAIMS"),
        try_money(F.col("GE65_TOT_30DAY_FILLS")).alias("FILLS"),
        try_number(F.col("GE65_TOT_DRUG_CST"), 18, 4).alias("COST4"),
    ),
    f"""select PRSCRBR_NPI, BRND_NAME, GNRC_NAME, {o.count("TOT_DAY_SUPLY")} as DAYS, {o.count("TOT_CLMS")} as CLAIMS,
        cast(try_cast(GE65_TOT_30DAY_FILLS as decimal(18,2)) as double) as FILLS,
        cast(try_cast(GE65_TOT_DRUG_CST as decimal(18,4)) as double) as COST4 from src_part_d""",
)
add(
    "try_date",
    lambda x: x.source("leie").select(
        "UPIN", "EXCLDATE", try_date(F.col("EXCLDATE"), "yyyyMMdd").alias("EXCLUDED"), try_date(F.col("DOB"), "yyyyMMdd").alias("BORN")
    ),
    f"""select UPIN, EXCLDATE, cast({o.day("EXCLDATE", "%Y%m%d")} as varchar) as EXCLUDED,
        cast({o.day("DOB", "%Y%m%d")} as varchar) as BORN from src_leie""",
)
add(
    "surrogate_key",
    lambda x: x.source("leie").select(
        surrogate_key(F.col("NPI"), F.col("EXCLDATE"), F.col("LASTNAME"), F.col("FIRSTNAME")).alias("KEY")
    ),
    f"select {o.sk('NPI', 'EXCLDATE', 'LASTNAME', 'FIRSTNAME')} as KEY from src_leie",
)
add(
    "text_functions",
    lambda x: x.source("leie").select(
        "UPIN",
        "EXCLDATE",
        clean(F.col("FIRSTNAME")).alias("FIRST_NAME"),
        concat_strict(", ", F.trim("LASTNAME"), F.col("FIRSTNAME")).alias("FULL_NAME"),
        describe("{} born {}", F.col("UPIN"), try_date(F.col("DOB"), "yyyyMMdd")).alias("TEXT"),
    ),
    f"""select UPIN, EXCLDATE, upper(trim(FIRSTNAME)) as FIRST_NAME, trim(LASTNAME) || ', ' || FIRSTNAME as FULL_NAME,
        UPIN || ' born ' || cast({o.day("DOB", "%Y%m%d")} as varchar) as TEXT from src_leie""",
)
add(
    "round_half_away",
    lambda x: x.raw("lineitem").select(
        "l_orderkey", "l_linenumber",
        round_half_away(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")), 2).alias("NET"),
        round_half_away(-F.col("l_extendedprice"), 0).alias("NEGATIVE"),
    ),
    f"""select l_orderkey, l_linenumber, {o.half_away("(l_extendedprice * (1e0 - l_discount))", 2)} as NET,
        {o.half_away("(-l_extendedprice)", 0)} as NEGATIVE from lineitem""",
)
add(
    "exact_ratios",
    lambda x: x.raw("lineitem")
    .withColumn("price", F.floor("l_extendedprice").cast("bigint"))
    .withColumn("qty", F.col("l_quantity").cast("bigint"))
    .select(
        "l_orderkey", "l_linenumber",
        ratio_or_zero(F.col("price"), F.col("qty") - 10).alias("RATIO"),
        pct_change(F.col("price"), F.col("l_partkey")).alias("CHANGE"),
        flag_count(F.col("qty") > 10, F.col("qty") > 20, F.col("price") > 30000).alias("FLAGS"),
    ),
    f"""select l_orderkey, l_linenumber, case when q > 10 then {o.rq("p * 100", "(q - 10)")} / 100e0 else 0e0 end as RATIO,
        case when l_partkey > 0 then {o.rq("(p - l_partkey) * 10000", "l_partkey")} / 100e0 end as CHANGE,
        (q > 10)::int + (q > 20)::int + (p > 30000)::int as FLAGS
        from (select *, floor(l_extendedprice)::bigint as p, l_quantity::bigint as q from lineitem)""",
)
add(
    "date_parts",
    lambda x: x.payments.select("PAYMENT_ID", "PAYMENT_YEAR", "PAYMENT_MONTH"),
    "select PAYMENT_ID, PAYMENT_YEAR, PAYMENT_MONTH from m_payments",
)

# --- incremental ------------------------------------------------------------------------------------


def _prescriptions(x: Inputs) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: build_prescriptions(latest_part_d_rows(rows), x.source("leie"), keep_load_time=True).drop("_loaded_at")


def _deliveries(x: Inputs) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of landed rows: the first holds preliminary costs for what the second replaces."""
    landed = x.source("part_d")
    final = landed.filter(F.dayofmonth("_LOAD_TIMESTAMP") == 2)
    preliminary = final.withColumns(
        {"TOT_DRUG_CST": F.lit("1"), "_LOAD_TIMESTAMP": F.lit("2024-01-01").cast("timestamp_ntz")}
    )
    return landed.filter(F.dayofmonth("_LOAD_TIMESTAMP") == 1).unionByName(preliminary), final


def _two_refreshes(x: Inputs) -> DataFrame:
    first, second = _deliveries(x)
    table = MergedTable(x.spark, x.scratch("incremental"), "PRESCRIPTION_ID")
    table.refresh(first, _prescriptions(x))
    table.refresh(first.unionByName(second), _prescriptions(x))
    return table.read()


add("incremental_upsert", _two_refreshes, f"select {PRESCRIPTIONS} from m_prescriptions")


def _corrected(x: Inputs) -> DataFrame:
    """Replace the fulfilled orders by a corrected batch that also brings a new column."""
    orders = x.raw("orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    batch = orders.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), F.lit("corrected").alias("note")
    )
    return upsert(orders, batch, "o_orderkey")


add(
    "upsert_new_columns",
    _corrected,
    """select o_orderkey, if(o_orderstatus = 'F', 'X', o_orderstatus) as o_orderstatus,
        if(o_orderstatus = 'F', null, o_custkey) as o_custkey, if(o_orderstatus = 'F', 'corrected', null) as note from orders""",
)
add(
    "append_new_columns",
    lambda x: append_new_columns(
        x.raw("supplier").select("s_suppkey", "s_name"), x.raw("supplier").select("s_suppkey", "s_acctbal")
    ),
    """select s_suppkey, s_name, cast(null as double) as s_acctbal from supplier
        union all select s_suppkey, null, s_acctbal from supplier""",
)


def _streamed(x: Inputs) -> DataFrame:
    """The deliveries arrive as files, picked up by the stream in two runs."""
    table = MergedTable(x.spark, x.scratch("streamed"), "PRESCRIPTION_ID")
    landing, state = x.scratch("stream"), x.scratch("stream-state")
    for delivery in _deliveries(x):
        delivery.write.mode("append").parquet(landing)
        stream_upserts(x.spark, landing, delivery.schema, table, _prescriptions(x), state)
    return table.read()


add("stream_upsert", _streamed, f"select {PRESCRIPTIONS} from m_prescriptions")


def _preliminary(df: DataFrame, key: str, changed: str) -> DataFrame:
    """An earlier delivery of half of the rows, with another value in one column."""
    half = df.filter(F.pmod(F.xxhash64(key), F.lit(2)) == 0)
    return half.withColumns({changed: F.lit("preliminary"), "_LOAD_TIMESTAMP": F.lit("1990-01-01").cast("timestamp_ntz")})


def _incremental(x: Inputs, name: str, sources: tuple[str, ...], key: str, changed: dict[str, tuple[str, str]], build) -> DataFrame:
    """A first load of preliminary rows, then a second with all final ones: replaced and new rows of several sources."""
    table = MergedTable(x.spark, x.scratch(name), key)
    model = lambda *parts: build(*parts, keep_load_time=True).drop("_loaded_at")
    final = [x.source(s) for s in sources]
    first = [_preliminary(df, *changed[s]) for s, df in zip(sources, final, strict=True)]
    table.refresh(first, model)
    table.refresh([a.unionByName(b) for a, b in zip(first, final, strict=True)], model)
    return table.read()


_FACILITY_KEYS = {
    "hospice": ("CMS_CERTIFICATION_NUMBER", "FACILITY_NAME"),
    "home_health": ("CMS_CERTIFICATION_NUMBER", "PROVIDER_NAME"),
    "ltch": ("CMS_CERTIFICATION_NUMBER", "FACILITY_NAME"),
    "nursing_home": ("FEDERAL_PROVIDER_NUMBER", "PROVIDER_NAME"),
}
add(
    "incremental_facilities",
    lambda x: _incremental(x, "facilities", tuple(_FACILITY_KEYS), "CCN", _FACILITY_KEYS, build_facilities),
    f"select {FACILITIES} from m_facilities",
)
add(
    "incremental_hospital_spending",
    lambda x: _incremental(
        x, "spending", ("spending",), "SPENDING_ID", {"spending": ("FACILITY_ID", "FACILITY_NAME")}, build_hospital_spending
    ),
    f"select {SPENDING} from m_spending",
)


def _second_lake(x: Inputs) -> DataFrame:
    """A lake that got a first load of each source, refreshed by another lake over its folder and read by a third."""
    folder = x.scratch("second-lake")
    sources = fixture_sources(x.spark, x.folder)
    first = {"spending": lambda: _preliminary(x.source("spending"), "FACILITY_ID", "FACILITY_NAME")}
    Lake(x.spark, sources | first, folder).refresh("hospital_spending")
    both = {"spending": lambda: first["spending"]().unionByName(x.source("spending"))}
    Lake(x.spark, sources | both, folder).refresh("hospital_spending")
    return Lake(x.spark, {}, folder)["hospital_spending"]


add("lake_of_another_session", _second_lake, f"select {SPENDING} from m_spending")


def _orders(x: Inputs, day: str | None, status: str | None = None) -> DataFrame:
    changed = F.col("o_orderstatus") if status is None else F.lit(status)
    return x.raw("orders").select(
        "o_orderkey", changed.alias("o_orderstatus"), F.lit(day).cast("timestamp_ntz").alias("_LOAD_TIMESTAMP")
    )


def _late(x: Inputs) -> DataFrame:
    """Rows of an older load that arrive after newer ones: they fill gaps and replace nothing."""
    table = MergedTable(x.spark, x.scratch("late"), "o_orderkey", buckets=8)
    table.merge(_orders(x, "2024-01-05").filter(F.col("o_orderstatus") == "F"))
    table.merge(_orders(x, "2024-01-01", "OLD"))
    return table.read()


def _null_and_equal(x: Inputs) -> DataFrame:
    """A second delivery with the load time of the mark, and rows without any."""
    table = MergedTable(x.spark, x.scratch("equal"), "o_orderkey", buckets=8)
    third = F.col("o_orderkey") % 3
    first = _orders(x, "2024-01-01").filter(third == 0)
    table.refresh(first, lambda df: df)
    second = _orders(x, "2024-01-01").filter(third == 1).unionByName(_orders(x, None).filter(third == 2))
    table.refresh(first.unionByName(second), lambda df: df)
    return table.read()


def _reset(x: Inputs) -> DataFrame:
    """A stream that begins again with an empty checkpoint, after more files have arrived."""
    table = MergedTable(x.spark, x.scratch("reset"), "o_orderkey", buckets=8)
    landing, odd = x.scratch("reset-in"), F.col("o_orderkey") % 2
    for part in (0, 1):
        rows = _orders(x, f"2024-01-0{part + 1}").filter(odd == part)
        rows.write.mode("append").parquet(landing)
        stream_upserts(x.spark, landing, rows.schema, table, lambda df: df, x.scratch("reset-state"))
    return table.read()


add(
    "incremental_late_rows",
    _late,
    "select o_orderkey, if(o_orderstatus = 'F', 'F', 'OLD') as o_orderstatus from orders",
)
add("incremental_null_and_equal_times", _null_and_equal, "select o_orderkey, o_orderstatus from orders")
add("stream_checkpoint_reset", _reset, "select o_orderkey, o_orderstatus from orders")


def _malformed(x: Inputs) -> DataFrame:
    """Suppliers as CSV lines, those of odd number with a balance that is no number: kept and refused rows, counted."""
    folder = x.scratch("csv")
    bad = F.col("s_suppkey") % 2 == 1
    balance = F.when(bad, F.lit("n/a")).otherwise(F.col("s_acctbal").cast("string"))
    x.raw("supplier").select("s_suppkey", "s_name", balance.alias("s_acctbal")).write.option("header", True).csv(folder)
    schema = T.StructType(
        [T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()), T.StructField("s_acctbal", T.DoubleType())]
    )
    good, refused = readers.split_malformed(x.spark, folder, schema)
    kept = good.select(F.lit("good").alias("KIND"), F.col("s_suppkey").alias("S_SUPPKEY"))
    number = F.split("_corrupt_record", ",")[0].try_cast("long")
    return kept.unionByName(refused.select(F.lit("bad").alias("KIND"), number.alias("S_SUPPKEY")))


add(
    "tolerant_csv_report",
    _malformed,
    "select if(s_suppkey % 2 = 1, 'bad', 'good') as KIND, cast(s_suppkey as bigint) as S_SUPPKEY from supplier",
)


def _distinct_npis(x: Inputs) -> DataFrame:
    """Paid providers by state and category, and by state and in all from the same bitmaps."""
    made = bitmaps.distinct_bitmaps(x.payments, ["STATE", "PAYMENT_CATEGORY"], "NPI", x.scratch("numbers"))
    made = sinks.write_table(made, x.scratch("bitmaps"))
    levels = [bitmaps.distinct_counts(made, keys, "PROVIDERS") for keys in (["STATE", "PAYMENT_CATEGORY"], ["STATE"], [])]
    names = ("state and category", "state", "all")
    return filters.union_all([level.withColumn("BY", F.lit(name)) for level, name in zip(levels, names, strict=True)])


add(
    "distinct_by_bitmaps",
    _distinct_npis,
    """select STATE, PAYMENT_CATEGORY, count(distinct NPI) as PROVIDERS, 'state and category' as "BY" from m_payments group by all
        union all select STATE, null, count(distinct NPI), 'state' from m_payments group by STATE
        union all select null, null, count(distinct NPI), 'all' from m_payments""",
)


def same_rows(name: str, run: Callable[[Inputs], DataFrame], other: str) -> None:
    """Another way to the result of a registered query."""
    add(name, run, "select 1")
    QUERIES[name] = Query(run, QUERIES[other].sql)


same_rows("search_by_trigrams", lambda x: x.search.search_providers("customer#0000001"), "search_providers")
same_rows("search_by_trigrams_npi", lambda x: x.search.search_providers("0012", 100), "search_providers_by_npi")
same_rows("compare_by_trigrams", lambda x: x.search.compare_search("omer#00000010"), "compare_search")
same_rows("keyed_provider_details", lambda x: x.search.provider_details(NPI), "provider_details")
same_rows("keyed_provider_alerts", lambda x: x.search.provider_alerts(NPI).drop("ALERT_DATE"), "provider_alerts")
same_rows("keyed_risk_score", lambda x: x.search.risk_score(NPI), "risk_score")
add(
    "trigram_counts",
    lambda x: x.search.index.counts.select("GRAM", "N"),
    """select substr(t, i, 3) as GRAM, count(distinct NPI) as N from (select NPI, t, unnest(range(1, length(t) - 1)) as i
        from (select NPI, unnest([NPI, upper(FULL_NAME), upper(ORGANIZATION_NAME)]) as t from m_360)) group by 1""",
)
add(
    "keyed_row_groups",
    lambda x: x.search.row_groups(NPI).select(F.col("COLUMN").alias("SEARCHED"), F.col("READ").alias("GROUPS_READ")),
    f"select 'NPI' as SEARCHED, count(*) as GROUPS_READ from m_360 where NPI = '{NPI}'",
)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(run: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: comparable(run(inputs_for(spark, folder)))

    return {name: wrap(query.run) for name, query in QUERIES.items()}


def expected_sql() -> dict[str, str]:
    return {name: query.sql for name, query in QUERIES.items()}
