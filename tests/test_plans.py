"""Shape of the physical plans: what must and must not be in them."""

from __future__ import annotations

import os

import pytest

from tests.conftest import SMALL
from provwatch.plans.prescriptions import build_prescriptions
from provwatch.plans.summaries import build_prescriptions_summary
from verify.registry import QUERIES, inputs_for

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="generated tables are not available")

# Queries that only move files are left out: their plan is a file scan.
MODELS = [
    "exclusions", "provider_master", "payments", "prescriptions", "facilities", "hospital_spending", "payments_summary",
    "prescriptions_summary", "provider_360", "fraud_risk_score", "high_risk_alerts", "provider_ml_features", "percentiles",
    "peer_stats", "zscores", "drug_concentration", "pharma_diversity", "compare_pairs", "payments_by_state", "kpis",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", MODELS)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name].run(inputs_for(spark, SMALL)))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", MODELS)
def test_no_cross_join_without_broadcasts(no_broadcast, name):
    plan = plan_of(QUERIES[name].run(inputs_for(no_broadcast, SMALL)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_score_is_a_projection(spark):
    assert "Exchange" not in plan_of(QUERIES["fraud_risk_score"].run(inputs_for(spark, SMALL)))


def test_profile_joins_share_one_partitioning(no_broadcast):
    """Four inputs unique by NPI: one shuffle each, none between the joins."""
    plan = plan_of(QUERIES["provider_360"].run(inputs_for(no_broadcast, SMALL)))
    assert plan.count("Exchange hashpartitioning(NPI") == plan.count("Exchange") == 4


def test_lookup_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["provider_details"].run(inputs_for(spark, SMALL)))
    assert "PushedFilters: [IsNotNull(NPI), EqualTo(NPI,1000000070)]" in plan


def test_reports_read_only_their_columns(spark):
    plan = plan_of(QUERIES["volume_tiers"].run(inputs_for(spark, SMALL)))
    assert "ReadSchema: struct<TOTAL_COST:decimal(28,2),PRESCRIBER_VOLUME_TIER:string>" in plan


def test_top_k_keeps_candidates_per_task(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_prescribers"].run(inputs_for(spark, SMALL)))


def test_prescription_sums_are_not_sent_per_drug(no_broadcast):
    """Beside a distinct count, all sums would be shuffled by prescriber and drug before they are by prescriber."""
    x = inputs_for(no_broadcast, SMALL)
    summary = build_prescriptions_summary(build_prescriptions(x.source("part_d"), x.source("leie")))
    lines = plan_of(summary).splitlines()
    assert not [n for n in lines if "Aggregate(keys=[NPI" in n and "GENERIC_NAME" in n.split("functions=")[0] and "sum(" in n]
    assert [n for n in lines if "sum(" in n]
