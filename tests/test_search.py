from __future__ import annotations

import random
import re

import pytest

from provwatch.operators.search import TrigramIndex, term_trigrams
from provwatch.plans import serving
from provwatch.plans.search import ProviderSearch
from provwatch.sources import keyed
from provwatch.sources.layout import row_groups
from provwatch.sources.sinks import write_table

PROFILE = (
    "NPI string, FULL_NAME string, ORGANIZATION_NAME string, ENTITY_TYPE string, SPECIALTY string, STATE string,"
    " CITY string, IS_EXCLUDED boolean, TOTAL_FINANCIAL_EXPOSURE double"
)


def profile(npi, full=None, organization=None, exposure=None):
    return (npi, full, organization, "1", "S", "CA", "X", False, exposure)


def built(spark, folder, profiles, buckets=8):
    table = write_table(spark.createDataFrame(profiles, PROFILE).repartition(3), f"{folder}/in")
    alerts = spark.createDataFrame([("1", 2), ("1", 1), ("2", 1)], "NPI string, PRIORITY_RANK int")
    scores = spark.createDataFrame([("1", 40, "LOW")], "NPI string, FRAUD_RISK_SCORE int, RISK_TIER string")
    return table, ProviderSearch.build(table, alerts, scores, f"{folder}/search", buckets)


@pytest.fixture(scope="module")
def searched(spark, tmp_path_factory):
    draw = random.Random(4)
    names = ["".join(draw.choice("abC o'") for _ in range(draw.randint(0, 12))) for _ in range(600)]
    profiles = [profile(str(1000 + i), n or None, names[-i] if i % 3 else None, float(i % 7)) for i, n in enumerate(names)]
    profiles += [profile("900", "100% pure_care", None, 1.0), profile("901", None, "back\\slash", 2.0), profile("902")]
    profiles += [profile("903", "Ünïcode Straße", None, 3.0), profile("904", "ab", "c", 4.0), profile("abc1", "zz", None, 5.0)]
    return built(spark, str(tmp_path_factory.mktemp("search")), profiles)


TERMS = ["abC", "bco", "o'a", "100", "104", "ABCO", "a_c", "ab%co", "0% pure", "pure_care", "back\\slash", "ünï", "traß", "zzz", "c o'", "a%b"]


@pytest.mark.parametrize("term", TERMS)
def test_index_gives_what_a_scan_gives(searched, term):
    profiles, search = searched
    everything = 10_000
    assert search.search_providers(term, everything).collect() == serving.search_providers(profiles, term, everything).collect()
    assert search.search_providers(term).collect() == serving.search_providers(profiles, term).collect()
    assert search.compare_search(term, everything).collect() == serving.compare_search(profiles, term, everything).collect()


@pytest.mark.parametrize("term", ["a", "", "1003", "abc1", "ABC1"])
def test_comparison_takes_numbers_and_short_terms(searched, term):
    profiles, search = searched
    assert search.compare_search(term, 10_000).collect() == serving.compare_search(profiles, term, 10_000).collect()


def test_short_search_terms_are_refused(searched):
    with pytest.raises(ValueError):
        searched[1].search_providers("ab")


def test_no_trigram_spans_a_wildcard():
    assert term_trigrams("AB%CDE_F") == ["CDE"]
    assert term_trigrams("ABAB") == ["ABA", "BAB"]
    assert term_trigrams("AB") == term_trigrams("A_B%C") == []


def test_lookups_and_searches_read_some_folders_only(searched):
    search = searched[1]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    of_folders = re.compile(r"search/profiles\], PartitionFilters: \[[^\]]*bucket_of_8")
    assert of_folders.search(plan(search.provider_details("1003")))
    few, many = search._possible("100% PURE"), search._possible("ABC")
    assert few.count() == 1 and of_folders.search(plan(few)) and "EqualTo(NPI,900)" in plan(few)
    assert many.count() > keyed.FEW and of_folders.search(plan(many))


def test_lookups(searched, spark):
    search = searched[1]
    assert [r["PRIORITY_RANK"] for r in search.provider_alerts("1").collect()] == [1, 2]
    assert search.provider_alerts("3").collect() == search.risk_score("2").collect() == []
    assert search.risk_score("1").collect() == [(40, "LOW")]
    assert [tuple(r) for r in search.row_groups("1003").select("COLUMN", "READ").collect()] == [("NPI", 1)]
    assert keyed.rows_of(search.tables["profiles"], "NPI", None).collect() == []


def test_without_profiles(spark, tmp_path):
    profiles, search = built(spark, str(tmp_path), [])
    assert search.search_providers("abc").collect() == search.provider_details("1").collect() == []
    assert search.compare_search("a").collect() == []
    assert search.index.candidates("ABC").collect() == []


def test_sorted_groups_are_skipped_and_hot_keys_are_split(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("case when id % 3 = 0 then 'hot' else lpad(string(id), 8, '0') end as k", "id", "sha2(string(id), 256) as v")
    source = write_table(rows.unionByName(spark.createDataFrame([(None, -1, "n")], "k string, id long, v string")), str(tmp_path / "in"))
    table = keyed.write_keyed(source, str(tmp_path / "keyed"), "k", buckets=4, row_group_bytes=200_000)
    assert table.count() == 60_001 and table.where("k is null").count() == 1
    some = keyed.groups_to_read(table, "k", "00030001").first()
    assert some["READ"] <= 2 < some["GROUPS"]
    assert [r["id"] for r in keyed.rows_of(table, "k", "00030001").collect()] == [30001]
    hot = keyed.rows_of(table, "k", "hot")
    assert hot.count() == 20_000
    # one key's rows come from several tasks
    holding = row_groups(table, ["k"]).where("LOW <= 'hot' and 'hot' <= HIGH").select("FILE").distinct().count()
    assert holding > 1
    wanted = write_table(spark.createDataFrame([("hot",), ("00030001",), ("none",)], "k string"), str(tmp_path / "keys"))
    assert keyed.rows_of_keys(table, "k", wanted).count() == 20_001


def test_repeated_rows_count_once_in_the_index(spark, tmp_path):
    source = write_table(spark.createDataFrame([("1", "abcabc"), ("1", "abcabc"), (None, "abc"), ("2", None)], "k string, t string"), str(tmp_path / "in"))
    index = TrigramIndex.build(source, str(tmp_path / "index"), "k", [source["t"]], 2)
    assert sorted((r["GRAM"], r["N"]) for r in index.counts.collect()) == [("abc", 1), ("bca", 1), ("cab", 1)]
    assert [r["k"] for r in index.candidates("abca").collect()] == ["1"]
