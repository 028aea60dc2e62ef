from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from provwatch.plans.lake import MODELS, Lake
from provwatch.sources import layout, sinks
from tests.conftest import SMALL
from verify.fixtures import fixture_sources

SPENDING = ["SPENDING_ID", "CCN"]


def unread(*names):
    def fail():
        raise AssertionError("a source was read")

    return {n: fail for n in names}


@pytest.fixture(scope="module")
def sources(spark):
    return fixture_sources(spark, SMALL)


def halves(sources, name, key):
    """The first load has half of the rows."""
    rows = sources[name]()
    return {name: lambda: rows.filter(F.pmod(F.xxhash64(key), F.lit(2)) == 0)}


def test_a_second_session_opens_what_is_there(spark, sources, tmp_path, rows):
    folder = str(tmp_path / "lake")
    first = Lake(spark, sources, folder)
    for name in ("hospital_spending", "payments", "payments_summary"):
        second = Lake(spark, unread(*sources), folder)
        assert rows(first[name]) == rows(second[name]) != []


def test_refresh_picks_up_new_rows_of_an_incremental_model(spark, sources, tmp_path, rows):
    folder = str(tmp_path / "lake")
    Lake(spark, halves(sources, "spending", "FACILITY_ID"), folder).refresh("hospital_spending")
    later = Lake(spark, sources, folder)
    before = rows(later["hospital_spending"], *SPENDING)
    later.refresh("hospital_spending")
    after = rows(later["hospital_spending"], *SPENDING)
    assert set(before) < set(after) and after == rows(later.plan("hospital_spending"), *SPENDING)
    whole = Lake(spark, sources, str(tmp_path / "other"), incremental=False)
    columns = [c for c in whole["hospital_spending"].columns if c != "_loaded_at"]
    assert rows(whole["hospital_spending"], *columns) == rows(later["hospital_spending"], *columns)


def test_full_refresh_drops_what_the_sources_lost(spark, sources, tmp_path):
    folder = str(tmp_path / "lake")
    lake = Lake(spark, sources, folder)
    everything = lake["hospital_spending"].count()
    half = Lake(spark, halves(sources, "spending", "FACILITY_ID"), folder)
    half.refresh("hospital_spending")
    assert half["hospital_spending"].count() == everything
    half.refresh("hospital_spending", full=True)
    assert 0 < half["hospital_spending"].count() < everything


def test_full_models_switch_and_keep_the_last_version(spark, sources, tmp_path, rows):
    lake = Lake(spark, sources, str(tmp_path / "lake"))
    old = lake["payments_summary"]
    count = old.count()
    path = f"{lake.folder}/payments_summary"
    lost = sinks.next_version(spark, path)
    lake.spark.range(3).write.parquet(lost)  # a writer that never committed
    (tmp_path / "lake" / "payments_summary" / lost.rsplit("/", 1)[-1] / "_SUCCESS").unlink()
    assert lake["payments_summary"].count() == count
    lake.refresh("payments_summary")
    assert old.count() == count  # the version that a reader is at stays
    lake.refresh("payments_summary")
    lake.refresh("payments_summary")
    assert len(list((tmp_path / "lake" / "payments_summary").iterdir())) == 2
    assert lake["payments_summary"].count() == count


def test_every_model_is_buildable_both_ways():
    assert {n for n, m in MODELS.items() if m.key} == {"prescriptions", "facilities", "hospital_spending"}
    assert all(m.loads <= len(m.inputs) for m in MODELS.values())


@pytest.fixture
def grid(spark):
    """A third of all rows in one state; nulls in every column."""
    state = F.when(F.col("id") % 3 == 0, F.lit("TX")).when(F.col("id") % 101 != 0, F.concat(F.lit("S"), F.lpad((F.col("id") % 40).cast("string"), 2, "0")))
    npi = F.when(F.col("id") % 97 != 0, (F.lit(10**9) + F.xxhash64("id") % 5000).cast("string"))
    kind = F.when(F.col("id") % 50 == 0, "OWNERSHIP").when(F.col("id") % 7 == 0, "RESEARCH").otherwise("GENERAL")
    return spark.range(60_000).select("id", state.alias("state"), npi.alias("npi"), kind.alias("kind"))


def test_z_order_lets_a_search_by_any_column_skip_row_groups(spark, grid, tmp_path, rows):
    npi = grid.where("id = 12345").first().npi
    wanted = {"state": "S07", "npi": npi, "kind": "OWNERSHIP"}
    table = sinks.write_clustered(grid, str(tmp_path / "z"), ["state", "npi", "kind"], partitions=64, spread=["id"])
    assert table.count() == 60_000 and table.select(F.sum("id")).first()[0] == 60_000 * 59_999 // 2
    for r in layout.groups_read(table, wanted).collect():
        assert r.GROUPS >= 60 and r.READ * 3 < r.GROUPS, r
    sizes = layout.row_groups(table, ["state"]).select("ROWS").collect()
    assert max(s.ROWS for s in sizes) < 3 * 60_000 / 64  # the hot state is spread


def test_ranges_by_halving(spark):
    assert layout.cut_points([3, 1, None, 2, 2], 4) == [2, 3]
    cuts = layout.cut_points(list(range(1000)), 8)
    assert len(cuts) == 7
    got = spark.createDataFrame([(v,) for v in (-1, 0, 124, 125, 126, 999, None)], "v int")
    numbers = [r[0] for r in got.select(layout.range_number(F.col("v"), cuts)).collect()]
    assert numbers == [sum(c <= v for c in cuts) if v is not None else 7 for v in (-1, 0, 124, 125, 126, 999, None)]


def test_empty_table_can_be_clustered(spark, grid, tmp_path):
    assert sinks.write_clustered(grid.limit(0), str(tmp_path / "z"), ["state", "npi"]).count() == 0
