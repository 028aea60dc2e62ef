from __future__ import annotations

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.streaming import incremental
from provwatch.streaming.incremental import MergedTable, since_watermark, stream_upserts, upsert

DAY = datetime(2024, 1, 1)
SCHEMA = "k string, v int, _LOAD_TIMESTAMP timestamp_ntz"


def batch(spark, *rows):
    return spark.createDataFrame([(k, v, None if d is None else DAY + timedelta(days=d)) for k, v, d in rows], SCHEMA)


def content(table):
    return {r["k"]: r["v"] for r in table.read().collect()}


def keep(df):
    return df


def test_watermark(spark):
    df = batch(spark, ("a", 1, 0), ("b", 2, 1), ("c", 3, None))
    assert since_watermark(df, None).count() == 3
    # rows of the mark itself may not all have been there; rows without a time never have a better chance
    assert sorted(r["k"] for r in since_watermark(df, DAY + timedelta(days=1)).collect()) == ["b", "c"]


def test_refresh_merges_what_is_new(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    first = batch(spark, ("a", 1, 0), ("b", 2, 1), ("n", 9, None))
    assert table.refresh(first, keep)
    assert content(table) == {"a": 1, "b": 2, "n": 9}
    assert not table.refresh(first, keep)
    # "a" was changed without a newer load time and is older than the mark
    second = batch(spark, ("a", 100, 0), ("b", 20, 2), ("c", 30, 2))
    assert table.refresh(second, keep)
    assert content(table) == {"a": 1, "b": 20, "c": 30, "n": 9}
    assert table.high_water() == DAY + timedelta(days=2)


def test_equal_null_and_late_times(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.refresh(batch(spark, ("a", 1, 1)), keep)
    table.refresh(batch(spark, ("same", 2, 1), ("none", 3, None), ("later", 4, 2)), keep)
    assert content(table) == {"a": 1, "same": 2, "none": 3, "later": 4}
    table.merge(batch(spark, ("later", 40, 0), ("gap", 5, 0)))  # an older load arrives last
    assert content(table) == {"a": 1, "same": 2, "none": 3, "later": 4, "gap": 5}
    table.merge(batch(spark, ("later", 41, 2)))  # equal time: the later arrival
    assert content(table)["later"] == 41 and table.high_water() == DAY + timedelta(days=2)


def test_several_sources_share_one_mark(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    both = lambda a, b: a.unionByName(b)
    table.refresh([batch(spark, ("a", 1, 0)), batch(spark, ("b", 2, 3))], both)
    table.refresh([batch(spark, ("x", 5, 1)), batch(spark, ("c", 3, 4))], both)
    assert content(table) == {"a": 1, "b": 2, "c": 3}


def test_session_time_zone_does_not_move_the_mark(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=4)
        table.refresh(batch(spark, ("a", 1, 0)), keep)
        assert table.high_water() == DAY
        later = batch(spark, ("b", 2, 0)).withColumn("_LOAD_TIMESTAMP", F.expr("_LOAD_TIMESTAMP + interval 1 second"))
        assert table.refresh(later, keep)
        assert content(table) == {"a": 1, "b": 2}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def bucket_files(path):
    return {b.name: sorted(f.name for f in b.glob("*.parquet")) for b in (path / "rows").glob("table_bucket=*")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=8)
    table.merge(batch(spark, *[(f"k{i}", i, 0) for i in range(200)]))
    before = bucket_files(tmp_path / "t")
    assert table.merge(batch(spark, ("k5", 500, 1)))
    after = bucket_files(tmp_path / "t")
    assert len(before) == 8 and sum(before[b] != after[b] for b in after) == 1
    assert content(table)["k5"] == 500 and table.read().count() == 200
    assert not table.merge(batch(spark, ("k5", 500, 1)))
    assert bucket_files(tmp_path / "t") == after


@pytest.mark.parametrize("step", ["preparing", "copying", "mark", "cleaning"])
def test_a_lost_writer_loses_no_rows(spark, tmp_path, monkeypatch, step):
    """The writer ends while it prepares buckets, in the middle of the copy, or behind it."""
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.merge(batch(spark, *[(f"k{i}", i, 0) for i in range(40)]))
    expected = content(table) | {"k3": 300, "new": 1}

    class Lost(Exception):
        pass

    def lost(*_):
        raise Lost

    if step == "preparing":
        write = incremental._write_buckets

        def torn(rows, path):
            write(rows, path)
            (tmp_path / "t" / "prepared" / "_SUCCESS").unlink()  # files, but no commit
            raise Lost

        monkeypatch.setattr(incremental, "_write_buckets", torn)
    elif step == "copying":

        def swapped(self):
            for bucket in (tmp_path / "t" / "prepared").glob("table_bucket=*"):
                for file in (tmp_path / "t" / "rows" / bucket.name).iterdir():
                    file.unlink()  # the old files are gone, the new ones have not come
            raise Lost

        monkeypatch.setattr(MergedTable, "_apply", swapped)
    elif step == "mark":
        monkeypatch.setattr(MergedTable, "_add_mark", lost)
    else:
        monkeypatch.setattr("provwatch.streaming.incremental.remove_folder", lost)
    with pytest.raises(Lost):
        table.merge(batch(spark, ("k3", 300, 1), ("new", 1, 1)))
    monkeypatch.undo()
    again = MergedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    if step != "preparing":
        assert content(again) == expected  # before anything is repaired
    assert again.merge(batch(spark, ("k3", 300, 1), ("new", 1, 1))) == (step == "preparing")
    assert content(again) == expected
    assert again.high_water() == DAY + timedelta(days=1)


def test_batch_with_duplicate_keys_keeps_the_newest(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    table.merge(batch(spark, ("a", 1, 2), ("a", 0, 1), ("b", 3, 0)))
    assert content(table) == {"a": 1, "b": 3} and table.read().count() == 2


def test_new_columns_are_appended(spark, tmp_path):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = upsert(target, spark.createDataFrame([("b", "x")], "k string, note string"), "k")
    assert {tuple(r) for r in out.collect()} == {("a", 1, None), ("b", None, "x")}
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=2)
    table.merge(batch(spark, *[(f"k{i}", i, 0) for i in range(20)]))
    table.merge(batch(spark, ("k1", 100, 1)).withColumn("note", F.lit("new")))
    assert {r["k"]: (r["v"], r["note"]) for r in table.read().collect()}["k1"] == (100, "new")
    assert table.read().filter("note is null").count() == 19


def test_reading_a_missing_table_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="not been written"):
        MergedTable(spark, str(tmp_path / "none"), "k").read()


def test_stream_picks_up_files_once_and_survives_a_new_checkpoint(spark, tmp_path):
    landing, state = str(tmp_path / "in"), str(tmp_path / "state")
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    one = batch(spark, ("a", 1, 0), ("b", 2, 0))
    one.coalesce(1).write.mode("append").parquet(landing)
    stream_upserts(spark, landing, one.schema, table, keep, state)
    assert content(table) == {"a": 1, "b": 2}
    before = bucket_files(tmp_path / "t")
    stream_upserts(spark, landing, one.schema, table, keep, state)
    assert bucket_files(tmp_path / "t") == before
    batch(spark, ("b", 20, 1), ("c", 3, 1)).coalesce(1).write.mode("append").parquet(landing)
    stream_upserts(spark, landing, one.schema, table, keep, state)
    assert content(table) == {"a": 1, "b": 20, "c": 3}
    batch(spark, ("d", 4, 0), ("b", 0, 0)).coalesce(1).write.mode("append").parquet(landing)
    stream_upserts(spark, landing, one.schema, table, keep, str(tmp_path / "another"))
    assert content(table) == {"a": 1, "b": 20, "c": 3, "d": 4}


def test_a_large_first_load_is_written_where_it_is_read(spark, tmp_path):
    """Same table as by dealing all rows, with repeated keys, equal times, null times and a null key."""
    rows = [(f"k{i % 90}", i, i % 4) for i in range(100)] + [("k5", 900, 3), ("k6", 901, None), (None, 1, 0), (None, 2, 1)]
    tables = [MergedTable(spark, str(tmp_path / f"t{n}"), "k", buckets=4, large=n) for n in (0, 10**9)]
    for table in tables:
        assert table.merge(batch(spark, *rows).repartition(3))
    assert content(tables[0]) == content(tables[1]) and tables[0].read().count() == 91
    assert tables[0].high_water() == tables[1].high_water()
    for table in tables:
        assert table.merge(batch(spark, ("k7", 700, 4), ("new", 1, 0)))
        assert not table.merge(batch(spark, ("k7", 700, 4), ("new", 1, 0)))
    assert content(tables[0]) == content(tables[1]) and content(tables[0])["k7"] == 700


def test_content_is_hashed_as_it_is_and_by_column(spark, tmp_path):
    """No value of a simple type is turned into text for its hash; equal values of other columns are other content."""
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=2)
    wide = "k string, a decimal(27,2), b decimal(27,2), c bigint, d date, e double, f array<int>, _LOAD_TIMESTAMP timestamp_ntz"
    rows = [("x", 1, None, 2, None, 0.5, [1], DAY), ("y", None, None, None, DAY.date(), None, None, DAY)]
    make = lambda *r: spark.createDataFrame(r, "k string, a int, b int, c bigint, d date, e double, f array<int>, _LOAD_TIMESTAMP timestamp_ntz").to(
        T._parse_datatype_string(wide)
    )
    assert table.merge(make(*rows)) and not table.merge(make(*rows))
    plan = spark._jvm.PythonSQLUtils.explainString(table._incoming(make(*rows).coalesce(2))._jdf.queryExecution(), "simple")
    line = next(x for x in plan.splitlines() if "AS row_content" in x)
    assert set(re.findall(r"cast\((\w+)#\d+\w* as string\)", line)) == {"e", "f"}
    assert table.merge(make(("x", None, 1, 2, None, 0.5, [1], DAY)))  # from a to b
    assert [tuple(r)[:4] for r in table.read().orderBy("k").collect()] == [("x", None, 1, 2), ("y", None, None, None)]
    assert not table.merge(make(("x", None, 1, 2, None, 0.5, [1], DAY)).drop("a"))  # what is absent counts as NULL


def test_ties_of_a_batch_are_decided_by_text(spark, tmp_path):
    """Different rows of a key and load time: the same one wins in a first load, in a merge, and where it is there already."""
    news = [(f"k{i % 40}", i, 3) for i in range(200)]
    text = lambda k, v: F.xxhash64(F.lit(f"k={k}"), F.lit(f"v={v}"))
    hashes = spark.range(1).select(*[text(k, v) for k, v, _ in news]).first()
    wins = {k: v for (k, v, _), _ in sorted(zip(news, hashes, strict=True), key=lambda x: -x[1])}
    for name, first in (("none", []), ("old", [(f"k{i}", -1, 1) for i in range(40)]), ("there", [(k, v, 3) for k, v, _ in news[:40]])):
        table = MergedTable(spark, str(tmp_path / name), "k", buckets=2)
        if first:
            table.merge(batch(spark, *first))
        table.merge(batch(spark, *news).repartition(3))
        assert content(table) == wins


def _shuffled_columns(df):
    """Columns of each exchange of a plan."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [set(re.findall(r"(\w+)#\d+", line)) for line in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", text)]


def test_merging_shuffles_no_whole_rows(spark, tmp_path, monkeypatch):
    """Rows of many positions and columns: exchanges carry hashes and positions, and the result is that of a plain merge."""
    table = MergedTable(spark, str(tmp_path / "t"), "k", buckets=2)
    wide = lambda df: df.withColumn("text", F.concat(F.lit("t"), F.col("v").cast("string")))
    first = [(f"k{i}", i, 0) for i in range(9000)] + [(None, -1, 0)]
    table.merge(wide(batch(spark, *first)))
    seen = []
    changes, prepare = MergedTable._changes, incremental._write_buckets
    monkeypatch.setattr(MergedTable, "_changes", lambda self, *a: seen.append(changes(self, *a)) or seen[-1])
    monkeypatch.setattr(incremental, "_write_buckets", lambda df, *a, **o: seen.append(df) or prepare(df, *a, **o))
    # every third key thrice, older, newer and newest; some unchanged, some without time, some new
    news = [(f"k{i}", 10 * i + d, d) for i in range(0, 9000, 3) for d in (-1, 1, 2)]
    news += [(f"k{i}", i, 0) for i in range(1, 9000, 3)] + [("k2", 7, None), ("k5", 8, None), (None, -2, 1), ("new", 5, -3)]
    assert table.merge(wide(batch(spark, *news)).repartition(3))
    expected = {k: v for k, v, _ in first} | {f"k{i}": 10 * i + 2 for i in range(0, 9000, 3)}
    expected |= {"k2": 7, "k5": 8, None: -2, "new": 5}
    rows = table.read().collect()
    assert {r["k"]: (r["v"], r["text"]) for r in rows} == {k: (v, f"t{v}") for k, v in expected.items()}
    assert len(rows) == len(expected)
    exchanged = [c for df in seen[:2] for c in _shuffled_columns(df)]
    assert exchanged and not any(c & {"k", "v", "text"} for c in exchanged)


def test_marked_rows_without_broadcast_are_the_same(spark, tmp_path):
    tables = [MergedTable(spark, str(tmp_path / f"t{n}"), "k", buckets=2, sent=n) for n in (0, 10**6)]
    for table in tables:
        table.merge(batch(spark, *[(f"k{i}", i, 0) for i in range(50)]))
        assert table.merge(batch(spark, *[(f"k{i}", -i, 1) for i in range(0, 90, 4)]))
    assert content(tables[0]) == content(tables[1]) and tables[0].read().count() == 50 + 10


def test_latest_part_d_rows_of_one_load_time(spark):
    names = "PRSCRBR_NPI string, BRND_NAME string, GNRC_NAME string, cost int, _LOAD_TIMESTAMP timestamp_ntz"
    rows = [("1", "b", "g", c, DAY + timedelta(days=d)) for c, d in ((5, 0), (3, 0), (9, 1))] + [("1", "b", None, 4, None)]
    found = incremental.latest_part_d_rows(spark.createDataFrame(rows, names))
    assert sorted((r["GNRC_NAME"] or "", r["cost"]) for r in found.collect()) == [("", 4), ("g", 3), ("g", 9)]
