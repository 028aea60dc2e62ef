from __future__ import annotations

import random

import duckdb
import numpy as np

import corpus_pipeline
from provwatch.llm import string_tiling
from provwatch.llm.queries import llm_queries, llm_sql
from provwatch.llm.string_tiling import contamination, tiles
from tests.conftest import SMALL


def brute_tiles(a, b, minimum):
    """Repeatedly mark the longest common run of unmarked words."""
    in_a, in_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not in_a[i + n] and not in_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < minimum:
            return out
        in_a[i : i + n] = [True] * n
        in_b[j : j + n] = [True] * n
        out.append((i, j, n))


def test_tiles_equal_brute_force():
    rng = random.Random(7)
    for _ in range(150):
        letters = rng.choice([2, 3, 6])
        a = [rng.randrange(letters) for _ in range(rng.randint(0, 25))]
        b = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        found = tiles(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        expected = brute_tiles(a, b, 3)
        assert [n for _, _, n in found] == [n for _, _, n in expected]
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in found)


def words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_reordered_and_partial_passages(spark, monkeypatch):
    item = words("q", 40).split()
    turned = " ".join(item[25:] + ["between"] + item[:25])
    data = [
        (1, f"{words('a', 50)} {' '.join(item).upper()} {words('b', 9)}"),
        (2, f"{words('c', 20)} {turned}"),
        (3, f"{words('d', 20)} {' '.join(item[:19])} {words('e', 5)}"),  # under a half
        (4, " ".join(w for pair in zip(item, words("f", 40).split(), strict=True) for w in pair)),  # no run of five
        (5, f"{' '.join(item[:12])} x {' '.join(item[28:])}"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, words("z", 30)), (3, "too short"), (4, None), (None, words("a", 30))], "item_id long, text string")
    one = {r["doc_id"]: (r["contaminated"], [(i["item_id"], i["tiles"]) for i in r["items"]]) for r in contamination(docs, bench).collect()}
    assert one == {1: (True, [(1, 1)]), 2: (True, [(1, 2)]), 3: (False, []), 4: (False, []), 5: (True, [(1, 2)])}
    monkeypatch.setattr(string_tiling, "PORTION", 20)  # a larger benchmark: several passes
    several = contamination(docs, bench).collect()
    assert {r["doc_id"]: r["contaminated"] for r in several} == {d: c for d, (c, _) in one.items()}


def test_awkward_documents_and_empty_tables(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, words("p", 45)), (1, words("p", 45))], "item_id long, text string")
    found = contamination(awkward.withColumn("items", awkward["n"]), bench).collect()
    assert {r["doc_id"] for r in found if r["contaminated"]} == {6, 7} and len(found) == awkward.count()
    assert contamination(nothing, bench).collect() == []
    assert not any(r["contaminated"] for r in contamination(awkward, bench.limit(0)).collect())


def test_pipeline_stages_take_effect(spark, tmp_path):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(5000)}"
    clean = {i: " ".join(word() for _ in range(90)) for i in range(300)}
    toxic = {1000 + i: " ".join([*(word() for _ in range(50)), "vile", "scum"]) for i in range(60)}
    copies = {2000 + i: clean[i] + " added" for i in range(10)} | {2100: clean[5]}
    passage, item = " ".join(word() for _ in range(60)), " ".join(word() for _ in range(40))
    sharing = {3000 + i: f"{' '.join(word() for _ in range(80))} {passage}" for i in range(8)}
    leaks = {4000 + i: f"{' '.join(word() for _ in range(60))} {item}" for i in range(1)}
    texts = clean | toxic | copies | sharing | leaks
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    rows += [(None, "a text without id", None, None, None), (5000, None, "en", "s", None), (5001, "", "en", None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    docs = spark.createDataFrame(rows, schema)
    folder = str(tmp_path)
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in texts if i % 3 or i in toxic], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    kept, stages = {}, dict(corpus_pipeline.STAGES)
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, folder)
        path = f"{folder}/{name}"
        current.write.parquet(path)
        current = spark.read.parquet(path)
        if name != "encoding":
            assert current.columns == docs.columns
        kept[name] = {r["doc_id"]: r for r in current.collect()}
    assert list(stages) == ["toxicity", "near_duplicates", "substrings", "decontamination", "encoding"]
    others = {None, 5000, 5001}
    assert set(kept["toxicity"]) == set(texts) - set(toxic) | others
    assert set(kept["near_duplicates"]) == set(clean) | set(sharing) | set(leaks) | others
    for i, r in kept["substrings"].items():
        if i in sharing:
            assert r["text"] == texts[i].removesuffix(" " + passage) and r["n_chars"] == len(r["text"])
        elif i in texts:
            assert r["text"] == texts[i]
    assert set(kept["decontamination"]) == set(clean) | set(sharing) | others
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in kept["encoding"].values())


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    for name, sql in llm_sql().items():
        result = con.execute(sql)
        columns = [d[0] for d in result.description]
        found = llm_queries()[name](spark, SMALL)
        assert sorted(found.columns) == sorted(columns)
        assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(result.fetchall(), key=repr), name


def test_one_of_equal_rows_keeps_its_text(spark, tmp_path):
    """Rows that repeat an id with its text are one document; rows without id, and empty texts, pass."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, "short text", "en", "a"), (None, None, None, None), (3, "", "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.substrings):
        docs = stage(spark, docs, str(tmp_path))
    got = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert got == sorted([(1, text), (2, "short text"), (None, None), (3, "")], key=repr)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), str(tmp_path)).count() == 0
