from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from provwatch.llm import language_ppm, lattice_lm, toxicity_neighbours
from provwatch.llm.holding_out import held_out
from provwatch.llm.queries import llm_queries
from provwatch.llm.tokenizers_public import TokenizerFile, public_path
from tests.conftest import SMALL
from tests.llm.test_dedup import FOLD

MIDDLE = "/root/testdata/sf0.01"


# --- language: partial matching -----------------------------------------------------------------------------------


def brute_bits(samples, text):
    """Code length by dictionaries, one byte at a time."""
    counts = {}
    for sample in samples:
        data = b"\0\0\0" + sample.translate(FOLD).encode()
        for i in range(3, len(data)):
            for k in range(4):
                counts.setdefault(data[i - k : i], Counter())[data[i]] += 1
    data, bits = b"\0\0\0" + text.translate(FOLD).encode(), 0.0
    for i in range(3, len(data)):
        for k in (3, 2, 1, 0):
            seen = counts.get(data[i - k : i], {})
            n, t = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits += math.log2((n + t) / seen[data[i]])
                break
            if t:
                bits += math.log2((n + t) / t)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    taught = [("xx", "abracadabra ABRA"), ("xx", "a b c"), ("yy", "lorem ipsum dolor"), ("yy", "dolor sit Amet é"), ("zz", None)]
    trees = language_ppm.train(spark.createDataFrame(taught, "lang string, text string"))
    assert trees.languages == ["xx", "yy"]
    import pyarrow as pa

    from provwatch.llm.blocks import blocks

    texts = ["abra dolor", "Ünknown é", "", "a", "ipsum ipsum"]
    lengths = trees.lengths(next(blocks(pa.array(texts))))
    for text, found in zip(texts, lengths, strict=True):
        for lang, bits in zip(trees.languages, found, strict=True):
            assert bits == pytest.approx(brute_bits([t for x, t in taught if x == lang], text)), (text, lang)


def test_languages_of_awkward_and_missing_texts(awkward, nothing):
    found = language_ppm.predict(awkward, language_ppm.train(awkward)).collect()
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1 and r["n"] == 1
    untaught = language_ppm.predict(awkward, language_ppm.train(nothing)).collect()
    assert {(r["lang_pred"], r["score"]) for r in untaught} == {("und", 0.0)}
    assert language_ppm.predict(nothing, language_ppm.train(awkward)).collect() == []


def test_language_accuracy_on_held_out_documents(spark):
    found = llm_queries()["op6_language_ppm"](spark, MIDDLE)
    truth = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    row = found.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()
    assert row[0] > 0.99


# --- language model -----------------------------------------------------------------------------------------------


def all_paths(lattice, text):
    """Probability of a word by enumerating segmentations."""
    weight = dict(zip(lattice.pieces, np.exp(lattice.weights), strict=True))
    ways = [1.0]
    for j in range(1, len(text) + 1):
        ways.append(sum(ways[i] * weight.get(text[i:j], 0.0) for i in range(j)))
    return math.log(ways[-1])


@pytest.fixture(scope="module")
def model():
    return TokenizerFile.read(public_path("piece_bpe_32k.model"))


def test_marginal_probability_sums_all_segmentations(model):
    lattice = lattice_lm.Lattice.of_model(model)
    types = [b"the", b"therefore", "über".encode(), b"q", b"zzzzzz", b"a" * 60, "梦x".encode()]
    found, expected = lattice.log_probabilities(types, np.ones(len(types)))
    for w, p in zip(types, found, strict=True):
        assert p == pytest.approx(all_paths(lattice, b" " + w), rel=1e-9)
    # every byte of every word is covered once by the expected pieces
    assert (expected * [len(p) for p in lattice.pieces]).sum() == pytest.approx(sum(len(w) + 1 for w in types))


def brute_base(rows):
    words = {i: (t or "").translate(FOLD).encode().split() + [None] for i, (_, t, _) in enumerate(rows)}
    c = Counter(w for i, (_, _, taught) in enumerate(rows) if taught for w in words[i])
    n, v = sum(c.values()), len(c)
    return {
        i: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in words.items()
    }


@pytest.mark.parametrize("frequent", [3, 100_000])
def test_base_scores_of_awkward_documents(awkward, model, monkeypatch, frequent):
    monkeypatch.setattr(lattice_lm, "FREQUENT", frequent)
    docs = awkward.withColumn("taught", ~held_out(F.col("doc_id"), 7, 2)).withColumn("base", F.lit("kept"))
    expected = sorted(brute_base([(r["doc_id"], r["text"], r["taught"]) for r in docs.collect()]).values())
    found = lattice_lm.score_texts(docs, model, rounds=1).collect()
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in expected])
    assert all(r["score"] < 0 and r["piece_score"] < 0 and r["base"] == "kept" for r in found)


def test_pieces_and_their_rounds_decide_the_score_of_unseen_words(spark, model):
    """Two texts of one unseen word each, one in taught spelling: the base cannot tell them apart."""
    taught = [(k, f"station{a} nation{a} {a}ation ration relation {b}tion", True) for k, (a, b) in enumerate(zip("abcdefgh", "klmnopqr"))]
    docs = spark.createDataFrame([*taught, (100, "elation", False), (101, "xqzvkjw", False)], "doc_id long, text string, taught boolean")
    scores = {}
    for rounds in (0, 2):
        found = {r["doc_id"]: r for r in lattice_lm.score_texts(docs, model, rounds=rounds).collect()}
        assert found[100]["base_score"] == found[101]["base_score"] and found[100]["n_known"] == 1
        likelier = found[100]["piece_score"] - found[101]["piece_score"]
        assert found[100]["score"] - found[101]["score"] > 0.1 * likelier > 0.3
        assert all(r["score"] < 0 for r in found.values())
        scores[rounds] = found[100]["score"] - found[101]["score"]
    assert abs(scores[2] - scores[0]) > 0.2


def test_nothing_to_learn_from(awkward, nothing, model):
    found = lattice_lm.score_texts(awkward.withColumn("taught", F.lit(False)), model).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in found} == {(0, 0)} and all(math.isfinite(r["score"]) for r in found)
    assert lattice_lm.score_texts(nothing.withColumn("taught", F.lit(True)), model).collect() == []


# --- toxicity -----------------------------------------------------------------------------------------------------


def test_block_search_equals_full_search():
    rng = np.random.default_rng(2)
    idf = rng.uniform(0.5, 4, 40)
    terms = [np.sort(rng.choice(40, rng.integers(0, 6), replace=False)) for _ in range(900)]
    tf = [rng.integers(1, 4, len(t)) for t in terms]
    firsts = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
    toxic = (rng.random(900) < 0.3).astype(int)
    index = toxicity_neighbours.BlockMaxIndex.build(
        np.arange(900), toxic, firsts, np.concatenate(terms), np.concatenate(tf), idf, {0: 1.0, 1: 1.0}
    )
    assert index.labels.sum() == sum(len(t) > 0 for t in terms)
    dense = np.zeros((len(index), 40))
    for i in range(len(index)):
        t, w = index.vector(i)
        dense[i, t] = w
    for _ in range(200):
        terms = np.sort(rng.choice(40, rng.integers(1, 5), replace=False))
        t, w = index.unit(terms, rng.integers(1, 3, len(terms)), idf)
        near, cosine = index.nearest(t, w, 10)
        scores = dense[:, t] @ w
        best = sorted(-scores[scores > 0])[:10]
        assert sorted(-cosine) == pytest.approx(best) and scores[near] == pytest.approx(cosine)


def test_toxicity_on_held_out_documents(spark):
    found = llm_queries()["op5_toxicity_neighbours"](spark, MIDDLE)
    truth = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    hits = [r["predicted"] for r in rows if r["toxic"]]
    assert right > 0.93 and sum(hits) / len(hits) > 0.6
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_toxicity_of_awkward_and_missing_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, int(i == 5)) for i in range(1, 12)] + [(None, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity_neighbours.fit(awkward, labels)
    found = toxicity_neighbours.score_texts(awkward, model).collect()
    assert len(found) == awkward.count() and all(0 <= r["score"] <= 1 and r["row_key"] == "x" for r in found)
    empty = toxicity_neighbours.fit(nothing, nothing)
    assert {r["predicted"] for r in toxicity_neighbours.score_texts(awkward, empty).collect()} == {0}
    assert toxicity_neighbours.score_texts(nothing, empty).collect() == []


def test_marked_words_decide_with_evidence(spark):
    rows = [(i, f"calm text number n{i} " + ("vile words here" if i % 3 == 0 else "kind words here")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 240)], "doc_id long, toxic int")
    found = toxicity_neighbours.score_texts(docs, toxicity_neighbours.fit(docs, labels)).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in found)
    assert all(r["evidence"][0]["toxic"] == 1 for r in found if r["predicted"])


def test_an_example_without_marking_words_is_found(spark):
    rows = [(i, f"plain page n{i} about item w{i % 7}") for i in range(60)] + [(100, "rare phrase of one bad row"), (101, "rare phrase of one bad row")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(60)] + [(100, 1)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity_neighbours.score_texts(docs, toxicity_neighbours.fit(docs, labels)).collect()}
    best = found[101]["evidence"][0]
    assert (best["doc_id"], best["toxic"]) == (100, 1) and best["cosine"] == pytest.approx(1.0)


def test_small_tables_pass(spark):
    for name in ("op5_toxicity_neighbours", "op7_lattice_lm"):
        assert llm_queries()[name](spark, SMALL).count() == 200


def test_held_out_texts_score_above_the_base(spark):
    found = llm_queries()["op7_lattice_lm"](spark, MIDDLE).where("held_out")
    row = found.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.max("score").alias("m")).first()
    assert row["s"] > row["b"] and row["m"] < 0
