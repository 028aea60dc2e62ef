from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from provwatch.llm import bottom_k_dedup
from provwatch.llm.blocks import blocks, range_hashes, word_hashes, words
from provwatch.llm.bottom_k_dedup import near_duplicates
from provwatch.llm.substring_anchors import COVER, PERIOD, remove_repeats
from tests.conftest import SMALL

FOLD = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text, width):
    w = (text or "").translate(FOLD).encode().split()
    return {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()


def expected_groups(rows, width, percent=80):
    """Components of (doc_id, text) by all pairs."""
    sets = [(d, shingles(t, width)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            smallest[find(i)] = min(smallest.get(find(i), d), d)
    return sorted(((d, len(s), smallest.get(find(i)), d is not None and smallest.get(find(i)) == d) for i, (d, s) in enumerate(sets)), key=repr)


def variants(rng, base, many, edits):
    out = []
    for _ in range(many):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_components_of_groups_and_common_passages(spark, rows, monkeypatch):
    monkeypatch.setattr(bottom_k_dedup, "FREQUENT", 3)  # so that small groups take the way of frequent values
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = " ".join(word() for _ in range(60))
    texts = variants(rng, " ".join(word() for _ in range(150)), 40, 9)
    texts += variants(rng, " ".join(word() for _ in range(40)), 15, 2)
    texts += [passage + " " + " ".join(word() for _ in range(20)) for _ in range(25)]
    texts += [" ".join(word() for _ in range(5)) for _ in range(10)] + texts[:5]
    rng.shuffle(texts)
    data = list(enumerate(texts))
    found = rows(near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), shingle=4))
    assert found == expected_groups(data, 4)


def test_awkward_documents_are_grouped(awkward, rows):
    data = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    found = rows(near_duplicates(awkward, shingle=5))
    expected = expected_groups(data, 5)
    # a row without id is linked with an equal text's class and never kept
    assert found == expected
    assert (None, 5, 14, False) in found


def test_no_documents_no_groups(nothing):
    assert near_duplicates(nothing).collect() == []
    assert remove_repeats(nothing).collect() == []


def expected_cut(texts, window=35):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        cut = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                cut[i : i + window] = [True] * window
        out.append((len(w), sum(cut), b" ".join(x for x, c in zip(w, cut, strict=True) if not c).decode()))
    return out


def test_cover_holds_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_every_alignment_of_a_repeated_window_is_found(spark):
    base = [f"b{i}" for i in range(34 + 26)]
    data = []
    for k in range(26):  # the passage begins at every remainder of the period, in both texts
        data.append((2 * k, " ".join([f"l{k}_{i}" for i in range(k)] + [f"{w}_{k}" for w in base[:35]] + ["end"])))
        data.append((2 * k + 1, " ".join([f"r{k}_{i}" for i in range(7 * k)] + [f"{w}_{k}" for w in base[:35]])))
    cut = remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert all(r["n_removed"] == 35 for r in cut)


def test_windows_of_34_words_stay(spark):
    passage = " ".join(f"p{i}" for i in range(34))
    data = [(1, f"a {passage} b"), (2, f"c {passage} d")]
    assert {r["n_removed"] for r in remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()} == {0}


def test_awkward_documents_are_cut(awkward):
    texts = [r["text"] for r in awkward.collect()]
    found = remove_repeats(awkward, keep=("doc_id", "row_key", "text")).collect()
    assert sorted((r["n_words"], r["n_removed"], r["kept_text"]) for r in found) == sorted(expected_cut(texts))
    for r in found:
        words = (r["text"] or "").encode().split()
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and len(words) == r["n_words"]


def test_generated_documents_are_cut(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [r["text"] for r in docs.collect()]
    found = remove_repeats(docs).collect()
    assert sorted((r["n_words"], r["n_removed"], r["kept_text"]) for r in found) == sorted(expected_cut(texts))


def test_windows_shorter_than_two_periods_are_refused(nothing):
    with pytest.raises(ValueError):
        remove_repeats(nothing, window=10)


def test_hashing_a_block_takes_memory_for_a_part_of_it():
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 5_000, 40_000))) for _ in range(9)]
    (block,) = blocks(pa.array(texts), 1 << 22)
    found = words(block)
    word_hashes(block, found, fold=True)
    tracemalloc.start()
    hashes = word_hashes(block, found, fold=True)
    windows = range_hashes(hashes, np.arange(len(hashes) - 35), np.arange(35, len(hashes)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(block.data) + hashes.nbytes + windows.nbytes  # one number a byte, where six were held at once
    # equal sequences have equal hashes wherever they stand, and only they
    assert len(set(zip(" ".join(texts).split(), hashes.tolist(), strict=True))) == len(np.unique(hashes)) == 5_000
    at = rng.integers(0, len(windows), 500)
    assert all(range_hashes(hashes[a : a + 35], np.array([0]), np.array([35]))[0] == windows[a] for a in at)
