from __future__ import annotations

import random
import time

import numpy as np
import pytest
import sentencepiece

from provwatch.llm import sentencepiece_viterbi
from provwatch.llm.sentencepiece_viterbi import Encoder, StreamingViterbi, Vocabulary, encode_texts, search_lanes
from provwatch.llm.token_count_cache import cached_counts, token_counts
from provwatch.llm.tokenizers_public import TokenizerFile, public_path


@pytest.fixture(scope="module")
def model():
    return TokenizerFile.read(public_path("piece_bpe_32k.model"))


def random_vocabulary(rng, letters):
    pieces = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 14))}
    ids = {p: 256 + i for i, p in enumerate(sorted(pieces))}
    return Vocabulary.of(ids, {p: float(-rng.randint(1, 30)) for p in ids}, list(range(256)))


def path_score(v, ids):
    """Sum of scores of an encoding; a character in bytes counts once."""
    names, total, pending = {i: p for p, i in v.ids.items()}, 0.0, b""
    for i in ids:
        if i in names:
            total += v.scores[names[i]]
            continue
        pending += bytes([i])
        try:
            pending.decode()
        except UnicodeDecodeError:
            continue
        total, pending = total + v.unknown, b""
    return total


def best_score(v, text):
    best = [0.0]
    for j in range(1, len(text) + 1):
        arcs = [best[i] + v.scores[text[i:j]] for i in range(max(0, j - v.longest), j) if text[i:j] in v.scores]
        best.append(max([best[j - 1] + v.unknown, *arcs]))
    return best[-1]


@pytest.mark.parametrize("letters", ["ab c", "abc", "a b c d", "ab"])
def test_best_segmentation_and_round_trip(letters):
    rng = random.Random(letters)
    for _ in range(300):
        v = random_vocabulary(rng, letters)
        text = "".join(rng.choice(letters + "é😀") for _ in range(rng.randint(1, 60)))
        ids = Encoder(v).encode(text)
        assert path_score(v, ids) == pytest.approx(best_score(v, " " + text))
        assert Encoder(v).decode(ids) == text


def test_ids_are_committed_early_and_do_not_depend_on_portions():
    rng = random.Random(3)
    for _ in range(100):
        v = random_vocabulary(rng, "abc")
        text = "".join(rng.choice("abc") for _ in range(400))
        whole = StreamingViterbi(v)
        expected = [*whole.feed(text), *whole.finish()]
        parts, out, kept = StreamingViterbi(v), [], []
        for at in range(0, len(text), 3):
            out += parts.feed(text[at : at + 3])
            kept.append(len(parts.text))
        assert path_score(v, out + [*parts.finish()]) == pytest.approx(path_score(v, expected))
        assert sorted(kept)[len(kept) // 2] < 40  # the window stays near the longest piece


def test_texts_round_trip(awkward, model):
    rows = encode_texts(awkward, model).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert (r["decoded"] == r["text"]) and r["n_ids"] == len(r["ids"]) and (r["n_ids"] > 0) == bool(r["text"])
        assert r["row_key"] == "x" and r["score"] == 0.5


def test_counts_are_the_librarys(awkward, model, tmp_path):
    library = sentencepiece.SentencePieceProcessor(model_proto=model.content)
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.collect()}
    found = token_counts(awkward, model, f"{tmp_path}/cache", limit=100).collect()
    assert len(found) == awkward.count()
    for r in found:
        text = texts[r["doc_id"]]
        assert r["n_tokens"] == len(library.encode(text)) and r["n_bytes"] == len(text.encode())
        assert r["over_limit"] == (r["n_tokens"] > 100)


def test_only_distinct_misses_are_encoded(spark, model, tmp_path):
    cache = f"{tmp_path}/cache"
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    token_counts(first, model, cache).collect()
    assert spark.read.parquet(cache).count() == 2
    token_counts(first.union(spark.createDataFrame([(4, "new")], first.schema)), model, cache).collect()
    assert spark.read.parquet(cache).count() == 3
    other = TokenizerFile.read(public_path("byte_bpe_50k.json"))
    assert cached_counts(spark, cache, other).count() == 0
    counts = token_counts(first, other, cache).collect()
    assert spark.read.parquet(cache).count() == 5 and {r["n_tokens"] for r in counts} == {1, 2}


def test_empty_tables(nothing, model, tmp_path):
    assert token_counts(nothing, model, f"{tmp_path}/cache").collect() == []
    assert encode_texts(nothing, model).collect() == []


def test_segments_searched_at_once_have_the_ids_of_the_streaming_search():
    rng = random.Random(5)
    for letters in ("abc", "abé漢", "aé😀\t"):
        for _ in range(100):
            v = random_vocabulary(rng, letters)
            segments = sorted(("".join(rng.choice(letters + "zß") for _ in range(rng.randint(1, 30))) for _ in range(40)), key=len)
            for segment, ids in zip(segments, search_lanes(v, segments), strict=True):
                alone = StreamingViterbi(v)
                assert [*np.frombuffer(ids, np.int32)] == [*alone.feed(segment), *alone.finish()]


def test_a_forgotten_segment_gives_the_same_ids(model, monkeypatch):
    texts = [" ".join(f"w{i * j % 97}é" for j in range(60)) for i in range(40)]
    expected = [*map(Encoder(Vocabulary.of_model(model.content)).encode, texts)]
    monkeypatch.setattr(sentencepiece_viterbi, "MEMO", 50)
    tool = Encoder(Vocabulary.of_model(model.content))
    assert [x.tolist() for part in (texts[:15], texts[15:]) for x in tool.encode_all(part)] == expected


def test_different_words_are_encoded_faster_than_one_after_the_other(model):
    rng = random.Random(8)
    v = Vocabulary.of_model(model.content)
    Encoder(v).encode("x")  # its tree is built with the first search
    words = ["".join(rng.choice("abcdeinorstué") for _ in range(10)) for _ in range(30_000)]
    start = time.process_time()
    ids = Encoder(v).encode(" ".join(words))
    together = time.process_time() - start
    start, one_by_one = time.process_time(), []
    for word in words:
        search = StreamingViterbi(v)
        one_by_one += [*search.feed(" " + word), *search.finish()]
    assert ids == one_by_one
    assert together * 2 < time.process_time() - start
