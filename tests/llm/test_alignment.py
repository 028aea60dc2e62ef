from __future__ import annotations

import bisect
import hashlib
from collections import Counter

import numpy as np
import pytest

from provwatch.llm import cross_tokenizer_alignment as cta
from provwatch.llm.queries import op11_lockstep_alignment
from provwatch.llm.tokenizers_public import TokenizerFile, public_path


@pytest.fixture(scope="module")
def files():
    return TokenizerFile.read(public_path("byte_bpe_50k.json")), TokenizerFile.read(public_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def sides(files):
    return tuple(cta.side(f.kind, f.content) for f in files)


def brute(sides, text):
    """Ids, links and groups from whole encodings and byte ranges, every pair of tokens compared near the pointer."""
    nothing = [], [], [], []
    if not text:
        return nothing
    ids = [s.encode([text])[0] for s in sides]
    if any(b"".join(s.pieces[i] for i in row) != f" {text}".encode() for s, row in zip(sides, ids)):
        return nothing
    ends = [np.cumsum([len(s.pieces[i]) for i in row]).tolist() for s, row in zip(sides, ids)]
    ranges = [[(a, b) for a, b in zip([0, *e[:-1]], e)] for e in ends]
    links, lo = [], 0
    for i, (s, e) in enumerate(ranges[0]):
        while ranges[1][lo][1] <= s:
            lo += 1
        first = lo
        while lo < len(ids[1]) and ranges[1][lo][0] < e:
            links.append((i, lo))
            lo += 1
        lo = first
    groups, at = [], (0, 0)
    for cut in sorted(set(ends[0]) & set(ends[1])):
        upto = tuple(bisect.bisect_right(e, cut) for e in ends)
        groups.append([row[a:b] for row, a, b in zip(ids, at, upto)])
        at = upto
    return ids[0], ids[1], links, groups


def expected_report(sides, rows):
    found = [(d, brute(sides, t)) for d, t in rows]
    counts = Counter((a[i], b[j]) for _, (a, b, links, _) in found for i, j in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for d, (a, b, links, groups) in found:
        pairs = [(a[i], b[j]) for i, j in links]
        text = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        out.append(
            (
                d,
                len(a),
                len(b),
                len(groups),
                len(links),
                sum(counts[p] == best[p[1]] for p in pairs),
                sum(counts[p] for p in pairs),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return sorted(out, key=repr)


ODD = ["", " ", "  a", "x  y▁ z", "▁a", "a ▁", "▁", "<s> <|endoftext|> x", "é　x \x1c y  \n z", "don't  we'll\n\n x", "a \x00 b", "tail ", "ﬁ é é"]


def test_segments_give_the_tokens_of_whole_texts(sides):
    tool = cta.Aligner(*sides, memo=50)
    assert tool.cuts
    texts = [None, *ODD, "a" * 3000, "Ünï çödé 梦 😀 " * 300]
    for _ in range(2):  # the second time from memory, or after it was dropped
        found = tool.align(texts)
        digits = cta._decimals(max(len(s.pieces) for s in sides))
        written = cta.group_texts(found, *digits)
        for k, text in enumerate(texts):
            a, b, links, groups = brute(sides, text)
            mine = slice(found.a_first[k], found.a_first[k + 1])
            assert found.a_ids[mine].tolist() == a
            assert found.b_ids[found.b_first[k] : found.b_first[k + 1]].tolist() == b
            held = (found.link_a >= mine.start) & (found.link_a < mine.stop)
            got = zip(found.link_a[held] - found.a_first[k], found.link_b[held] - found.b_first[k])
            assert sorted(got) == links
            assert written[k].decode() == ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)


@pytest.mark.parametrize("lane", [1, 2, 3, 1000])
def test_lanes_emit_each_link_once(lane):
    rng = np.random.default_rng(lane)
    for _ in range(50):
        sizes = [rng.integers(0, 40) for _ in range(5)]
        a, b, first, base = [], [], [0], 0
        for n in sizes:
            cuts = [sorted({base + int(x) for x in rng.integers(1, n + 1, rng.integers(0, n + 1))} | {base + n}) if n else [] for _ in "ab"]
            a, b, base = a + cuts[0], b + cuts[1], base + n
            first.append(len(a))
        la, lb, ca, cb = cta.lockstep(np.array(a, np.int64), np.array(b, np.int64), np.array(first), lane)
        spans = [list(zip([0, *e[:-1]], e)) for e in (a, b)]
        want = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, u) in enumerate(spans[1]) if max(s, t) < min(e, u)]
        assert sorted(zip(la.tolist(), lb.tolist())) == want
        assert [x for x, c in zip(a, ca) if c] == sorted(set(a) & set(b)) == [x for x, c in zip(b, cb) if c]


def test_report_against_brute_force(spark, files, sides, awkward, rows, monkeypatch):
    got = rows(cta.alignment_report(awkward, *files))
    assert got == expected_report(sides, [(r.doc_id, r.text) for r in awkward.collect()])
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD * 3)], "doc_id long, text string").repartition(5)
    assert rows(cta.alignment_report(odd, *files)) == expected_report(sides, list(enumerate(ODD * 3)))


def test_query_over_whole_table(spark, sides, rows):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert rows(op11_lockstep_alignment(spark, folder)) == expected_report(sides, [tuple(r) for r in docs])


def test_links_and_cuts_of_every_row(spark, files, sides, awkward):
    out = cta.align_texts(awkward, *files).collect()
    assert len(out) == awkward.count()
    assert out[0].asDict().keys() >= {"row_key", "n", "score", "id"}
    for r in out:
        a, b, links, groups = brute(sides, r.text)
        assert (r.a_ids, r.b_ids) == (a, b)
        assert list(zip(r.link_a, r.link_b)) == links
        assert (r.cut_a, r.cut_b) == tuple(np.cumsum([len(g[k]) for g in groups]).tolist() for k in (0, 1))


def test_nothing(files, nothing):
    assert cta.alignment_report(nothing, *files).count() == 0
    assert cta.align_texts(nothing, *files).count() == 0
