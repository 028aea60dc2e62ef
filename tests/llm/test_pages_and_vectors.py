from __future__ import annotations

import numpy as np
import pytest

from provwatch.llm import multi_index_hashing
from provwatch.llm.multi_index_hashing import nearest, substring_radii
from provwatch.llm.wrapper_induction import Aligned, Positions, _matching, align, block_nodes, extract, induce, infer, unite, wrappers

MIDDLE = "/root/testdata/sf0.01"

PAGE = (
    "<!DOCTYPE html><html><head><title>T {0}</title><style>p{{}}</style></head><body class='a b'><div class=\"cookie-notice\">We use"
    " cookies</div><header><h2>Site</h2></header><nav><ul>{1}</ul></nav><div id='sidebar'>Side {0}</div>"
    "<article><h1>Head&amp;line {0}</h1><p>First   <b>bo</b>ld {0}<br>next</p><script>if (a<b) x('</p>')</script>"
    "<p>Second &lt;b&gt; &#233; {0}</p><!-- no --><section class='comments'><p>reader {0}</p></section>{2}</article>"
    "<form><label>Mail</label><input></form><footer>&copy; {0}</footer></body></html>"
)


def page(i, links=2, more=""):
    return PAGE.format(i, "".join(f"<li><a href='/{k}'>l{k}</a></li>" for k in range(links)), more)


def text(i, more=""):
    return "\n".join([f"Head&line {i}", f"First bold {i} next", f"Second <b> é {i}", *([more] if more else [])])


def test_main_text_of_pages(spark):
    rows = [(i, "https://A.example/x", page(i, 1 + i % 3)) for i in range(12)]
    rows += [(20, "http://b.example", page(20)), (21, None, page(21)), (22, "http://b.example", None), (23, "http://c.example", "")]
    rows += [(24, "http://d.example", "no tags at &amp; all"), (25, "http://e.example/", page(25)[: page(25).index("</article>")])]
    rows += [(26, "https://a.example/y", page(26, 2, "<p>only here</p>")), (26, "https://a.example/y", page(26, 2, "<p>only here</p>"))]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    found = [(r["page_id"], r["text"], r["host"]) for r in extract(pages).collect()]
    expected = [(i, text(i), "z") for i in (*range(12), 20, 21, 25)]
    expected += [(22, "", "z"), (23, "", "z"), (24, "no tags at & all", "z"), *[(26, text(26, "only here"), "z")] * 2]
    assert sorted(found) == sorted(expected)


def test_pages_without_article_use_the_richest_part(spark):
    shape = "<body><div class='menu'>m</div><div class='box'><div>{0}</div></div><div class='note'>Always the same words</div></body>"
    rows = [(i, "http://h.example", shape.format(f"<p>{'word ' * 30}{i}</p><p>end {i}</p>")) for i in range(6)]
    found = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"{'word ' * 30}{i}\nend {i}" for i in range(6)}


def texts_of(spark, bodies):
    rows = [(i, "http://h.example", f"<body>{b}</body>") for i, b in enumerate(bodies)]
    return {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_template_text_inside_an_article_is_left_out(spark):
    found = texts_of(spark, [f"<article><p>Story {i}</p><p>Read more of our stories</p></article>" for i in range(6)])
    assert found == {i: f"Story {i}" for i in range(6)}


def test_a_rare_layout_of_a_large_host_is_covered(spark):
    usual = [f"<article><p>{'word ' * 40}{i}</p></article>" for i in range(60)]
    rare = [f"<div class='top'>Welcome</div><div class='story'><p>{'tale ' * 40}{i}</p></div>" for i in range(3)]
    found = texts_of(spark, usual + rare)
    assert [found[60 + i] for i in range(3)] == [f"{'tale ' * 40}{i}" for i in range(3)]
    assert found[7] == f"{'word ' * 40}7"


def test_a_text_of_one_page_is_no_constant(spark):
    bodies = [f"<div class='box'><h2>{'Conclusion' if i == 2 else f'Head {i}'}</h2><p>{'word ' * 9}{i}</p></div>" for i in range(6)]
    bodies[4] = bodies[4].replace("</p>", "</p><p>A single line</p>")
    found = texts_of(spark, bodies)
    assert found[2] == f"Conclusion\n{'word ' * 9}2" and found[4].endswith("\nA single line")


def test_an_optional_constant_of_the_wrapper_is_left_out(spark):
    """On a third of all pages, in one path with varying texts: only the aligned position tells it from text."""
    promo = "<h3>Download our app</h3>"
    bodies = [f"<article><h1>Head {i}</h1>{promo if i % 3 == 0 else ''}<p>Story {i}</p></article>" for i in range(30)]
    assert texts_of(spark, bodies) == {i: f"Head {i}\nStory {i}" for i in range(30)}
    few = [b if i < 6 else b.replace(promo, "") for i, b in enumerate(bodies)]  # on two pages
    assert "Download" in texts_of(spark, few)[0]


def test_blocks_fall_on_positions_of_the_wrapper():
    bodies = [f"<div><h1>H{i}</h1>{'<h3>S</h3>' if i else ''}<p>a</p><p>b{i}</p></div>" for i in range(3)]
    at = [Positions(induce(bodies)).of(block_nodes(b)) for b in bodies]
    assert at[1] == at[2] and at[0][0] == at[1][0] and at[0][1] == at[0][2] == at[1][2] == at[1][3]
    assert len(set(at[1].values())) == 3 and Positions([]).of(block_nodes(bodies[0])) == {}


def test_every_page_of_a_host_shapes_its_wrapper(spark):
    """Of 24 pages a host 7 have the optional constant; whichever pages come first, it has a position."""
    promo = "<h3>Download our app</h3>"
    shape = "<body><article><h1>Head {0}</h1>{1}<p>Story {0}</p></article></body>"
    rows = [(100 * h + i, f"http://h{h}.example/{i}", shape.format(f"{h} {i}", promo if i < 7 else "")) for h in range(100) for i in range(24)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert found == {100 * h + i: f"Head {h} {i}\nStory {h} {i}" for h in range(100) for i in range(24)}


def test_wrappers_are_of_all_pages_and_of_whole_pages(spark):
    many = "".join(f"<i class='k{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}'>x</i>" for i in range(1400))
    rows = [(i, "http://h.example", f"<body>{many}<h5>End {i}</h5>{'<h6>Late</h6>' if i > 20 else ''}</body>") for i in range(30)]
    row = wrappers(spark.createDataFrame(rows, "page_id long, url string, html string")).first()
    assert row["pages"] == 30 and row["expression"].endswith("<h5>#</h5>(<h6>)?(Late)?(</h6>)?</body>")


def test_wrappers_of_parts_become_one():
    a, b, c = ["tag", "a"], ["tag", "b"], ["tag", "c"]
    left, right = Aligned([a, ["opt", [b]]], [40, 4], 40), Aligned([a, b, c], [30, 30, 1], 30)
    found = unite([left, right])
    assert found == Aligned([a, ["opt", [b]]], [70, 34], 70)  # c is on one of 70 pages
    assert unite([Aligned([a, b], [1, 1], 1), Aligned([], [], 1)]).pages == 2


def test_long_lists_match_as_short_ones_do():
    rng = np.random.default_rng(5)
    a = [int(x) for x in rng.integers(0, 900, 3000)]
    b = [x for x in a if x % 7] + a[:5]
    found = _matching(a, b)
    assert sum(n for _, _, n in found) > 0.95 * (len(b) - 5)
    ends = [(i + n, j + n) for i, j, n in found]
    assert all(a[i : i + n] == b[j : j + n] for i, j, n in found)
    assert all(p <= i and q <= j for (p, q), (i, j, _) in zip(ends, found[1:]))


def test_copies_of_a_page_keep_their_text(spark):
    found = texts_of(spark, [f"<nav>{i}</nav><article><p>The same story</p></article>" for i in range(9)])
    assert set(found.values()) == {"The same story"}


def test_wrapper_has_slots_optionals_and_repeats():
    found = infer([page(i, 2 + i) for i in range(3)] + [page(9, 2, "<p>extra</p>")])
    assert "(<li><a>#</a></li>)+" in found["expression"] or "(<li><a>l0</a></li>)+" in found["expression"]
    assert "<h1>#</h1>" in found["expression"] and ")?" in found["expression"]


def test_alignment_makes_one_sided_tokens_optional():
    a, b = ["tag", "a"], ["tag", "b"]
    assert align([a, b], [a]) == [a, ["opt", [b]]]
    assert align([a], [a, b]) == [a, ["opt", [b]]]
    assert align([["rep", [a, b]]], [a, b]) == [["rep", [a, b]]]


def test_generated_pages(spark):
    import html
    import re

    pages = spark.read.parquet(f"{MIDDLE}/pages.parquet")
    for r in extract(pages).collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        assert r["text"] == "\n".join(p for p in parts if p)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(none).collect() == [] and wrappers(none).collect() == []


# --- vectors ------------------------------------------------------------------------------------------------------


def brute(rows, queries, k):
    rows = {(i, tuple(v)) for i, v in rows}
    out = []
    for qi, q in queries:
        q = np.array(q, float)
        scored = []
        for i, v in rows:
            if i != qi:
                v = np.array(v, float)
                scored.append((-float(q @ v / np.sqrt(q @ q) / np.sqrt(v @ v)), i))
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_radii_cover_the_pigeonhole():
    for m in (8, 16, 32):
        for radius in range(0, 8 * m):
            r = substring_radii(radius, m)
            assert (r + 1).sum() == radius + 1  # one bit more than fits outside all radii


def test_ties_copies_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(multi_index_hashing, "CELL_ROWS", 3)
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=12).round(2).tolist()) for i in range(60)]
    good += [(100 + i, good[3][1]) for i in range(20)] + [(7, good[7][1])]
    bad = [(201, None), (202, [0.0] * 12), (203, [float("nan")] * 12), (204, [None] + [1.0] * 11), (205, [float("inf")] * 12)]
    bad += [(206, []), (207, [1.0]), (None, [1.0] * 12)]
    rows = [(i, v, "x", 5) for i, v in good + bad]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string, group int")
    found = nearest(vectors, vectors.where("vec_id % 10 = 3 or vec_id > 200"), k=5).collect()
    expected = brute(good, [(i, v) for i, v in good if i % 10 == 3], 5)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in expected])


def test_fewer_candidates_than_asked_for(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.6, 0.8]), (51, [0.0, -1.0])], "vec_id long, embedding array<float>")
    found = nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [(0, 1, 50), (0, 2, 51), (50, 1, 0), (50, 2, 51)]
    assert nearest(vectors.limit(0), vectors.limit(0)).collect() == []
    assert nearest(vectors.where("vec_id = 0"), vectors.where("vec_id = 0")).collect() == []


def test_recall_on_generated_vectors(spark):
    vectors = spark.read.parquet(f"{MIDDLE}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    expected = {(q, i) for q, _, i, _ in brute(rows, [r for r in rows if r[0] % 50 == 0], 5)}
    found = {(r["query_id"], r["vec_id"]) for r in nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()}
    assert len(found & expected) >= 0.9 * len(expected)


def test_outsiders_of_a_cluster_find_their_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 32))
    x[:1000] = x[0] + 0.05 * x[:1000]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = [r for r in rows if r[0] >= 1000 and r[0] % 50 == 0]
    expected = {(q, i) for q, _, i, _ in brute(rows, asked, 5)}
    found = nearest(vectors, vectors.where("vec_id >= 1000 and vec_id % 50 = 0"))
    assert len({(r["query_id"], r["vec_id"]) for r in found.collect()} & expected) >= 0.9 * len(expected)


def test_reranked_codes_grow_with_the_table_and_radii_differ():
    assert multi_index_hashing.wanted(1_000) == 384 and multi_index_hashing.wanted(1_000_000) == 3_000
    near, far = np.arange(4000) // 100, 60 + np.arange(4000) // 100
    first = [multi_index_hashing.first_radius(a, 1_000_000, 3_000, 256) for a in (near, far)]
    assert first[1] == first[0] + 60 and multi_index_hashing.first_radius(near, 300, 384, 256) == 256


def test_members_of_a_cluster_find_their_neighbours(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 64))
    x[:2000] = rng.normal(size=64) + 0.3 * x[:2000]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["vec_id"]) for r in nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for some in (range(0, 2000, 50), range(2000, 6000, 50)):
        close = unit[list(some)] @ unit.T
        close[np.arange(len(some)), list(some)] = -2
        expected = {(q, int(v)) for q, row in zip(some, close, strict=True) for v in np.argsort(-row)[:5]}
        assert len(expected & found) >= 0.95 * len(expected)


def test_dense_regions_of_a_sample():
    rng = np.random.default_rng(2)
    even = rng.normal(size=(3000, 64))
    assert multi_index_hashing.dense_regions(multi_index_hashing._unit(even)) == []
    mixed = even.copy()
    mixed[:1000] = even[0] + 0.2 * even[:1000]
    mixed[1000:1600] = even[1] + 0.2 * even[1000:1600]
    first, second = multi_index_hashing.dense_regions(multi_index_hashing._unit(mixed))
    for found, members in ((first, range(1000)), (second, range(1000, 1600))):  # cells may share out a few rows
        assert len(np.intersect1d(found, members)) >= 0.99 * max(len(found), len(members))


def test_extreme_components_and_several_dimensions(spark):
    rows = [
        (0, [1e200, 0.0]),
        (1, [1.0, 0.0]),
        (2, [1e-200, 1e-200]),
        (3, [5e-324, 0.0]),
        (4, [0.0, 0.0]),
        (5, [1.0, 0.0, 0.0]),
        (6, [1.0, 1.0, 0.0]),
        (7, [3.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in nearest(vectors, vectors, k=2).collect()}
    half = pytest.approx(0.5**0.5)
    assert found == {
        (0, 1): (1, 1.0),
        (0, 2): (3, 1.0),
        (1, 1): (0, 1.0),
        (1, 2): (3, 1.0),
        (2, 1): (0, half),
        (2, 2): (1, half),
        (3, 1): (0, 1.0),
        (3, 2): (1, 1.0),
        (5, 1): (6, half),
        (6, 1): (5, half),
    }
