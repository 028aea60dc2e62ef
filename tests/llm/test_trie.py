from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from provwatch.llm import conversation_trie as ct
from provwatch.sources.sinks import work_folder


def brute(rows, share):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:30]
            own.setdefault(c, []).append(((turn is not None, turn), digest, role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in own.items()}
    if share:
        base = own
        own = {}
        for c, ts in base.items():
            h = zlib.crc32(str(c).encode()) % 6
            source = base.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
            own[c] = source[:h] + ts[h:]
    nodes, ends = {}, {}
    for c, ts in own.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
        ends.setdefault(tuple(ts), []).append(c)
    children, leaves, saved = {k: 0 for k in nodes}, {k: 0 for k in nodes}, {k: 0 for k in nodes}
    for key, members in nodes.items():
        if key:
            children[key[:-1]] += 1
    for key, members in nodes.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += children[key] == 0
            saved[key[:d]] += (len(members) - 1) * (len(key[-1][1]) if key else 0)
    return sorted(
        (
            (
                min(members),
                len(key),
                min(nodes[key[:-1]]) if key else None,
                len(members),
                children[key],
                leaves[key],
                saved[key],
                hashlib.sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest(),
            )
            for key, members in nodes.items()
        ),
        key=repr,
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int").repartition(3)


ODD = [
    (0, 0, "user", "hi"),
    (0, 1, "bot", "ho"),
    (0, 1, "bot", "another turn of equal number"),
    (0, None, "user", "first"),
    (0, None, None, None),
    (1, 0, "user", "hi"),
    (2, 0, "user", "hi"),
    (2, 0, "user", "hi"),
    (101, 5, "userh", "i"),
    (101, 7, "", ""),
    (-5, 1, "a", "b" * 50_000),
    (-5, 2, "a", "b"),
    (-105, 2, "a", "b"),
    (None, 1, "a", "lost"),
    (99, 1, None, "é😀"),
]


@pytest.mark.parametrize("share", [False, True])
def test_odd_conversations(spark, rows, share):
    build = ct.shared_head_trie if share else ct.conversation_trie
    assert rows(build(table(spark, ODD))) == brute(ODD, share)


@pytest.mark.parametrize("share", [False, True])
def test_random_conversations_with_hot_ones(spark, rows, share):
    """A first turn and a whole conversation that a third have, one conversation with a third of all turns."""
    rng = random.Random(share)
    data = []
    for c in range(150):
        kind = rng.randint(0, 2)
        turns = ["common", "x", "y"] if kind == 0 else ["common", *(rng.choice("ab") for _ in range(rng.randint(0, 5)))]
        if kind == 2:
            turns = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
        data += [(c * 7, i, "user" if i % 2 else "bot", t) for i, t in enumerate(turns)]
    data += [(1101, i, "user", rng.choice("ab")) for i in range(300)]
    build = ct.shared_head_trie if share else ct.conversation_trie
    assert rows(build(table(spark, data))) == brute(data, share)


def test_pieces_and_rounds_do_not_matter(spark, rows):
    rng = random.Random(8)
    data = [(c, i, "u", rng.choice("abcdef")) for c in range(60) for i in range(rng.randint(1, 5))]
    folder = work_folder(spark, "turns")
    turns = ct.placed_turns(table(spark, data), folder)
    members = turns.where("place = 0").select("conv_id", "n_turns")
    assert rows(ct.prefix_trie(turns, members, last=4, piece=8)) == brute(data, False)


@pytest.mark.parametrize(("last", "piece"), [(1, 1), (5, 7), (1000, 64), (3, 10_000)])
def test_ranks_of_a_list(spark, last, piece):
    rng = random.Random(last)
    ids = rng.sample(range(2000), 400)
    links = list(zip(ids, [*ids[1:], None]))
    rng.shuffle(links)
    df = spark.createDataFrame(links, "id long, next long").repartition(3)
    got = {r.id: r.rank for r in ct.list_ranks(df, work_folder(spark, "list"), last, piece).collect()}
    assert got == {i: k for k, i in enumerate(ids)}


def test_digests_over_batches(spark):
    """One node with most ids: its strings meet in order, however they were cut."""
    ids = random.Random(1).sample(range(10**6), 5000)
    df = spark.createDataFrame([(1, 0, 0, i) for i in ids] + [(0, 0, 0, 5), (2, 7, -9, -3)], "depth long, x1 long, x2 long, conv_id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    try:
        got = {r.depth: r.ends_sha256 for r in ct.member_digests(df.repartition(6)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[1] == hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert got[0], got[2] == (hashlib.sha256(b"5").hexdigest(), hashlib.sha256(b"-3").hexdigest())


def test_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert ct.conversation_trie(empty).count() == 0
    assert ct.shared_head_trie(empty).count() == 0
    lost = spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    assert ct.shared_head_trie(lost.withColumn("extra", F.lit(1))).count() == 0
