"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns (role, text). Its key is its depth with two 64-bit exclusive-ors of hashes
of (place, turn); a turn enters them by 120 bits of its MD5, and conversations never travel with their texts.

Every node has an enter and an exit arc. Entering leads to the first child or, without children, to the node's exit;
leaving leads to the next sibling or to the parent's exit. Parents and siblings are neighbours in one global order of
nodes and their children, so that a node with any number of children is spread over many tasks. The tour is ranked by
``list_ranks``, and the sums over a subtree are differences of running totals at its two arcs.

``list_ranks`` first ranks the pieces of the list that lie within a block of ids (node numbers follow conversations, so
most steps stay inside), then removes members of what is left in rounds: a member that draws 1 after one that drew 0
is merged into it. When at most ``LAST`` pieces are left, their order is found at once, and the rounds are undone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.llm.tables import saved
from provwatch.operators.scans import BLOCK, following, numbered, running
from provwatch.sources.sinks import work_folder

LAST = 1 << 14
PIECE = 1 << 16  # ids of a block whose pieces one task ranks
IDS = 256  # ids written into one string on the way to a digest

_HEADS = 5  # crc32 modulo 6 takes at most five turns
_KEY = ["depth", "x1", "x2"]


def placed_turns(conversations: DataFrame, folder: str) -> DataFrame:
    """conv_id, place (from 0, by turn with null first), k1, k2 (of role and text), n_chars and the conversation's n_turns.

    Null roles and texts are empty. Turns of equal number follow the order of (k1, k2). Rows without conv_id are left
    out. A conversation of any length is numbered in ranges.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    halves = (F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(2))
    k1, k2 = (c.alias(n) for c, n in zip(halves, ("k1", "k2"), strict=True))
    rows = conversations.where("conv_id is not null")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", k1, k2, F.length(text).cast("long").alias("n_chars"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")]
    rows = numbered(rows, order, f"{folder}/turns", "at").withColumn("part", F.expr(f"at div {BLOCK}"))
    parts = rows.groupBy("conv_id", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    whole = parts.groupBy("conv_id").agg(F.min("low").alias("start"), F.sum("n").alias("n_turns"))
    starts = parts.select("conv_id", "part").join(whole, "conv_id")
    joined = rows.join(starts, ["conv_id", "part"])
    return joined.select("conv_id", (F.col("at") - F.col("start")).alias("place"), "k1", "k2", "n_chars", "n_turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with the first h of each conversation taken from conversation c - c % 100, and all conversations.

    h is crc32 of the decimal id modulo 6; a shorter or absent source gives what it has. The second table has conv_id
    and n_turns as rebuilt, also for conversations that are left without turns.
    """
    c = F.col("conv_id")
    own = turns.where("place = 0").select("conv_id", F.col("n_turns").alias("own_turns"))
    base, h = c - c % 100, F.crc32(c.cast("string").cast("binary")) % (_HEADS + 1)
    sources = own.select(F.col("conv_id").alias("base"), F.col("own_turns").alias("source_turns"))
    all_ = own.withColumns({"base": base, "h": h}).join(sources, "base", "left")
    taken = F.least("h", F.coalesce("source_turns", F.lit(0)))
    all_ = all_.withColumn("taken", taken)
    all_ = all_.withColumn("rest", F.greatest(F.col("own_turns") - F.col("h"), F.lit(0)))
    sizes = all_.select("conv_id", "base", "h", "taken", (F.col("taken") + F.col("rest")).alias("n_turns"))
    # what a row needs of its conversation but the source's length follows from its id; that is one row per source
    shown = turns.withColumns({"base": base, "h": h, "own": F.greatest(F.col("n_turns") - h, F.lit(0))}).where("place >= h")
    lengths = turns.where(f"place < {_HEADS} and conv_id % 100 = 0").groupBy("conv_id").agg(F.count("*").alias("heads"))
    lengths = lengths.withColumnRenamed("conv_id", "base")
    spread = F.pmod(F.xxhash64("conv_id", "place"), F.lit(16))
    copies = lengths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    shown = shown.withColumn("salt", spread.cast("int")).join(copies, ["base", "salt"], "left")
    taken = F.least(F.col("h"), F.coalesce("heads", F.lit(0)))
    kept = shown.select(
        "conv_id",
        (F.col("place") - F.col("h") + taken).alias("place"),
        "k1",
        "k2",
        "n_chars",
        (taken + F.col("own")).alias("n_turns"),
    )
    heads = turns.where(f"place < {_HEADS} and conv_id % 100 = 0").select(c.alias("base"), "place", "k1", "k2", "n_chars")
    heads = heads.join(sizes, "base").where("place < taken").select("conv_id", "place", "k1", "k2", "n_chars", "n_turns")
    return kept.union(heads), sizes.select("conv_id", "n_turns")


def _pieces(table: pa.Table) -> pa.Table:
    """Pieces of the list within a block: the head of each id's piece, its place in it, and at heads length and next."""
    order = np.argsort(table["id"].to_numpy())
    ids, following_ids = table["id"].to_numpy()[order], table["next"].fill_null(-1).to_numpy()[order]
    at = np.minimum(np.searchsorted(ids, following_ids), len(ids) - 1)
    inside = ids[at] == following_ids
    pointer, steps = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    pointer[at[inside]] = np.flatnonzero(inside)
    steps[at[inside]] = 1
    while (pointer[pointer] != pointer).any():
        steps, pointer = steps + steps[pointer], pointer[pointer]
    length, onward = np.zeros(len(ids), np.int64), np.full(len(ids), -1)
    tails = np.flatnonzero(~inside)
    length[pointer[tails]], onward[pointer[tails]] = steps[tails] + 1, following_ids[tails]
    return pa.table(
        {
            "id": ids,
            "head": ids[pointer],
            "steps": steps,
            "length": length,
            "next": pa.array(onward, mask=onward < 0),
        }
    )


def _starts(pieces: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a whole list's pieces and where each starts, by pointer jumping from the end."""
    order = np.argsort(pieces["id"].to_numpy())
    ids, onward = pieces["id"].to_numpy()[order], pieces["next"].fill_null(-1).to_numpy()[order]
    left = pieces["length"].to_numpy()[order].copy()
    whole = int(left.sum())
    pointer = np.where(onward < 0, len(ids), np.searchsorted(ids, onward))
    pointer, left = np.append(pointer, len(ids)), np.append(left, 0)
    while (pointer < len(ids)).any():
        left, pointer = left + left[pointer], pointer[pointer]
    return ids, whole - left[:-1]


def list_ranks(links: DataFrame, folder: str, last: int = LAST, piece: int = PIECE) -> DataFrame:
    """Places (from 0) of the members of one linked list: id, rank. ``links`` has id and next (null at the end)."""
    spark = links.sparkSession
    made = "id long, head long, steps long, length long, next long"
    blocks = links.select("id", "next", F.expr(f"id div {piece}").alias("b")).groupBy("b")
    pieces = saved(blocks.applyInArrow(lambda t: _pieces(t), made), f"{folder}/pieces")
    left = pieces.where("id = head").select("id", "next", "length")
    rounds: list[DataFrame] = []
    while left.count() > last:
        coin = F.xxhash64("id", F.lit(len(rounds))).bitwiseAND(F.lit(1))
        stay, go = left.where(coin == 0), left.where(coin == 1)
        go = go.select(F.col("id").alias("gone"), F.col("next").alias("onward"), F.col("length").alias("more"))
        both = stay.join(go, F.col("next") == F.col("gone"), "full_outer")
        merged = F.col("id").isNotNull() & F.col("gone").isNotNull()
        step = both.select(
            F.coalesce("id", "gone").alias("id"),
            F.when(F.col("gone").isNotNull(), F.col("onward")).otherwise(F.col("next")).alias("next"),
            (F.coalesce("length", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("length"),
            F.when(merged, F.col("gone")).alias("gone"),
            F.when(merged, F.col("length")).alias("offset"),
        )
        rounds.append(saved(step, f"{folder}/round-{len(rounds)}"))
        left = rounds[-1].select("id", "next", "length")
    ids, starts = _starts(left.toArrow())
    places = spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int64()), "start": pa.array(starts, pa.int64())}))
    for k, step in reversed(list(enumerate(rounds))):
        found = step.select("id", "gone", "offset").join(places, "id")
        two = F.array(
            F.struct("id", "start"),
            F.struct(F.col("gone").alias("id"), (F.col("start") + F.col("offset")).alias("start")),
        )
        places = found.select(F.inline(two)).where("id is not null")
        if k % 4 == 0 and k:  # or the plan would grow with the rounds
            places = saved(places, f"{folder}/places-{k}")
    heads = places.withColumnRenamed("id", "head")
    return pieces.join(heads, "head").select("id", (F.col("start") + F.col("steps")).alias("rank"))


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of a node, in order, as strings; rows come sorted by node and id."""
    for batch in batches:
        keys = [batch.column(i).to_numpy() for i in range(3)]
        ids = batch.column(3).to_numpy()
        n = len(ids)
        changes = np.zeros(n, bool)
        changes[:1] = True
        for k in keys:
            changes[1:] |= k[1:] != k[:-1]
        group = np.maximum.accumulate(np.where(changes, np.arange(n), 0))
        at = np.flatnonzero(changes | ((np.arange(n) - group) % IDS == 0))
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(at, np.append(at[1:], n), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(k[at]) for k in keys), pa.array(ids[at]), pa.array(texts, pa.string())], names=[*_KEY, "first", "ids"]
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's strings joined by commas; rows come sorted by node and first id, and are not kept."""
    key, state = None, None
    for batch in batches:
        done = []
        for *mine, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
            if mine == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((*key, state.hexdigest()))
            key, state = mine, hashlib.sha256(ids.encode())
        yield _digest_batch(done)
    if key is not None:
        yield _digest_batch([(*key, state.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[*_KEY, "ends_sha256"]
    )


def member_digests(ends: DataFrame) -> DataFrame:
    """Per node (depth, x1, x2): SHA-256 of its conv_ids, ascending, decimal, joined by commas.

    Ids are put together in sorted ranges first; a node that a third of all conversations end at is then one row for
    each ``IDS`` of them in the task that digests it, row by row.
    """
    keys = [F.col(k) for k in _KEY]
    sorted_ = ends.select(*_KEY, "conv_id").repartitionByRange(*keys, F.col("conv_id")).sortWithinPartitions(*keys, "conv_id")
    strings = sorted_.mapInArrow(_strings, "depth long, x1 long, x2 long, first long, ids string")
    ready = strings.repartition(*keys).sortWithinPartitions(*keys, "first")
    return ready.mapInArrow(_digests, "depth long, x1 long, x2 long, ends_sha256 string")


def _tour(nodes: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Arcs (id, next) of the Euler tour, and each node's parent: node, parent, parent_conv_id."""
    above = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), "p1", "p2", F.lit(1).alias("child"), "conv_id", "node")
    rows = nodes.select(*_KEY, F.lit(0).alias("child"), "conv_id", "node").union(above)
    rows = numbered(rows, [F.col(c) for c in (*_KEY, "child", "conv_id")], f"{folder}/families", "at")
    rows = following(rows, "at", {"next_child": "child", "next_node": "node"})
    itself = F.when(F.col("child") == 0, F.struct("at", "node", "conv_id"))
    rows = running(rows, "at", {"parent": ("max", itself)})
    sibling = F.col("next_child") == 1
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    arc = F.when(F.col("child") == 0, F.struct(enter.alias("id"), F.when(sibling, F.col("next_node") * 2).otherwise(leave).alias("next")))
    arc = arc.otherwise(
        F.struct(leave.alias("id"), F.when(sibling, F.col("next_node") * 2).otherwise(F.col("parent.node") * 2 + 1).alias("next"))
    )
    end = F.when((F.col("child") == 0) & (F.col("depth") == 0), F.struct(leave.alias("id"), F.lit(None).cast("long").alias("next")))
    rows = rows.withColumns({"arc": arc, "end": end})
    rows = saved(rows.select("child", "node", "arc", "end", "parent"), f"{folder}/arcs")
    arcs = rows.select("arc.*").union(rows.where("end is not null").select("end.*"))
    parents = rows.where("child = 1").select("node", F.col("parent.node").alias("parent"), F.col("parent.conv_id").alias("parent_conv_id"))
    return arcs, parents


def prefix_trie(turns: DataFrame, conversations: DataFrame, last: int = LAST, piece: int = PIECE) -> DataFrame:
    """One row per node of the trie.

    ``turns``: conv_id, place (0, 1, ... within each), k1, k2, n_chars, n_turns, as ``placed_turns`` gives them;
    ``conversations``: conv_id and n_turns of all members, with or without turns. Returns conv_id (the smallest
    member, which with depth names the node), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. Equal conversations share their nodes. Without conversations there is no node.
    """
    folder = work_folder(turns.sparkSession, "trie")
    own = (F.xxhash64("place", "k1", "k2"), F.xxhash64("k2", F.lit("second"), "place", "k1"))
    rows = turns.withColumns({"h1": own[0], "h2": own[1]})
    rows = running(rows, "place", {"x1": ("bit_xor", F.col("h1")), "x2": ("bit_xor", F.col("h2"))}, ["conv_id"])
    prefixes = saved(
        rows.select(
            "conv_id",
            (F.col("place") + 1).alias("depth"),
            "x1",
            "x2",
            F.col("x1").bitwiseXOR(F.col("h1")).alias("p1"),
            F.col("x2").bitwiseXOR(F.col("h2")).alias("p2"),
            "n_chars",
            (F.col("place") + 1 == F.col("n_turns")).alias("ends"),
        ),
        f"{folder}/prefixes",
    )
    conversations = saved(conversations.select("conv_id", "n_turns"), f"{folder}/conversations")
    least, count = F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")
    inner = prefixes.groupBy(*_KEY).agg(least, count, *(F.max(c).alias(c) for c in ("p1", "p2", "n_chars")))
    nothing = F.lit(0).cast("long")
    root = conversations.agg(least, count).where("n_convs > 0")
    root = root.select(*(nothing.alias(c) for c in _KEY), "conv_id", "n_convs", *(nothing.alias(c) for c in ("p1", "p2", "n_chars")))
    nodes = numbered(inner.union(root), [F.col("conv_id"), F.col("depth")], f"{folder}/nodes", "node")
    arcs, parents = _tour(nodes, folder)
    ranks = list_ranks(arcs, folder, last, piece)

    children = parents.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    about = nodes.join(children, "node", "left").join(parents, "node", "left").drop("parent")
    about = about.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    about = about.withColumn("saved", (F.col("n_convs") - 1) * F.col("n_chars"))
    about = saved(about.withColumn("leaf", (F.col("n_children") == 0).cast("long")), f"{folder}/about")
    tour = ranks.withColumns({"node": F.expr("id div 2"), "enters": F.col("id") % 2 == 0})
    tour = tour.join(about.select("node", "leaf", "saved"), "node")
    weight = {n: F.when(F.col("enters"), F.col(n)).otherwise(F.lit(0)) for n in ("leaf", "saved")}
    tour = running(tour, "rank", {f"{n}_upto": ("sum", w) for n, w in weight.items()})
    sums = tour.groupBy("node").agg(
        *(
            (F.max(F.when(~F.col("enters"), F.col(f"{n}_upto"))) - F.max(F.when(F.col("enters"), F.col(f"{n}_upto") - F.col(n)))).alias(to)
            for n, to in (("leaf", "n_leaves"), ("saved", "saved_tokens"))
        )
    )
    turnless = conversations.where("n_turns = 0").select(*(nothing.alias(c) for c in _KEY), "conv_id")
    digests = member_digests(prefixes.where("ends").select(*_KEY, "conv_id").union(turnless))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    found = about.join(sums, "node").join(digests, _KEY, "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the given conversations as they are (conv_id, turn, role, text); further columns are ignored."""
    folder = work_folder(conversations.sparkSession, "turns")
    turns = saved(placed_turns(conversations, folder), f"{folder}/placed")
    return prefix_trie(turns, turns.where("place = 0").select("conv_id", "n_turns"))


def shared_head_trie(conversations: DataFrame) -> DataFrame:
    """The trie after each conversation has got its first turns from the one its hundred starts with (``rebuilt``)."""
    spark = conversations.sparkSession
    folder = work_folder(spark, "rebuilt")
    return prefix_trie(*rebuilt(saved(placed_turns(conversations, folder), f"{folder}/placed")))

