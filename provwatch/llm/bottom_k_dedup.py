"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct word shingles. Its sketch is the k smallest hash values of the set. Inverted lists
of retained values yield candidates, the sketch of the union (the k smallest of both sketches together) estimates
the similarity and filters, and exact Jaccard on the full sets decides.

*What a list must be searched for.* Two sets with Jaccard similarity 0.8 share most retained values: of the k
smallest values of the union, each is common with probability 0.8, and fewer than ``_least_shared`` common ones
have a probability below 1e-10 (k = 64: 26 values). So, in one global order of the values, two such documents share
a value among the first ``size - least + 1`` of each (prefix filter). The order is by frequency, rarest first: values
of common passages and lines come last and are searched only for documents that consist mainly of them.

*Frequent values.* Documents with equal sets are one class from the start. Lists of up to ``FREQUENT`` classes are
searched pair by pair. For classes under more frequent values, full sets take the place of the sketch: ordered by their
frequency among these classes, only a set's first fifth needs searching, and a common value far back in both orders
shows that too little can be common (prefix and positional filter; a class with over a fifth of values of its own can
have no partner). Each list is compared with its most typical class as a centre, then what is outside the centre's
component with a second centre, then only what is still outside with the classes of other components. Every pair that
shares a searched value is thus either compared or known to be in one component; no pairs of a whole group are made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.llm.blocks import blocks, mix, row_sets, word_hashes, words
from provwatch.llm.tables import saved, sent_if_small
from provwatch.sources.sinks import work_folder

SKETCH = 64
FREQUENT = 12
_LEAST_SHARE = 0.4  # of the sketch of the union; below this a pair at the threshold is improbable (under 1e-10)


_SKETCHED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_key", pa.binary()),
        ("sketch", pa.list_(pa.int64())),
    ]
)
_SKETCHED_DDL = "doc_id long, n_shingles long, set_key binary, sketch array<long>"


def _set_keys(sets: list[np.ndarray]) -> pa.Array:
    """Name of each set: two sums over independently mixed members, and the size. An empty set has none."""
    with np.errstate(over="ignore"):
        sums = [(mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64), len(s)) for s in sets]
    return pa.array([np.array(k, np.uint64).tobytes() if k[2] else None for k in sums], pa.binary())


def _keyed(shingle: int):
    """Texts under the key of their set."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for block in blocks(text):
                found = words(block)
                keys = _set_keys(row_sets(word_hashes(block, found, fold=True), found, shingle))
                yield pa.RecordBatch.from_arrays([keys, text.slice(block.first, len(keys))], names=["set_key", "text"])

    return keyed


def _sketch(shingle: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = words(block)
                sets = row_sets(word_hashes(block, found, fold=True), found, shingle)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.last - block.first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        _set_keys(sets),
                        pa.array([s[:SKETCH].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    schema=_SKETCHED,
                )

    return sketch


def _similar_sketches(threshold: float):
    """Keep pairs whose estimate from the union's sketch may reach the threshold."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b"))
            sizes = zip(batch.column("size_a").to_pylist(), batch.column("size_b").to_pylist(), strict=True)
            mask = []
            for x, y, (m, n) in zip(a, b, sizes, strict=True):
                x, y = np.array(x, np.int64).view(np.uint64), np.array(y, np.int64).view(np.uint64)
                both = np.intersect1d(x, y, assume_unique=True)
                union = np.union1d(x, y)
                if m <= SKETCH and n <= SKETCH:
                    mask.append(len(both) >= threshold * len(union) - 1e-9)
                else:
                    limit = union[min(SKETCH, len(union)) - 1]
                    mask.append((both <= limit).sum() >= _LEAST_SHARE * min(SKETCH, len(union)))
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return keep


def _full_sets(shingle: int):
    """Full set of each text."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = words(block)
                sets = row_sets(word_hashes(block, found, fold=True), found, shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(block.first, len(sets)), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["id", "members"],
                )

    return full


def _exact_pairs(shingle: int, percent: int):
    """Keep pairs with 100 * intersection >= percent * union, on the full sets."""

    def sets_of(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
        out = []
        for block in blocks(batch.column(name)):
            found = words(block)
            out += row_sets(word_hashes(block, found, fold=True), found, shingle)
        return out

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                mask = []
                for x, y in zip(sets_of(part, "text_a"), sets_of(part, "text_b"), strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    mask.append(100 * common >= percent * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return keep


def components(links: DataFrame, folder: str) -> DataFrame:
    """Smallest vertex reachable from each vertex of undirected links (a, b): columns ``v`` and ``component``.

    Labels travel along links and then along labels (pointer jumping), so the number of rounds grows with the
    logarithm of a component's diameter. Each round is a written table.
    """
    spark = links.sparkSession
    edges = saved(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{folder}/edges"
    )
    labels = edges.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("component"))
    labels = saved(labels, f"{folder}/labels-0")
    for step in range(1, 64):
        near = (
            edges.join(labels.withColumnRenamed("v", "b"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("component").alias("near"))
        )
        moved = labels.join(near, "v").select("v", F.least("component", "near").alias("to"), F.col("component").alias("old"))
        jump = labels.select(F.col("v").alias("to"), F.col("component").alias("further"))
        new = moved.join(jump, "to", "left").select(
            "v", F.least("to", F.coalesce("further", "to")).alias("component"), "old"
        )
        new = saved(new, f"{folder}/labels-{step}")
        labels = new.select("v", "component")
        if new.where("component <> old").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Group documents linked by ``100 * intersection >= percent * union`` of their shingle sets.

    Shingles are ``shingle`` consecutive words of the lower-cased (A-Z) text; a text with fewer words is one shingle.
    Returns one row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable over links)
    and kept (doc_id equals component_id). A null or blank text has an empty set and is linked with nothing, so it is
    kept. Repeated rows are linked with each other and carry the same component; all of them count as kept if their
    doc_id is the smallest. A row without doc_id takes the component of the rows with an equal set (null if all of
    them lack ids), never names one and is not kept, unless its set is empty: then component_id is null as well.
    Further columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "near-duplicates")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    threshold = percent / 100
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = saved(docs.mapInArrow(_sketch(shingle), _SKETCHED_DDL), f"{folder}/sketches")

    # one class per distinct set, with a number of its own; its row of the smallest doc_id stands for it
    classes = sketched.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size")
    )
    classes = saved(classes.withColumn("id", F.monotonically_increasing_id()), f"{folder}/classes")
    chosen = classes.select("id", "size", F.col("set_key").alias("k"), F.col("doc_id").alias("d"))
    same_row = (F.col("set_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d"))
    sketches = sketched.join(chosen, same_row).select("id", "size", "sketch").dropDuplicates(["id"])
    sketches = saved(sketches, f"{folder}/class-sketches")

    # inverted lists: the frequency of each retained value, then each class's rarest values
    lists = _searched(sketches.select("id", "size", F.explode("sketch").alias("value")), SKETCH, threshold, tasks)
    lists = saved(lists, f"{folder}/lists")
    rare, often = lists.where(F.col("classes") <= FREQUENT), lists.where(F.col("classes") > FREQUENT)
    pairs = _side("a", rare).join(_side("b", rare), "value").where((F.col("a") < F.col("b")) & _alike(threshold))
    pairs = saved(pairs.select("a", "b").distinct(), f"{folder}/pairs")
    sketch_of = lambda x: sketches.select(
        F.col("id").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}")
    )
    likely = pairs.join(sketch_of("a"), "a").join(sketch_of("b"), "b").mapInArrow(_similar_sketches(threshold), "a long, b long")
    likely = saved(likely, f"{folder}/likely")

    # texts of all classes that are compared in full, fetched once
    frequent = saved(often.select("id").distinct(), f"{folder}/frequent")
    wanted = likely.select(F.explode(F.array("a", "b")).alias("id")).union(frequent).distinct()
    wanted = wanted.join(classes.select("id", "set_key", "doc_id"), "id")
    # a doc_id may occur with several texts: the set's key, computed again, tells which one is meant
    wanted = saved(wanted, f"{folder}/wanted")
    ids = sent_if_small(saved(wanted.select("doc_id").distinct(), f"{folder}/wanted-ids"))
    texts = docs.join(ids, "doc_id", "left_semi").mapInArrow(
        _keyed(shingle), "set_key binary, text string"
    )
    texts = texts.join(wanted.select("id", "set_key"), "set_key").dropDuplicates(["id"]).select("id", "text")
    texts = saved(texts, f"{folder}/texts")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Links among candidate pairs (a, b)."""
        text = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"text_{x}"))
        near = pairs.select("a", "b").distinct().join(text("a"), "a").join(text("b"), "b")
        return saved(near.mapInArrow(_exact_pairs(shingle, percent), "a long, b long"), f"{folder}/{name}-links")

    links = verified(likely, "rare")
    if not frequent.isEmpty():
        full = texts.join(frequent, "id", "left_semi").mapInArrow(_full_sets(shingle), "id long, members array<long>")
        members = full.select("id", F.size("members").cast("long").alias("size"), F.explode("members").alias("value"))
        lists = saved(_searched(members, None, threshold, tasks), f"{folder}/full-lists")
        # the most typical class of a list has the fewest values of its own
        typical = F.min(F.struct("alone", "id", "size", "place")).alias("c")
        centre = [F.col(f"c.{c}").alias(n) for c, n in (("id", "a"), ("size", "size_a"), ("place", "place_a"))]
        centres = lists.groupBy("value").agg(typical).select("value", *centre)
        pairs = centres.join(_side("b", lists), "value").where((F.col("a") != F.col("b")) & _alike(threshold) & _enough(threshold))
        links = links.unionByName(verified(_ordered(pairs), "centre"))
        for name in ("second", "rest"):
            labels = components(links, f"{folder}/{name}")
            placed = lists.join(labels.withColumnRenamed("v", "id"), "id", "left")
            placed = saved(placed.withColumn("component", F.coalesce("component", "id")), f"{folder}/{name}-placed")
            main = placed.groupBy("value").agg(F.min_by("component", F.struct("alone", "id")).alias("main"))
            outside = placed.join(main, "value").where("component <> main").drop("main")
            if name == "second":
                typical = F.min(F.struct("alone", "id", "size", "place", "component")).alias("c")
                centres = outside.groupBy("value").agg(typical).select("value", *centre, F.col("c.component").alias("component_a"))
            else:
                centres = _side("a", outside)
            apart = F.col("component_a") != F.col("component_b")
            pairs = centres.join(_side("b", placed), "value").where(apart & _alike(threshold) & _enough(threshold))
            links = links.unionByName(verified(_ordered(pairs), name))
    labels = components(links, f"{folder}/all")

    joined = classes.join(labels.withColumnRenamed("v", "id"), "id", "left")
    joined = joined.select("set_key", "doc_id", F.coalesce("component", "id").alias("component"))
    names = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = joined.join(names, "component").select("set_key", "component_id")
    out = sketched.select("doc_id", "n_shingles", "set_key").join(names, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _searched(members: DataFrame, sketch: int | None, threshold: float, tasks: int) -> DataFrame:
    """Values that each class is searched by, of (id, size, value) rows: those of its first ones in the order by
    frequency that occur in another class as well. ``place`` counts from 0 in that order, ``alone`` are its own values.
    """
    members = members.repartition(tasks, "value")  # serves the count and the join
    frequency = members.groupBy("value").agg(F.count("*").alias("classes")).where("classes > 1")
    shared = members.join(frequency, "value")
    ranked = shared.groupBy("id", "size").agg(F.sort_array(F.collect_list(F.struct("classes", "value"))).alias("shared"))
    kept = F.least(F.col("size"), F.lit(sketch)) if sketch else F.col("size")
    # common values that two sets at the threshold have at least (a sketch below full size is the whole set)
    least = F.ceil(F.lit(threshold) * F.col("size") - F.lit(1e-9))
    if sketch:
        least = F.least(least, F.lit(math.ceil(_LEAST_SHARE * sketch)))
    # a class's own values come first in the order and are not in ``shared``
    ranked = ranked.withColumn("alone", (kept - F.size("shared")).cast("int"))
    ranked = ranked.withColumn("searched", (kept - F.greatest(least, F.lit(1)) + 1 - F.col("alone")).cast("int"))
    lists = ranked.where("searched > 0").select(
        "id", "size", "alone", F.posexplode(F.slice("shared", F.lit(1), F.col("searched"))).alias("p", "s")
    )
    return lists.select("s.value", "s.classes", "id", "size", "alone", (F.col("alone") + F.col("p")).alias("place"))


def _side(x: str, lists: DataFrame) -> DataFrame:
    names = [c for c in ("size", "place", "component") if c in lists.columns]
    return lists.select("value", F.col("id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in names))


def _alike(threshold: float):
    """Sizes that allow the threshold."""
    return F.least("size_a", "size_b") >= F.lit(threshold) * F.greatest("size_a", "size_b") - F.lit(1e-9)


def _enough(threshold: float):
    """What follows a common value in both orders allows the threshold; true at the first common value of any link."""
    left = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    return left >= F.lit(threshold / (1 + threshold)) * (F.col("size_a") + F.col("size_b")) - F.lit(1e-9)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
