"""Nearest neighbours by cosine with multi-index hashing.

Vectors get binary codes: centred, rotated by ``ROTATIONS`` learned rotations (iterative quantisation, fitted on a
bounded sample) and cut at zero. Hyperplanes through the middle of the table hardly cut a dense cluster away from it, so
each dense region of the sample gets rotations centred on itself; their bits are part of every code, and of two codes
within the region they are what differs. A code is split into one-byte substrings, and each substring has its own index. If
two codes of m substrings differ in at most r = m * t + a bits, then some of the first a + 1 substrings differ in at
most t bits or some of the others in at most t - 1 (pigeonhole), so probing each index within that radius retrieves
every code within r. What is retrieved is checked by its whole Hamming distance, and the vectors of the codes within r
are reranked by cosine in double precision.

Each query has a radius of its own, at first from its distances to the sample, and is searched again in a larger one
until at least ``wanted(rows)`` codes are reranked or all bits are reached. That number is three times the square root
of the table's codes, and ``CODES`` at least: the k-th neighbour's place by Hamming distance moves out as a table grows. Equal vectors have one code: k + 1 of their ids go
with it, which is all that any query can return of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from provwatch.llm.tables import saved
from provwatch.sources.sinks import work_folder

ROTATIONS = 4
SAMPLE = 4_000
CELLS = 32  # of the sample, among which dense ones are looked for
CENTRES = 8  # dense regions with rotations of their own, those of most rows
_DENSE = 0.5  # a dense cell's share of the sample's mean squared distance to the middle, at most
CODES = 384
CELL_ROWS = 100_000  # index entries that are compared in one group
_SHELF = 16  # substring values of one index that share a group

_BITS = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def _matrix(codes: pd.Series) -> np.ndarray:
    """Codes as rows of bytes, filled up to whole 64-bit words."""
    width = -(-len(codes.iloc[0]) // 8) * 8
    return np.frombuffer(b"".join(c.ljust(width, b"\0") for c in codes), np.uint8).reshape(len(codes), width)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


def dense_regions(x: np.ndarray) -> list[np.ndarray]:
    """Rows of each dense region of a sample of unit vectors, largest first; evenly spread vectors have none.

    The sample is cut into cells by k-means. Cells whose rows lie close to their centre are dense, and dense cells
    whose centres are no further apart than their rows are one region.
    """
    if len(x) < 2 * CELLS:
        return []
    apart = lambda centres: ((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)).clip(0)
    centres = x[np.random.default_rng(1).choice(len(x), CELLS, replace=False)]
    for _ in range(10):
        cell = apart(centres).argmin(1)
        centres = np.array([x[cell == i].mean(0) if (cell == i).any() else centres[i] for i in range(CELLS)])
    far = apart(centres)
    cell = far.argmin(1)
    sizes = np.bincount(cell, minlength=CELLS)
    within = np.bincount(cell, far.min(1), CELLS) / np.maximum(sizes, 1)
    limit = _DENSE * ((x - x.mean(0)) ** 2).sum(1).mean()
    regions: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable"):
        if within[i] < limit and sizes[i] >= len(x) // (2 * CELLS):
            near = [g for g in regions if min(((centres[i] - centres[j]) ** 2).sum() for j in g) < 2 * within[i]]
            regions = [g for g in regions if g not in near] + [[i, *(j for g in near for j in g)]]
    found = [np.flatnonzero(np.isin(cell, g)) for g in regions]
    return sorted(found, key=lambda rows: (-len(rows), rows[0]))[:CENTRES]


class Coder:
    """Learned rotations and thresholds, of the whole sample and of its dense regions; ``codes`` gives bytes per vector."""

    def __init__(self, sample: np.ndarray, rotations: int = ROTATIONS):
        x = _unit(sample)
        self.frames = [self._frame(part, rotations) for part in (x, *(x[rows] for rows in dense_regions(x)))]
        self.bits = len(self.frames) * rotations * sample.shape[1]

    @staticmethod
    def _frame(x: np.ndarray, rotations: int) -> tuple[np.ndarray, list[np.ndarray]]:
        d = x.shape[1]
        mean = x.mean(0) if len(x) else np.zeros(d)
        y, turns = x - mean, []
        for seed in range(rotations):
            turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
            for _ in range(20 if len(x) > d else 0):
                u, _, v = np.linalg.svd(np.where(y @ turn >= 0, 1.0, -1.0).T @ y)
                turn = (u @ v).T
            turns.append(turn)
        return mean, turns

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        x = _unit(vectors)
        return np.packbits(np.hstack([(x - mean) @ turn >= 0 for mean, turns in self.frames for turn in turns]), axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distance per substring of aligned codes."""
    return _BITS[a ^ b]


def wanted(rows: int, codes: int = CODES) -> int:
    """How many codes each query has to rerank; a table of no more is searched whole."""
    return max(codes, math.ceil(3 * math.sqrt(rows)))


def first_radius(apart: np.ndarray, rows: int, target: int, bits: int) -> int:
    """Radius of one query from its distances to a sample of ``rows`` codes, with two standard errors to spare."""
    if rows <= target or not len(apart):
        return bits
    share = len(apart) * target / rows
    place = math.ceil(share + 2 * math.sqrt(share))
    return int(np.partition(apart, place)[place]) if place < len(apart) else bits


def substring_radii(radius: int, substrings: int) -> np.ndarray:
    """Probing radius of each substring; -1: not probed."""
    t, a = divmod(radius, substrings)
    return np.where(np.arange(substrings) <= a, t, t - 1)


def _codes_of(coder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                vectors = np.array(part.column("vector").to_pylist(), float)
                codes = [c.tobytes() for c in coder.value.codes(vectors)] if len(vectors) else []
                yield pa.RecordBatch.from_arrays([part.column("group"), pa.array(codes, pa.binary())], names=["group", "code"])

    return run


def _radius_of(sample_codes, rows: int, target: int, bits: int):
    """Each query's code with its first radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            radii = []
            for code in batch.column("code").to_pylist():
                apart = distances(sample_codes.value, np.frombuffer(code, np.uint8)).sum(1, dtype=np.int64)
                radii.append(first_radius(apart, rows, target, bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("code"), pa.array(radii, pa.int32())], names=["query_id", "code", "radius"]
            )

    return run


def _probes(table: np.ndarray, salts: int):
    """Groups each query visits: those with a substring value within its radius, in each part of a large group."""
    near = _BITS[np.arange(256)[:, None] ^ np.arange(256)[None, :]].reshape(256, -1, _SHELF).min(2)
    visits = [[np.flatnonzero(near[v] <= r) for v in range(256)] for r in range(9)]
    shelves = 256 // _SHELF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, code, radius in zip(*(batch.column(c).to_pylist() for c in ("query_id", "code", "radius")), strict=True):
                cells = [j * shelves + visits[min(r, 8)][v] for j, (v, r) in enumerate(zip(code, table[radius], strict=True)) if r >= 0]
                cells = np.concatenate([*cells, np.zeros(0, np.int64)]).astype(np.int64)
                cells = (cells[:, None] * salts + np.arange(salts)).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells),
                        pa.array(np.full(len(cells), q)),
                        pa.array([code] * len(cells), pa.binary()),
                        pa.array(np.full(len(cells), radius, np.int32)),
                    ],
                    names=["cell", "query_id", "code", "radius"],
                )

    return run


def _entries(radii: np.ndarray, salts: int):
    """Each code under the value of each of its substrings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probed = np.flatnonzero(radii >= 0)
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                groups, codes = part.column("group").to_numpy(), part.column("code").to_pylist()
                values = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)[:, probed].astype(np.int64)
                cells = (probed * (256 // _SHELF) + values // _SHELF) * salts + (groups % salts)[:, None]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells.ravel()),
                        pa.array(np.repeat(groups, len(probed))),
                        pa.array([c for c in codes for _ in probed], pa.binary()),
                    ],
                    names=["cell", "group", "code"],
                )

    return run


def _compare(table: np.ndarray, salts: int):
    """Pairs of one group within the query's radius; each pair only at the first substring that it is found by."""

    def run(probes: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        found_q, found_g = [], []
        if len(probes) and len(entries):
            j = int(probes["cell"].iloc[0]) // salts // (256 // _SHELF)
            index, asked = _matrix(entries["code"]), _matrix(probes["code"])
            groups, queries = entries["group"].to_numpy(), probes["query_id"].to_numpy()
            radius = probes["radius"].to_numpy()
            radii = table[radius]
            for value in np.unique(index[:, j]):  # the index proper: entries of one value, queries that probe it
                here, there = np.flatnonzero(index[:, j] == value), np.flatnonzero(_BITS[asked[:, j] ^ value] <= radii[:, j])
                words_i = index[here].view(np.uint64)
                step = max(1, 500_000 // len(here))
                for a in range(0, len(there), step):
                    some = there[a : a + step]
                    words_q = asked[some].view(np.uint64)
                    apart = np.zeros((len(some), len(here)), np.int64)
                    for w in range(words_i.shape[1]):
                        apart += np.bitwise_count(words_q[:, None, w] ^ words_i[None, :, w])
                    q, g = np.nonzero(apart <= radius[some][:, None])
                    q, g = some[q], here[g]
                    if j:
                        later = (distances(asked[q, :j], index[g, :j]) > radii[q, :j]).all(1)
                        q, g = q[later], g[later]
                    found_q.append(queries[q])
                    found_g.append(groups[g])
        empty = np.zeros(0, np.int64)
        return pd.DataFrame({"query_id": np.concatenate([*found_q, empty]), "group": np.concatenate([*found_g, empty])})

    return run


def _scaled(vector: Column) -> Column:
    """Very large or small vectors divided by their largest component, or squares would overflow or vanish."""
    largest = F.array_max(F.transform(vector, F.abs))
    extreme = (largest > 1e100) | (largest < 1e-100)
    return F.when(extreme, F.transform(vector, lambda x: x / largest)).otherwise(vector)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, codes: int = CODES) -> DataFrame:
    """The k nearest rows of ``vectors`` (vec_id, embedding) for each row of ``queries`` (vec_id, embedding).

    Returns query_id, rank (from 1), vec_id and score (cosine, double precision), nearest first, ties to the smaller
    vec_id. A query's own row (equal vec_id) is no candidate. Rows take no part if their vec_id or vector is null or
    the vector is empty, has a null or non-finite component or length 0. Vectors are compared with those of their own
    dimension, each dimension in an index of its own. A query with fewer than k candidates gets all of them; one without
    any, no row. Rows that repeat vec_id and vector count once. Vectors equal to each other are all returned as far as
    k allows. Components may have any size; vectors beyond 1e100 or below 1e-100 are scaled first, which leaves their
    cosine. Further columns are ignored.
    """
    usable = (
        F.col("vec_id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    cast = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows, asked = (cast(df).where(usable).withColumn("vector", _scaled(F.col("vector"))) for df in (vectors, queries))
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for width in sorted(r[0] for r in asked.select(F.size("vector")).distinct().collect()):
        one = [df.where(F.size("vector") == width).dropDuplicates(["vec_id", "vector"]) for df in (rows, asked)]
        result = _nearest_of_width(*one, width, k, codes)
        found = found if result is None else found.unionByName(result)
    return found


def _nearest_of_width(rows: DataFrame, asked: DataFrame, width: int, k: int, codes: int) -> DataFrame | None:
    """``nearest`` among vectors of one dimension; None if there are none."""
    spark = rows.sparkSession
    folder = work_folder(spark, "nearest")
    # one group per distinct vector, with the smallest ids that a query may need
    grouped = saved(_groups(rows, k).withColumn("group", F.monotonically_increasing_id()), f"{folder}/groups")
    total = grouped.count()
    if not total:
        return None
    sample = grouped.select("group", "vector").orderBy(F.xxhash64("vector"), "group").limit(SAMPLE).collect()
    fitted = Coder(np.array([r["vector"] for r in sample], float))
    coder = spark.sparkContext.broadcast(fitted)
    coded = saved(grouped.select("group", "vector").mapInArrow(_codes_of(coder), "group long, code binary"), f"{folder}/codes")
    asked = saved(asked.withColumn("query_id", F.monotonically_increasing_id()), f"{folder}/queries")
    bits, target = fitted.bits, wanted(total, max(codes, k + 1))
    sample_codes = spark.sparkContext.broadcast(fitted.codes(np.array([r["vector"] for r in sample], float)))
    pending = asked.select(F.col("query_id").alias("group"), "vector").mapInArrow(_codes_of(coder), "group long, code binary")
    pending = pending.mapInArrow(_radius_of(sample_codes, total, target, bits), "query_id long, code binary, radius int")
    pending = saved(pending, f"{folder}/query-codes")

    substrings = -(-bits // 8)
    table = np.stack([substring_radii(r, substrings) for r in range(bits + 1)])
    salts = max(1, -(-total * _SHELF // (256 * CELL_ROWS)))
    results = None
    for step in range(bits):
        largest = pending.agg(F.max("radius")).first()[0]
        if largest is None:
            return results
        probes = pending.mapInArrow(_probes(table, salts), "cell long, query_id long, code binary, radius int")
        entries = coded.mapInArrow(_entries(table[largest], salts), "cell long, group long, code binary")
        pairs = probes.groupBy("cell").cogroup(entries.groupBy("cell")).applyInPandas(_compare(table, salts), "query_id long, group long")
        pairs = saved(pairs, f"{folder}/pairs-{step}")
        # whoever has too few codes is searched again; all others are reranked
        sizes = pairs.groupBy("query_id").agg(F.count("*").alias("n"))
        state = pending.join(sizes, "query_id", "left").withColumn("done", (F.col("radius") >= bits) | (F.coalesce("n", F.lit(0)) >= target))
        state = saved(state.drop("n"), f"{folder}/state-{step}")
        ready = pairs.join(state.where("done").select("query_id"), "query_id", "left_semi")
        done = saved(_rerank(ready, asked, grouped, k), f"{folder}/best-{step}").select(*_NAMES)
        results = done if results is None else results.unionByName(done)
        wider = F.least(F.col("radius") + max(2, bits // 64) * 2**step, F.lit(bits)).cast("int")
        pending = state.where("not done").select("query_id", "code", wider.alias("radius"))
    raise RuntimeError("the radius did not reach all bits")


_NAMES = ("query_id", "rank", "vec_id", "score")


def _groups(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids; a row limit per vector runs before the shuffle."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _rerank(pairs: DataFrame, asked: DataFrame, grouped: DataFrame, k: int) -> DataFrame:
    """Cosine of each query with the vectors found, and the k best rows."""
    left = asked.select(F.col("query_id"), F.col("vec_id").alias("own"), F.col("vector").alias("a"))
    both = pairs.join(left, "query_id").join(grouped.select("group", F.col("vector").alias("b"), "ids"), "group")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    score = dot("a", "b") / (F.sqrt(dot("a", "a")) * F.sqrt(dot("b", "b")))
    scored = both.select("query_id", "own", score.alias("score"), F.explode("ids").alias("vec_id")).where("vec_id <> own")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("query_id").alias("number"), F.col("own").alias("query_id"), "rank", "vec_id", "score"
    )
