"""Benchmark decontamination by greedy string tiling.

A document is compared with a benchmark item if they share a seed, a run of ``minimum`` words. Runs of shared seeds on
one diagonal, found by a running Karp-Rabin hash over word hashes, are the maximal common word sequences. The longest
is marked as a tile in both texts, what it overlaps is cut back to its free parts, and so on down to ``minimum``
words. Tiles may lie in any order, so reordered passages are covered as well. A document is contaminated by an item
if its tiles cover at least ``coverage`` of the item's words.

A pair is tiled only if the shared seeds could reach that coverage; nothing else can be a tile, so nothing is lost.
Items go to all tasks in portions of at most ``PORTION`` words; a larger benchmark takes more passes over the documents.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.llm.blocks import ALNUM, blocks, range_hashes, word_hashes, words
from provwatch.llm.tables import saved
from provwatch.sources.sinks import work_folder

PORTION = 2_000_000


def _windows(codes: np.ndarray, width: int) -> np.ndarray:
    starts = np.arange(max(len(codes) - width + 1, 0))
    return range_hashes(codes, starts, starts + width)


def tiles(item: np.ndarray, text: np.ndarray, minimum: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item position, text position, words), longest first; ties to the earliest positions.

    Both texts are arrays of word hashes.
    """
    a, b = _windows(item, minimum), _windows(text, minimum)
    order = np.argsort(a, kind="stable")
    low, high = np.searchsorted(a[order], b, "left"), np.searchsorted(a[order], b, "right")
    times = high - low
    j = np.repeat(np.arange(len(b)), times)
    i = order[np.repeat(low - (np.cumsum(times) - times), times) + np.arange(len(j))]
    # consecutive seeds on a diagonal are one common sequence
    by = np.lexsort((i, j - i))
    i, j = i[by], j[by]
    new = np.ones(len(i), bool)
    new[1:] = (np.diff(i) != 1) | (np.diff(j) != 1)
    starts = np.flatnonzero(new)
    runs = np.diff(np.append(starts, len(i)))
    heap = [(-(int(n) + minimum - 1), int(i[s]), int(j[s])) for s, n in zip(starts, runs, strict=True)]
    heapq.heapify(heap)
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    out = []
    while heap:
        n, x, y = heapq.heappop(heap)
        n = -n
        taken = in_item[x : x + n] | in_text[y : y + n]
        if not taken.any():
            in_item[x : x + n] = in_text[y : y + n] = True
            out.append((x, y, n))
            continue
        free = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])).astype(np.int8)))
        for s, e in zip(free[::2].tolist(), free[1::2].tolist(), strict=True):
            if e - s >= minimum:
                heapq.heappush(heap, (s - e, x + s, y + s))
    return out


@dataclass
class Items:
    """One portion of the benchmark: word hashes of each item, and the items and positions of each seed."""

    ids: np.ndarray
    codes: list[np.ndarray]
    seeds: np.ndarray
    of: np.ndarray
    at: np.ndarray

    @classmethod
    def build(cls, rows: list[tuple[int, str]], minimum: int) -> Items:
        column = pa.array([t for _, t in rows], pa.string())
        codes: list[np.ndarray] = []
        for block in blocks(column):
            found = words(block, ~ALNUM)
            codes += np.split(word_hashes(block, found, fold=True), found.first[1:-1])
        windows = [_windows(c, minimum) for c in codes]
        seeds = np.concatenate([*windows, np.zeros(0, np.uint64)])
        of = np.repeat(np.arange(len(codes)), [len(w) for w in windows])
        at = np.concatenate([*(np.arange(len(w)) for w in windows), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(seeds, kind="stable")
        return cls(np.array([i for i, _ in rows], np.int64), codes, seeds[order], of[order], at[order])

    def candidates(self, windows: np.ndarray, minimum: int, coverage: float) -> list[int]:
        """Items whose words under shared seeds could reach the coverage."""
        hit = windows[np.isin(windows, self.seeds)] if len(self.seeds) else windows[:0]
        if not len(hit):
            return []
        hit = np.unique(hit)
        low, high = np.searchsorted(self.seeds, hit, "left"), np.searchsorted(self.seeds, hit, "right")
        spots = np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)])
        out = []
        for item in np.unique(self.of[spots]).tolist():
            covered = np.zeros(len(self.codes[item]), bool)
            for p in self.at[spots[self.of[spots] == item]].tolist():
                covered[p : p + minimum] = True
            if covered.sum() >= coverage * len(covered) - 1e-9:
                out.append(item)
        return out


_FOUND = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int64())]))


def _match(shared, minimum: int, coverage: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for batch in batches:
            for block in blocks(batch.column(names.index("text"))):
                found = words(block, ~ALNUM)
                codes = word_hashes(block, found, fold=True)
                all_windows = _windows(codes, minimum)
                seeded = np.isin(all_windows, items.seeds)
                matches = []
                for k in range(block.last - block.first):
                    a, b = found.first[k], found.first[k + 1]
                    mine: list[dict] = []
                    if b - a >= minimum and seeded[a : b - minimum + 1].any():
                        for item in items.candidates(all_windows[a : b - minimum + 1], minimum, coverage):
                            laid = tiles(items.codes[item], codes[a:b], minimum)
                            share = sum(n for _, _, n in laid) / len(items.codes[item])
                            if share >= coverage - 1e-9:
                                mine.append({"item_id": int(items.ids[item]), "coverage": share, "tiles": len(laid)})
                    matches.append(mine)
                rows = batch.slice(block.first, block.last - block.first)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(matches, _FOUND)], names=[*names, "matched"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, minimum: int = 5, coverage: float = 0.5) -> DataFrame:
    """Every row of ``docs`` with the benchmark items it holds and whether there are any.

    ``items`` is an array of (item_id, coverage, tiles) in the order of item_id, ``contaminated`` says whether it has
    entries. ``benchmark`` has item_id and text; items with a null text or id or fewer than ``minimum`` words cannot
    be found and take no part, nor do documents with a null, empty or shorter text match anything. Words are runs of
    letters and digits, lower-cased. Repeated rows are judged alike. Columns named items or contaminated are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("items", "contaminated", "matched")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    items = saved(items, work_folder(spark, "benchmark"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    portions = max(1, -(-size // (4 * PORTION)))  # four characters a word, at least
    names, out = docs.columns, docs.withColumn("items", F.array().cast(_DDL))
    for k in range(portions):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(portions)) == k)
        portion = Items.build([(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()], minimum)
        shared = spark.sparkContext.broadcast(portion)
        names = out.columns
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
        out = out.mapInArrow(_match(shared, minimum, coverage, names), f"{ddl}, matched {_DDL}")
        out = out.withColumn("items", F.concat("items", "matched")).drop("matched")
    return out.withColumn("items", F.array_sort("items")).withColumn("contaminated", F.size("items") > 0)


_DDL = "array<struct<item_id:bigint,coverage:double,tiles:bigint>>"
