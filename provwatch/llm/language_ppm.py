"""Language identification by prediction by partial matching.

Each language has a context tree of bytes: how often each byte followed each context of 0 to 3 bytes. A byte seen in
the longest known context costs log2((n + t) / c) bits (c: its count there, n: the context's total, t: the distinct
bytes seen there); otherwise the escape costs log2((n + t) / t) and the next shorter context is asked, down to 8 bits
for any byte (escape method C, no exclusions). The statistics are frozen after training; a text's code length under
a language is the exact sum over all its bytes, and the shortest code wins.

Counting covers every training text. The tree is the same for tasks that score, so its size is a parameter: at most
the ``nodes`` most frequent nodes of all languages together are kept, as whole classes of about equal counts. A node's
suffix is at least as frequent, so kept nodes always have their shorter contexts. No more rows than that reach the
driver and the broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.llm.blocks import LOWER, Block, blocks
from provwatch.llm.tables import most_frequent, saved
from provwatch.sources.sinks import work_folder

NODES = 400_000
_ORDERS = 4  # contexts of 0 to 3 bytes
_HELD = 1_500_000  # distinct n-grams a task holds before it emits them


def _grams(block: Block) -> np.ndarray:
    """Each byte with the three before it in its text (0 before the text begins), A-Z folded."""
    data = LOWER[block.data].astype(np.uint32)
    out = data.copy()
    starts, ends = block.offsets[:-1], block.offsets[1:]
    for back in (1, 2, 3):
        before = np.zeros_like(data)
        before[back:] = data[:-back]
        for k in range(back):
            at = starts + k
            before[at[at < ends]] = 0
        out |= before << np.uint32(8 * back)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

    def emit() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, counts = merged(parts)
            for a in range(0, len(keys), 100_000):
                k, n = keys[a : a + 100_000], counts[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(k)), pa.array(k.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
                )

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for block in blocks(batch.column("text")):
            grams, lengths = _grams(block), np.diff(block.offsets)
            here = langs[block.first : block.last]
            for lang in set(here):
                mine = np.repeat(np.array([x == lang for x in here]), lengths)
                keys, counts = np.unique(grams[mine], return_counts=True)
                parts = held.setdefault(lang, [])
                parts.append((keys, counts))
                size += len(keys)
                if len(parts) >= 16:
                    size -= sum(len(k) for k, _ in parts)
                    held[lang] = [merged(parts)]
                    size += len(held[lang][0][0])
            if size > _HELD:
                yield from emit()
                held, size = {}, 0
    yield from emit()


@dataclass
class Trees:
    """Frozen code lengths in bits: per order, for known n-grams and for escapes out of known contexts."""

    languages: list[str]
    grams: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @classmethod
    def build(cls, languages: list[str], nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Trees:
        """From (n-gram, language number, count) arrays of each order."""
        trees = cls(languages, [], [], [], [])
        for order, (keys, langs, counts) in enumerate(nodes):
            grams, at = np.unique(keys, return_inverse=True)
            table = np.zeros((len(grams), len(languages)))
            table[at, langs] = counts
            contexts, of = np.unique(grams >> 8, return_inverse=True)
            total, kinds = np.zeros((len(contexts), len(languages))), np.zeros((len(contexts), len(languages)))
            np.add.at(total, of, table)
            np.add.at(kinds, of, table > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escapes = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
                seen = np.log2((total + kinds)[of] / table)
            shorter = trees.cost(grams & ((1 << 8 * order) - 1), order - 1)
            trees.bits.append(np.where(table > 0, seen, escapes[of] + shorter))
            trees.grams.append(grams)
            trees.contexts.append(contexts)
            trees.escapes.append(escapes)
        return trees

    def cost(self, keys: np.ndarray, order: int = _ORDERS - 1) -> np.ndarray:
        """Bits of each n-gram's last byte after the others, per language."""
        if order < 0:
            return np.full((len(keys), len(self.languages)), 8.0)
        out = np.empty((len(keys), len(self.languages)))
        at, found = _find(self.grams[order], keys)
        out[found] = self.bits[order][at[found]]
        rest = keys[~found]
        if len(rest):
            at, known = _find(self.contexts[order], rest >> 8)
            escape = np.where(known[:, None], self.escapes[order][at], 0.0) if len(self.contexts[order]) else 0.0
            out[~found] = escape + self.cost(rest & ((1 << 8 * order) - 1), order - 1)
        return out

    def lengths(self, block: Block) -> np.ndarray:
        """Code length of each text of a block under each language."""
        grams = _grams(block).astype(np.int64)
        sums = np.zeros((len(grams) + 1, len(self.languages)))
        np.cumsum(self.cost(grams), axis=0, out=sums[1:])
        return sums[block.offsets[1:]] - sums[block.offsets[:-1]]


def _find(ordered: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ordered):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return at, ordered[at] == keys


def train(texts: DataFrame, nodes: int = NODES) -> Trees:
    """Trees of the languages in ``lang`` from all of ``texts``; rows with a null text or lang teach nothing."""
    folder = work_folder(texts.sparkSession, "language-trees")
    texts = texts.where("lang is not null and text is not null").select("text", "lang")
    counted = texts.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    orders = F.explode(
        F.array(*(F.struct(F.lit(k).alias("k"), F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("key")) for k in range(_ORDERS)))
    )
    tree = counted.select("lang", "n", orders.alias("o")).groupBy("lang", "o.k", "o.key").agg(F.sum("n").alias("n"))
    tree = saved(tree, f"{folder}/tree")
    kept = most_frequent(tree, "n", nodes).toPandas()
    languages = sorted(kept["lang"].unique())
    number = kept["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    parts = []
    for k in range(_ORDERS):
        mine = (kept["k"] == k).to_numpy()
        parts.append((kept["key"].to_numpy()[mine], number[mine].astype(np.int64), kept["n"].to_numpy()[mine]))
    return Trees.build(languages, parts)


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """Every row of ``docs`` with lang_pred and score (the winner's share of 2 to the minus code lengths).

    A null text, or one without any letter, is ``und`` with score 0; so is every text if no language was learned.
    Equal code lengths go to the first language in alphabetical order. Columns named lang_pred or score are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column(names.index("text"))
            for block in blocks(column, 1 << 19):
                n = block.last - block.first
                spoken = np.array([bool(t) and any(map(str.isalpha, t)) for t in column.slice(block.first, n).to_pylist()], bool)
                if model.languages:
                    bits = model.lengths(block)
                    best = bits.argmin(1)
                    share = 1 / np.exp2(np.clip(bits.min(1, keepdims=True) - bits, -1000, 0)).sum(1)
                    langs = [model.languages[i] if s else "und" for i, s in zip(best, spoken, strict=True)]
                else:
                    langs, share = ["und"] * n, np.zeros(n)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(block.first, n) for c in batch.columns), pa.array(langs, pa.string()), pa.array(np.where(spoken, share, 0.0))],
                    names=[*names, "lang_pred", "score"],
                )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{ddl}, lang_pred string, score double")
