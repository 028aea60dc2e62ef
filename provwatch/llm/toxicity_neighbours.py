"""Toxicity by the nearest labelled examples.

Texts and examples are TF-IDF vectors (1 + ln tf, times ln((N + 1) / df)) over all words of the examples; document
frequencies cover all documents. Words that mark toxic examples by a likelihood-ratio test weigh ``MARKING`` times as
much, so that they lead the search, but none is dropped. The nearest examples by cosine are found exactly: a text's
words of most impact are summed over an inverted index, a word's largest weight in a block of examples bounds what the
other words can add, and only examples whose bound reaches the k-th best are completed. Neighbours vote with the fourth power of their cosine; votes become probabilities by an isotonic fit on
the examples themselves, each left out of its own neighbours.

The classifier learns from a bounded sample: at most ``EXAMPLES`` labelled rows, half of each label where there are
enough, chosen by a hash of the id. So the examples and their index are bounded.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.llm.blocks import ALNUM, Block, blocks, word_hashes, words
from provwatch.llm.tables import saved
from provwatch.sources.sinks import work_folder

EXAMPLES = 6_000
MARKING = 8.0  # weight of a marking word against another of equal idf
NEIGHBOURS = 15
_MIN_G2 = 24.0  # likelihood ratio; about one in a million words passes by chance
_BLOCK = 64
_LEADING = 8  # heaviest terms that decide which examples share a block
_KNOWN_VECTORS = 100_000


def _terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word (letters and digits, lower-cased) of a block."""
    found = words(block, ~ALNUM)
    return found.rows, word_hashes(block, found, fold=True).view(np.int64)


def _term_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: in how many examples of either label each word occurs."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
        for block in blocks(batch.column("text")):
            rows, keys = _terms(block)
            if not len(keys):
                continue
            terms, at = np.unique(keys, return_inverse=True)
            pairs = np.unique(at * (1 << 20) + rows)
            term, marked = pairs >> 20, toxic[block.first : block.last][pairs & ((1 << 20) - 1)]
            n1 = np.bincount(term, marked, len(terms)).astype(np.int64)
            n = np.bincount(term, minlength=len(terms))
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n1), pa.array(n - n1)], names=["term", "n1", "n0"])


def _counts(block: Block, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term number and frequency of the vocabulary's words in a block."""
    rows, keys = _terms(block)
    if not len(keys) or not len(vocabulary):
        return (np.zeros(0, np.int64),) * 3
    at = np.minimum(np.searchsorted(vocabulary, keys), len(vocabulary) - 1)
    hit = vocabulary[at] == keys
    pairs, tf = np.unique(rows[hit].astype(np.int64) * len(vocabulary) + at[hit], return_counts=True)
    return pairs // len(vocabulary), pairs % len(vocabulary), tf


def _frequencies(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        df, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for block in blocks(batch.column("text")):
                df += np.bincount(_counts(block, vocabulary)[1], minlength=len(vocabulary))
        used = np.append(np.flatnonzero(df), -1)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.append(df[df > 0], n))], names=["term", "df"])

    return run


def _vectors(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for block in blocks(batch.column("text")):
                row, term, tf = _counts(block, vocabulary)
                n = block.last - block.first
                cuts = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(block.first, n) for c in ("doc_id", "toxic")),
                        pa.ListArray.from_arrays(cuts, pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int32())),
                    ],
                    names=["doc_id", "toxic", "terms", "tf"],
                )

    return run


def _ranges(starts: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the terms' entries one after another, and how many each term has."""
    first, sizes = starts[terms], starts[terms + 1] - starts[terms]
    return np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes), sizes


@dataclass
class BlockMaxIndex:
    """Distinct example vectors, in blocks of similar ones, with each term's largest weight per block."""

    idf: np.ndarray
    firsts: np.ndarray  # where each vector begins in the next two
    terms: np.ndarray  # term numbers
    units: np.ndarray  # and unit weights, vector after vector
    digests: dict[bytes, int]  # the number of each vector
    labels: np.ndarray  # weight of clean and toxic examples per vector
    evidence: list[list[tuple[int, int]]]  # up to three (doc_id, toxic) per vector
    cells: np.ndarray  # per term, where its blocks begin
    cell_blocks: np.ndarray  # blocks that hold the term
    maxima: np.ndarray  # and its largest weight there
    starts: np.ndarray  # per term, where its postings begin
    rows: np.ndarray  # postings: numbers of vectors
    weights: np.ndarray  # and their weights

    @staticmethod
    def unit(terms: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(tf)) * idf[terms]
        norm = math.sqrt(float(w @ w))
        return (terms, w / norm) if norm > 0 else (terms[:0], w[:0])

    @staticmethod
    def digest(terms: np.ndarray, tf: np.ndarray) -> bytes:
        return hashlib.blake2b(np.concatenate([terms, tf]).astype(np.int64).tobytes(), digest_size=16).digest()

    @classmethod
    def build(cls, ids: np.ndarray, toxic: np.ndarray, firsts: np.ndarray, terms: np.ndarray, tf: np.ndarray, idf: np.ndarray, weight: dict[int, float]):
        """From examples in arrays: terms and tf of example i lie from firsts[i] on. Those without terms are left out."""
        merged: dict[bytes, list] = {}
        for i in np.lexsort((toxic, ids)).tolist():
            mine = slice(firsts[i], firsts[i + 1])
            t, w = cls.unit(terms[mine], tf[mine], idf)
            if len(t):
                heavy = t[np.argsort(-w, kind="stable")[:_LEADING]]
                entry = merged.setdefault(cls.digest(t, tf[mine]), [tuple(heavy.tolist()), i, [0.0, 0.0], []])
                entry[2][toxic[i]] += weight[int(toxic[i])]
                if len(entry[3]) < 3:
                    entry[3].append((int(ids[i]), int(toxic[i])))
        # sorted by their heaviest terms, so that a block's examples share terms and bounds are tight
        order = sorted(merged, key=lambda d: (merged[d][0], d))
        rows = [merged[d] for d in order]
        sizes = np.array([firsts[r[1] + 1] - firsts[r[1]] for r in rows], np.int64)
        starts_of = np.concatenate([[0], np.cumsum(sizes)])
        all_terms, units = np.zeros(starts_of[-1], np.int32), np.zeros(starts_of[-1])
        for k, r in enumerate(rows):
            mine = slice(firsts[r[1]], firsts[r[1] + 1])
            all_terms[starts_of[k] : starts_of[k + 1]], units[starts_of[k] : starts_of[k + 1]] = cls.unit(terms[mine], tf[mine], idf)
        numbers = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        n_blocks = max(1, -(-len(rows) // _BLOCK))
        cells, of = np.unique(all_terms.astype(np.int64) * n_blocks + numbers // _BLOCK, return_inverse=True)
        maxima = np.zeros(len(cells))
        np.maximum.at(maxima, of, units)
        cell_starts, cell_blocks = np.searchsorted(cells // n_blocks, np.arange(len(idf) + 1)), (cells % n_blocks).astype(np.int32)
        by_term = np.argsort(all_terms, kind="stable")
        starts = np.searchsorted(all_terms[by_term], np.arange(len(idf) + 1))
        labels = np.array([r[2] for r in rows]).reshape(-1, 2)
        evidence, digests = [r[3] for r in rows], {d: k for k, d in enumerate(order)}
        postings = numbers[by_term], units[by_term]
        return cls(idf, starts_of, all_terms, units, digests, labels, evidence, cell_starts, cell_blocks, maxima, starts, *postings)

    def __len__(self) -> int:
        return len(self.labels)

    def vector(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        mine = slice(self.firsts[i], self.firsts[i + 1])
        return self.terms[mine], self.units[mine]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k vectors of largest cosine, exactly: numbers and cosines, best first, ties to smaller numbers."""
        n = len(self)
        at, sizes = _ranges(self.cells, terms)
        by_block = np.zeros((len(terms), -(-n // _BLOCK)))
        by_block[np.repeat(np.arange(len(terms)), sizes), self.cell_blocks[at]] = self.maxima[at] * np.repeat(weights, sizes)
        impact = by_block.max(1)
        order = np.argsort(impact, kind="stable")
        few = int(np.searchsorted(np.cumsum(impact[order]), 0.25 * impact.sum()))
        rest, lead = order[:few], order[few:]
        scores = self._sums(terms[lead], weights[lead])
        if len(rest):
            least = np.partition(scores, n - k)[n - k] if n >= k else 0.0
            bounds = scores + np.repeat(by_block[rest].sum(0), _BLOCK)[:n]
            open_ = np.flatnonzero((bounds >= least - 1e-9) & (bounds > 0))
            if len(open_) > n // 32:
                scores += self._sums(terms[rest], weights[rest])
            else:
                asked = np.zeros(len(self.idf))
                asked[terms] = weights
                scores = np.zeros(n)
                for i in open_:
                    t, w = self.vector(i)
                    scores[i] = asked[t] @ w
        found = np.flatnonzero(scores > 0)
        if len(found) > k:
            found = found[scores[found] >= np.partition(scores[found], len(found) - k)[len(found) - k]]
        found = found[np.lexsort((found, -scores[found]))[:k]]
        return found, scores[found]

    def _sums(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Products with the given terms, summed per vector."""
        at, sizes = _ranges(self.starts, terms)
        return np.bincount(self.rows[at], self.weights[at] * np.repeat(weights, sizes), len(self))

    def vote(self, near: np.ndarray, cosine: np.ndarray, without: tuple[int, int, float] | None = None) -> float | None:
        """Weighted share of toxic among the neighbours; ``without`` takes one example (vector, label, weight) out."""
        labels = self.labels[near].copy()
        if without:
            labels[near == without[0], without[1]] -= without[2]
        mass = (cosine**4)[:, None] * np.maximum(labels, 0)
        # many copies of one vector weigh as their logarithm, so that the next nearest are heard too
        size = labels.sum(1).clip(0)
        mass *= (np.log1p(size) / np.where(size > 0, size, 1))[:, None]
        clean, toxic = mass.sum(0)
        # summed per label, so that neighbours of one label vote exactly 0 or 1 and meet the edges of the fit
        return float(toxic / (clean + toxic)) if clean + toxic > 1e-12 else None


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing weighted fit: left edges and values (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for xi, yi, wi in zip(x[order], y[order], w[order], strict=True):
        if pools and pools[-1][3] == xi:
            pools[-1][1] += yi * wi
            pools[-1][2] += wi
        else:
            pools.append([xi, yi * wi, wi, xi])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1][1] += last[1]
            pools[-1][2] += last[2]
            pools[-1][3] = last[3]
    return np.array([p[0] for p in pools]), np.array([(p[1] + 0.01) / (p[2] + 0.02) for p in pools])


@dataclass
class Model:
    """Words and examples are broadcast once; what is fitted on them travels with the task."""

    vocabulary: Broadcast
    index: Broadcast | None
    edges: np.ndarray
    values: np.ndarray
    unmarked: float  # probability for texts without neighbours

    def judge(self, terms: np.ndarray, tf: np.ndarray) -> tuple[float, list[tuple[int, int, float]]]:
        """Score and evidence (doc_id, toxic, cosine) of one text."""
        if self.index is None or not len(terms):
            return self.unmarked, []
        index = self.index.value
        t, w = BlockMaxIndex.unit(terms, tf, index.idf)
        near, cosine = index.nearest(t, w, NEIGHBOURS)
        vote = index.vote(near, cosine)
        if vote is None or not len(self.edges):
            return self.unmarked, []
        at = max(int(np.searchsorted(self.edges, vote, "right")) - 1, 0)
        shown = [(d, x, float(c)) for i, c in zip(near, cosine, strict=True) for d, x in index.evidence[i]]
        return float(self.values[at]), shown[:3]


def _votes(index: Broadcast, vocabulary: Broadcast, weight: dict[int, float]):
    """The vote for each example, without the example itself; none if its words or neighbours are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool: BlockMaxIndex = index.value
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for block in blocks(batch.column("text")):
                row, term, tf = _counts(block, vocabulary.value)
                cuts = np.searchsorted(row, np.arange(block.last - block.first + 1))
                votes, labels = [], []
                for label, a, b in zip(toxic[block.first : block.last].tolist(), cuts[:-1], cuts[1:], strict=True):
                    t, w = BlockMaxIndex.unit(term[a:b], tf[a:b], tool.idf)
                    own = tool.digests.get(BlockMaxIndex.digest(t, tf[a:b])) if len(t) else None
                    vote = None if own is None else tool.vote(*tool.nearest(t, w, NEIGHBOURS), (own, label, weight[label]))
                    if vote is not None:
                        votes.append(vote)
                        labels.append(label)
                yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), pa.array(labels, pa.int32())], names=["vote", "toxic"])

    return run


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """Learn from ``labels`` (doc_id, toxic 0/1) of ``docs``; other labels and null ones teach nothing.

    Only labels decide what is learned: pass those that may be used. Document frequencies come from all of ``docs``.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "toxicity")
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    size = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {x: min(size.get(x, 0), examples - min(size.get(1 - x, 0), examples // 2)) for x in (0, 1)}
    order = F.xxhash64("doc_id")
    chosen = labels.where("toxic = 1").orderBy(order, "doc_id").limit(share[1])
    chosen = chosen.unionAll(labels.where("toxic = 0").orderBy(order, "doc_id").limit(share[0]))
    # at most ``examples`` rows of two numbers
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = saved(sample, f"{folder}/examples")

    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    found = sample.mapInArrow(_term_labels, "term long, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("a"), F.sum("n0").alias("b"))
    part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    a, b, both = F.col("a"), F.col("b"), float(max(n1 + n0, 1))
    e1, e0 = (a + b) * (n1 / both), (a + b) * (n0 / both)
    f1, f0 = (both - a - b) * (n1 / both), (both - a - b) * (n0 / both)
    g2 = 2 * (part(a, e1) + part(b, e0) + part(n1 - a, f1) + part(n0 - b, f0))
    marks = (F.col("g2") >= _MIN_G2) & (a * n0 > b * n1)
    # the words of a bounded number of examples, as columns
    known_words = found.withColumn("g2", g2).select("term", F.coalesce(marks, F.lit(False)).alias("marks")).orderBy("term").toArrow()
    vocabulary = known_words["term"].to_numpy()
    idf = np.where(known_words["marks"].to_numpy(), MARKING, 1.0)
    words_ = spark.sparkContext.broadcast(vocabulary)
    df = docs.select("text").mapInArrow(_frequencies(words_), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = df.toArrow()  # one row a vocabulary word
    counts = np.ones(len(vocabulary) + 1, np.int64)
    counts[df["term"].to_numpy()] = df["df"].to_numpy()  # the last one, -1, is the number of documents
    total = int(counts[-1]) if len(df) else 0
    idf *= np.log((total + 1) / counts[:-1])
    # weights undo the even choice of the two labels
    weight = {x: size.get(x, 0) / totals[x] if totals.get(x) else 1.0 for x in (0, 1)}
    rows = sample.mapInArrow(_vectors(words_), "doc_id long, toxic int, terms array<int>, tf array<int>").toArrow().combine_chunks()
    toxic = rows["toxic"].to_numpy()
    lists = rows["terms"].combine_chunks() if len(rows) else pa.array([], pa.list_(pa.int32()))
    firsts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    bare = toxic[np.diff(firsts) == 0]
    mass = np.array([weight[0] * (bare == 0).sum(), weight[1] * (bare == 1).sum()])
    unmarked = float((mass[1] + 0.01) / (mass.sum() + 0.1)) if len(bare) else 0.1
    if not firsts[-1]:
        return Model(words_, None, np.zeros(0), np.zeros(0), min(unmarked, 1.0))
    tf = rows["tf"].combine_chunks().flatten().to_numpy()
    index = BlockMaxIndex.build(rows["doc_id"].to_numpy(), toxic, firsts, lists.flatten().to_numpy(), tf, idf, weight)
    del rows, lists, tf, known_words, df
    shared = spark.sparkContext.broadcast(index)
    del index
    votes = sample.mapInArrow(_votes(shared, words_, weight), "vote double, toxic int").toArrow()
    truth = votes["toxic"].to_numpy()
    edges, values = _isotonic(votes["vote"].to_numpy(), truth.astype(float), np.where(truth == 1, weight[1], weight[0]))
    return Model(words_, shared, edges, values, min(unmarked, 1.0))


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))


def score_texts(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Every row of ``docs`` with score (0 to 1), predicted (1 if score >= threshold) and evidence (nearest examples).

    A null or empty text, and one without any word of an example, gets the share of toxic rows among such examples. Columns
    named score, predicted or evidence are replaced; all others are kept.
    """
    docs = docs.drop("score", "predicted", "evidence")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = model
        known: dict[bytes, tuple] = {}
        for batch in batches:
            for block in blocks(batch.column(names.index("text"))):
                row, term, tf = _counts(block, tool.vocabulary.value)
                n = block.last - block.first
                cuts = np.searchsorted(row, np.arange(n + 1))
                scores, shown = [], []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    key = hashlib.blake2b(np.concatenate([term[a:b], tf[a:b]]).tobytes(), digest_size=16).digest()
                    judged = known.get(key)
                    if judged is None:
                        if len(known) > _KNOWN_VECTORS:
                            known.clear()
                        judged = known[key] = tool.judge(term[a:b], tf[a:b])
                    scores.append(judged[0])
                    shown.append([{"doc_id": d, "toxic": x, "cosine": c} for d, x, c in judged[1]])
                score = np.array(scores)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(block.first, n) for c in batch.columns),
                        pa.array(score),
                        pa.array((score >= threshold).astype(np.int32)),
                        pa.array(shown, _EVIDENCE),
                    ],
                    names=[*names, "score", "predicted", "evidence"],
                )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{ddl}, score double, predicted int, evidence array<struct<doc_id:long,toxic:int,cosine:double>>")
