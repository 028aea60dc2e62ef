"""Language model scores from a subword lattice.

The pieces of an existing vocabulary weight all segmentations of a word (with the blank before it): the word's
probability is the sum over them, by a forward recursion in log space. The vocabulary's scores (merge ranks) give the
first weights; expectation maximisation over all distinct training words gives the final ones.

Besides the paths over pieces, a word's lattice has one arc for the whole word, weighted by its training count. The
paths over pieces weigh what the base adds to every count: not one, but ``exp(slope * (log_p - centre))``, where log_p
is the word's probability over all segmentations. ``slope`` says how fast the odds that a training word is seen twice
rather than once grow with log_p (a logistic fit, Good and Turing's rate by spelling), ``centre`` is the mean log_p of
words seen once: a word spelled like those gets one count, as in the base, one of likelier pieces more. A fit to the
tokens' own likelihood cannot set these weights, as it prefers equal counts for all unseen words. The end has the
whole-word arc only. A text's probability is a mixture of lattices: one with these arcs, and one for each class of
training texts (the language, say), with the class's counts smoothed towards them. The class of a text that is scored is
never looked at. Like the base, the score is not normalised over all unseen words; ``piece_score``, the probability over
the pieces alone, is.

Words are handled as types: every distinct word of the corpus is counted, segmented and scored once. The
``FREQUENT`` most frequent types go to all tasks; counts and scores of all other words meet their documents in a
join by word hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.llm.blocks import LOWER, blocks, range_hashes, word_hashes, words
from provwatch.llm.tables import most_frequent, saved
from provwatch.llm.tokenizers_public import TokenizerFile
from provwatch.sources.sinks import work_folder

FREQUENT = 100_000
ROUNDS = 2
_LONG = 48  # bytes; longer words are segmented one by one
_ALPHA = 0.05  # added to every piece's expected count
CLASSES = 16  # the most frequent ones; texts of others teach the base and the pieces
_SMOOTHING = 5_000.0  # tokens that the base weighs in a class
_SLOPE = (0.15, 1_000.0)  # of added counts: what a corpus of few words is held to, and how firmly
_TYPES = 400_000  # word types a task holds before it emits them


def _byte_values(data: np.ndarray) -> np.ndarray:
    return data.astype(np.uint64) + np.uint64(0x9E37)


@dataclass
class Lattice:
    """Pieces as bytes (blank mark as a space) and their log probabilities; every byte is a piece too."""

    pieces: list[bytes]
    weights: np.ndarray
    end: float

    @classmethod
    def of_model(cls, tokenizer: TokenizerFile) -> Lattice:
        """First weights: Zipf's law over the ranks that the model's scores are."""
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_proto=tokenizer.content)
        scores = {bytes([b]): -1e6 for b in range(256)}
        for i in range(m.get_piece_size()):
            if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                # bytes, as words are lower-cased first: pieces with A-Z cannot occur
                piece = m.id_to_piece(i).replace("▁", " ").encode()
                if not any(65 <= b <= 90 for b in piece):
                    scores[piece] = max(m.get_score(i), scores.get(piece, -1e9))
        pieces = sorted(scores)
        mass = np.array([1 / (10 - scores[p]) for p in pieces])
        return cls(pieces, np.log(mass / mass.sum() * 0.99), math.log(0.01))

    def reweighted(self, expected: np.ndarray, ends: int) -> Lattice:
        mass = expected + _ALPHA
        total = mass.sum() + ends + _ALPHA
        return Lattice(self.pieces, np.log(mass / total), math.log((ends + _ALPHA) / total))

    @cached_property
    def _index(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per length: sorted hashes of the pieces and their numbers."""
        by: dict[int, list[int]] = {}
        for i, p in enumerate(self.pieces):
            by.setdefault(len(p), []).append(i)
        out = {}
        for n, numbers in by.items():
            data = np.frombuffer(b"".join(self.pieces[i] for i in numbers), np.uint8)
            starts = np.arange(len(numbers)) * n
            hashes = range_hashes(_byte_values(data), starts, starts + n)
            order = np.argsort(hashes)
            out[n] = hashes[order], np.array(numbers)[order]
        return out

    def _arcs(self, group: list[bytes]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of the arcs in words of one length, each with a blank before it."""
        n, m = len(group[0]) + 1, len(group)
        data = np.frombuffer(b"".join(b" " + w for w in group), np.uint8)
        codes = _byte_values(data)
        base = np.arange(m) * n
        arcs = []
        for length, (hashes, numbers) in self._index.items():
            if length > n:
                continue
            starts = (base[:, None] + np.arange(n - length + 1)).ravel()
            keys = range_hashes(codes, starts, starts + length)
            at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
            hit = np.flatnonzero(hashes[at] == keys)
            row, start = starts[hit] // n, starts[hit] % n
            piece = numbers[at[hit]]
            order = np.argsort(start, kind="stable")
            cuts = np.searchsorted(start[order], np.arange(n - length + 2))
            for i in range(n - length + 1):
                part = order[cuts[i] : cuts[i + 1]]
                if len(part):
                    arcs.append((i, i + length, row[part], piece[part]))
        return arcs

    def _forward(self, arcs, m: int, n: int) -> np.ndarray:
        alpha = np.full((n + 1, m), -np.inf)
        alpha[0] = 0
        for start, end, rows, piece in sorted(arcs, key=lambda x: x[1]):
            # an arc's rows are distinct, so plain indexing adds each once
            alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[start, rows] + self.weights[piece])
        return alpha

    def log_probabilities(self, types: list[bytes], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Marginal log probability of each word; with ``counts``, also the expected uses of each piece."""
        out, expected = np.zeros(len(types)), np.zeros(len(self.pieces))
        lengths = np.array([len(w) for w in types])
        for length in np.unique(lengths):
            members = np.flatnonzero(lengths == length)
            if length > _LONG:
                for k in members:
                    out[k] = self._long(types[k], expected, None if counts is None else float(counts[k]))
                continue
            for a in range(0, len(members), 4096):
                part = members[a : a + 4096]
                arcs, n = self._arcs([types[k] for k in part]), int(length) + 1
                alpha = self._forward(arcs, len(part), n)
                out[part] = alpha[n]
                if counts is None:
                    continue
                beta = np.full((n + 1, len(part)), -np.inf)
                beta[n] = 0
                for start, end, rows, piece in sorted(arcs, key=lambda x: -x[0]):
                    beta[start, rows] = np.logaddexp(beta[start, rows], beta[end, rows] + self.weights[piece])
                for start, end, rows, piece in arcs:
                    share = np.exp(alpha[start, rows] + self.weights[piece] + beta[end, rows] - alpha[n, rows])
                    expected += np.bincount(piece, share * counts[part][rows], len(expected))
        return out, expected

    def _long(self, word: bytes, expected: np.ndarray, count: float | None) -> float:
        text = b" " + word
        arcs: list[list[tuple[int, int]]] = [[] for _ in range(len(text) + 1)]
        for start, end, _, piece in self._long_arcs(text):
            arcs[end].append((start, piece))
        w = self.weights
        alpha = [0.0] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            values = [alpha[s] + w[p] for s, p in arcs[end]]
            top = max(values)
            alpha[end] = top + math.log(sum(math.exp(v - top) for v in values))
        if count is not None:
            beta = np.full(len(text) + 1, -np.inf)
            beta[-1] = 0
            for end in range(len(text), 0, -1):
                for s, p in arcs[end]:
                    beta[s] = np.logaddexp(beta[s], beta[end] + w[p])
                    expected[p] += count * math.exp(alpha[s] + w[p] + beta[end] - alpha[-1])
        return alpha[-1]

    def _long_arcs(self, text: bytes) -> Iterator[tuple[int, int, int, int]]:
        codes = _byte_values(np.frombuffer(text, np.uint8))
        for length, (hashes, numbers) in self._index.items():
            if length <= len(text):
                starts = np.arange(len(text) - length + 1)
                keys = range_hashes(codes, starts, starts + length)
                at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
                for s in np.flatnonzero(hashes[at] == keys):
                    yield int(s), int(s) + length, 0, int(numbers[at[s]])


def _types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words with their count in training texts and in all texts."""
    held: dict[tuple[int, int], list] = {}

    def emit() -> pa.RecordBatch:
        keys = np.fromiter((k for k, _ in held), np.uint64, len(held)).view(np.int64)
        classes = [k for _, k in held]
        rows = list(held.values())
        held.clear()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys),
                pa.array([r[0] for r in rows], pa.binary()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()),
                pa.array(classes, pa.int32()),
            ],
            names=["word_hash", "word", "c", "n", "class"],
        )

    for batch in batches:
        taught = batch.column("taught").to_numpy(zero_copy_only=False)
        classes = batch.column("class").to_numpy()
        for block in blocks(batch.column("text")):
            found = words(block)
            if not len(found.starts):
                continue
            hashes, of = word_hashes(block, found, fold=True), classes[block.first : block.last][found.rows]
            learned = taught[block.first : block.last][found.rows]
            data = LOWER[block.data].tobytes()
            for kind in np.unique(of).tolist():
                mine = np.flatnonzero(of == kind)
                keys, first, at = np.unique(hashes[mine], return_index=True, return_inverse=True)
                n = np.bincount(at, minlength=len(keys))
                c = np.bincount(at, learned[mine], len(keys)).astype(np.int64)
                spans = zip(found.starts[mine[first]].tolist(), found.ends[mine[first]].tolist(), strict=True)
                for key, (a, b), x, y in zip(keys.tolist(), spans, c.tolist(), n.tolist(), strict=True):
                    row = held.get((key, kind))
                    if row is None:
                        held[key, kind] = [data[a:b], x, y]
                    else:
                        row[1] += x
                        row[2] += y
            if len(held) > _TYPES:
                yield emit()
    if held:
        yield emit()


def _expect(shared):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice: Lattice = shared.value
        total = np.zeros(len(lattice.pieces))
        for batch in batches:
            counts = np.ones(batch.num_rows)
            total += lattice.log_probabilities(batch.column("word").to_pylist(), counts)[1]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "expected"])

    return expect


def _score_types(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice: Lattice = shared.value
        for batch in batches:
            values = lattice.log_probabilities(batch.column("word").to_pylist())[0]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("word_hash", "c", "n", "of_class")), pa.array(values)],
                names=["word_hash", "c", "n", "of_class", "log_p"],
            )

    return score


def _frequent_parts(shared, names: list[str]):
    """Per document: sums over frequent words, and the other words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, values = shared.value
        for batch in batches:
            for block in blocks(batch.column(names.index("text"))):
                found, rows = words(block), block.last - block.first
                keys = word_hashes(block, found, fold=True).view(np.int64)
                at = np.minimum(np.searchsorted(hashes, keys), max(len(hashes) - 1, 0))
                hit = hashes[at] == keys if len(hashes) else np.zeros(len(keys), bool)
                row, at = found.rows[hit], at[hit]
                sums = [np.bincount(row, v[at] if len(at) else None, rows).astype(float) for v in values]
                rest_row, rest = found.rows[~hit], keys[~hit]
                cuts = np.searchsorted(rest_row, np.arange(rows + 1))
                rare = []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    word, times = np.unique(rest[a:b], return_counts=True)
                    rare.append([{"word_hash": w, "times": t} for w, t in zip(word.tolist(), times.tolist(), strict=True)])
                keep = [batch.column(i).slice(block.first, rows) for i, c in enumerate(names) if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*keep, pa.array(found.count()), *map(pa.array, sums), pa.array(rare, _RARE)],
                    names=[*(c for c in names if c != "text"), "words", *(f"sum_{k}" for k in range(len(sums))), "rare"],
                )

    return run


_RARE = pa.list_(pa.struct([("word_hash", pa.int64()), ("times", pa.int64())]))


def score_texts(
    docs: DataFrame, tokenizer: TokenizerFile, taught: str = "taught", classes: str | None = None, rounds: int = ROUNDS
) -> DataFrame:
    """Score every whole text after learning from the rows whose boolean column ``taught`` is true.

    ``classes`` names a column that divides the training texts; it is read of those only. A null class is none.

    Returns the columns of ``docs`` but text and ``taught``, and n_tokens (words and one end), n_known (tokens seen in
    training), train_tokens, base_score (add-one word unigram, log10), score (lattice with whole-word arcs, log10) and
    piece_score (pieces only, log10). A null text is empty: its only token is the end. Columns of those names in
    ``docs`` are replaced. With no training rows all counts are 0 and the lattice keeps the vocabulary's first weights.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "lattice-lm")
    replaced = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "piece_score", taught, "text")
    kept = [c for c in docs.columns if c not in replaced]
    # the caller's columns under names of their own until the end
    learns = F.coalesce(F.col(taught), F.lit(False))
    kind = F.when(learns, F.col(classes).cast("string")) if classes else F.lit(None).cast("string")
    docs = docs.select("text", learns.alias("_taught"), kind.alias("_class"), *(F.col(c).alias(f"_in_{c}") for c in kept))
    sizes = docs.where("_class is not null").groupBy("_class").count().orderBy(F.col("count").desc(), "_class").limit(CLASSES).collect()
    names = [r["_class"] for r in sizes]
    number = F.lit(-1)
    for k, name in enumerate(names):
        number = F.when(F.col("_class") == name, k).otherwise(number)

    read = docs.select("text", F.col("_taught").alias("taught"), number.cast("int").alias("class"))
    types = read.mapInArrow(_types, "word_hash long, word binary, c long, n long, class int")
    of_class = F.array(*(F.sum(F.when(F.col("class") == k, F.col("c")).otherwise(0)) for k in range(len(names)))).cast("array<long>")
    types = types.groupBy("word_hash", "word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), of_class.alias("of_class"))
    types = saved(types, f"{folder}/types")
    totals = types.agg(
        F.sum("c").alias("tokens"),
        F.count_if(F.col("c") > 0).alias("distinct"),
        *(F.sum(F.col("of_class")[k]).alias(f"class_{k}") for k in range(len(names))),
    ).first()
    ends = docs.where("_taught").count()
    train_tokens, distinct = (totals["tokens"] or 0) + ends, totals["distinct"] + (ends > 0)

    lattice = Lattice.of_model(tokenizer)
    sent = spark.sparkContext.broadcast
    learned = types.where("c > 0").select("word")
    for _ in range(rounds if train_tokens else 0):
        expected = learned.mapInArrow(_expect(sent(lattice)), "piece long, expected double")
        expected = expected.groupBy("piece").agg(F.sum("expected").alias("expected")).toPandas()  # one row a piece
        uses = np.zeros(len(lattice.pieces))
        uses[expected["piece"]] = expected["expected"]
        lattice = lattice.reweighted(uses, ends)
    scored = types.mapInArrow(_score_types(sent(lattice)), "word_hash long, c long, n long, of_class array<long>, log_p double")
    scored = saved(scored, f"{folder}/scored")

    total = float(train_tokens + distinct + 1)
    slope, centre = _spelling(scored)
    # at most one count for each distinct token, so that every weight stays below one
    added = F.least(slope * (F.col("log_p") - centre), F.lit(math.log(distinct + 1)))
    granted = train_tokens + (scored.where("c > 0").agg(F.sum(F.exp(added))).first()[0] or 0.0) + (ends > 0) + 1.0
    # per lattice of the mixture: weight, tokens and ends of its training texts; the first is the base's
    parts_of = [(0.1 if names else 1.0, None, None)]
    texts = float(sum(r["count"] for r in sizes))
    parts_of += [(0.9 * r["count"] / texts, float(totals[f"class_{k}"] + r["count"]), r["count"]) for k, r in enumerate(sizes)]

    def whole(base, tokens, count):
        """Weight of a whole-word arc."""
        return base if tokens is None else (count + _SMOOTHING * base) / (tokens + _SMOOTHING)

    seen = (F.col("c") + F.exp(added)) / granted
    logs = []
    for k, (_, tokens, _) in enumerate(parts_of):
        # of an unseen word only what is added, in logarithms: it may be too small for a double
        unseen = added - math.log(granted) + (0.0 if tokens is None else math.log(_SMOOTHING / (tokens + _SMOOTHING)))
        word = F.when(F.col("c") > 0, F.log(whole(seen, tokens, F.col("of_class")[k - 1] if k else None))).otherwise(unseen)
        logs.append(word if train_tokens > ends else F.col("log_p"))
    scored = scored.select("word_hash", "c", "n", "log_p", *(x.alias(f"log_{k}") for k, x in enumerate(logs)))

    top = most_frequent(scored, "n", FREQUENT).toPandas().sort_values("word_hash")
    c = top["c"].to_numpy()
    mixed = [f"log_{k}" for k in range(len(parts_of))]
    values = [np.log10(c + 1.0), (c > 0).astype(float), *(top[x].to_numpy() for x in ("log_p", *mixed))]
    docs = docs.drop("_class")
    columns = docs.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    sums_ddl = ", ".join(f"sum_{k} double" for k in range(len(values)))
    parts = docs.mapInArrow(
        _frequent_parts(sent((top["word_hash"].to_numpy(), values)), columns),
        f"{ddl}, words long, {sums_ddl}, rare array<struct<word_hash:long,times:long>>",
    )
    parts = saved(parts.withColumn("_row", F.monotonically_increasing_id()), f"{folder}/parts")

    rare = parts.select("_row", F.inline("rare")).join(scored.drop("n"), "word_hash")
    of_word = [F.log10(F.col("c") + 1.0), (F.col("c") > 0).cast("double"), *(F.col(x) for x in ("log_p", *mixed))]
    rare = rare.groupBy("_row").agg(*(F.sum(F.col("times") * x).alias(f"rare_{k}") for k, x in enumerate(of_word)))
    both = [F.col(f"sum_{k}") + F.coalesce(f"rare_{k}", F.lit(0.0)) for k in range(len(values))]
    end = (ends + 1.0) / granted
    terms = [
        math.log(weight) + x + math.log(whole(end, tokens, count)) for (weight, tokens, count), x in zip(parts_of, both[3:], strict=True)
    ]
    largest = F.greatest(*terms) if len(terms) > 1 else terms[0]
    score = largest + F.log(sum(F.exp(t - largest) for t in terms))
    n_tokens = F.col("words") + 1
    return parts.join(rare, "_row", "left").select(
        *(F.col(f"_in_{c}").alias(c) for c in kept),
        n_tokens.alias("n_tokens"),
        (F.round(both[1]).cast("long") + int(ends > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (both[0] + math.log10(ends + 1.0) - n_tokens * math.log10(total)).alias("base_score"),
        (score / math.log(10)).alias("score"),
        ((both[2] + lattice.end) / math.log(10)).alias("piece_score"),
    )


def _spelling(scored: DataFrame) -> tuple[float, float]:
    """Slope and centre of the counts that words get for their piece paths, from training words seen once or twice.

    For counts of a rate r, words seen twice are r / 2 times those seen once, so the slope of these odds by log_p is that
    of the logarithm of the rate. Words are binned by log_p within one per cent, which leaves some thousand rows.
    """
    number = F.floor(F.log(F.greatest(-F.col("log_p"), F.lit(1e-9))) * 100)
    once, twice = F.col("c") == 1, F.col("c") == 2
    bins = scored.where(once | twice).groupBy(number.alias("k")).agg(
        F.sum("log_p").alias("sum"),
        F.sum(F.when(once, F.col("log_p")).otherwise(0.0)).alias("sum_once"),
        F.count_if(once).alias("once"),
        F.count_if(twice).alias("twice"),
    ).toPandas()
    n_once, n_twice = bins["once"].to_numpy(float), bins["twice"].to_numpy(float)
    prior, weight = _SLOPE
    if n_once.sum():
        centre = float(bins["sum_once"].sum() / n_once.sum())
    else:
        centre = float(scored.where("c > 0").agg(F.avg("log_p")).first()[0] or 0.0)
    x = bins["sum"].to_numpy(float) / (n_once + n_twice) - centre
    level, slope = 0.0, prior
    for _ in range(100):
        odds = np.clip(level + slope * x, -500, 500)
        p = 1 / (1 + np.exp(-odds))
        left, bend = n_twice - (n_once + n_twice) * p, (n_once + n_twice) * p * (1 - p)
        gradient = np.array([left.sum() - level, (left * x).sum() - weight * (slope - prior)])
        curve = np.array([[bend.sum() + 1, (bend * x).sum()], [(bend * x).sum(), (bend * x * x).sum() + weight]])
        step = np.clip(np.linalg.solve(curve, gradient), [-1, -0.05], [1, 0.05])
        level, slope = level + float(step[0]), slope + float(step[1])
        if np.abs(step).max() < 1e-9:
            break
    return min(max(slope, 0.0), 1.0), centre
