"""Alignment of two tokenizers' tokens by lockstep merging.

Both tokenizers encode the same bytes: one blank and the text. Two pointers go through the token ends of a document,
A's and B's; the tokens under them overlap, which is a link, and the pointer whose token ends first moves on. If both
end at one byte, both move, and that byte cuts the document into groups. All documents of a block advance in the same
steps: one numpy vector holds their pointers, each step emits a link of every document and the cuts among them, and
finished documents leave the vector. A long document is cut into lanes of ``LANE`` A tokens, each starting at the B
token that covers its first byte, so that the number of steps is bounded and no link is emitted twice.

Texts are encoded in segments, cut at single blanks between other characters: neither kind of tokenizer joins
characters across such a blank (checked when it is read, else texts are encoded whole), and a worker remembers the
ids of ``MEMO`` segments, so most are looked up.

Counts of linked id pairs over the corpus never pass through one task: pairs are counted per document, then per block
(some MB of text), then over all blocks, and each block gets back the counts of its own distinct pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provwatch.llm.blocks import blocks
from provwatch.llm.tables import saved
from provwatch.llm.tokenizers_public import TokenizerFile
from provwatch.sources.sinks import work_folder

LANE = 512
MEMO = 200_000
PORTION = 20_000  # segments that are encoded at once
BLOCK = 2 << 20  # bytes of text that are merged, and whose pairs are counted, together

_MARK = "▁"
# A blank between two characters that are neither white space nor the blank mark.
_SAFE_BLANK = re.compile(rf"(?<=[^\s{_MARK}]) (?=[^\s{_MARK}])")
_LOOSE_EDGE = re.compile(rf"^$|^[\s{_MARK}]|[\s{_MARK}]$")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: visible ones as they are, others from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Side:
    """A tokenizer: ids of a blank and each given text, the bytes of each id, and whether texts may be cut."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: list[bytes]
    cuts_at_blanks: bool


def _byte_level(content: bytes) -> Side:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tool = Tokenizer.from_str(content.decode())
    tool.no_truncation()
    tool.no_padding()
    tool.encode_special_tokens = True  # their strings inside a text are plain text
    letters = byte_letters()
    pieces = [b""] * (max(tool.get_vocab(with_added_tokens=True).values(), default=-1) + 1)
    for piece, i in tool.get_vocab(with_added_tokens=True).items():
        pieces[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
    about = json.loads(content)
    before = about.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")

    def encode(texts: list[str]) -> list[list[int]]:
        found = tool.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        return [e.ids for e in found]

    return Side(encode, pieces, plain and not about.get("normalizer"))


def _sentence_pieces(content: bytes) -> Side:
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_proto=content)
    names = [tool.id_to_piece(i) for i in range(tool.get_piece_size())]
    pieces = [
        bytes([int(name[1:-1], 16)]) if tool.is_byte(i) else name.replace(_MARK, " ").encode() for i, name in enumerate(names)
    ]
    apart = not any(_MARK in name.lstrip(_MARK) for name in names)
    # a normalizer that changes nothing here: neither white space nor compatible characters
    same = all(b"".join(pieces[i] for i in tool.encode(t)).decode() == f" {t}" for t in ("a  b 　ﬁ ", " \ta"))
    return Side(lambda texts: tool.encode(texts, num_threads=1), pieces, apart and same)


@lru_cache(maxsize=4)
def side(kind: str, content: bytes) -> Side:
    return _sentence_pieces(content) if kind == "sentencepiece" else _byte_level(content)


def _gathered(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices first, first + 1, ... of each run, one run after another."""
    ends = np.cumsum(counts)
    return np.repeat(firsts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class _Ragged:
    """Ids of numbered segments, in one array that is extended at its end."""

    def __init__(self) -> None:
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def extend(self, rows: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        values = np.fromiter((i for row in rows for i in row), np.int32, int(sizes.sum()))
        self.flat = np.concatenate([self.flat, values])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given segments in a row, and how many each has."""
        counts = self.ends[slots + 1] - self.ends[slots]
        return self.flat[_gathered(self.ends[slots], counts)], counts


@dataclass
class Alignment:
    """Tokens, links and cuts of a block of documents. Numbers of tokens count through the whole block."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_first: np.ndarray  # the first A token of each document, and the end
    b_first: np.ndarray
    link_a: np.ndarray  # the tokens of each link
    link_b: np.ndarray
    a_cut: np.ndarray  # whether a group ends with the token
    b_cut: np.ndarray


def lockstep(a_end: np.ndarray, b_end: np.ndarray, first: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, ...]:
    """Links and cuts from the byte ends of the tokens of documents that lie one after another.

    ``first`` has the number of each document's first A token, and at last the number of A tokens; both token rows
    cover the same bytes and no token is empty. Returns the A and B token of every link, in no order, and for each A
    and B token whether it ends where a token of the other kind ends.
    """
    a_cut, b_cut = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    sizes = np.diff(first)
    lanes = -(-sizes // lane)
    pa_ = np.repeat(first[:-1], lanes) + lane * _gathered(np.zeros(len(lanes), np.int64), lanes)
    stop = np.minimum(pa_ + lane, np.repeat(first[1:], lanes))
    begin = np.where(pa_ > 0, a_end[pa_ - 1], 0) if len(pa_) else pa_
    pb_ = np.searchsorted(b_end, begin, "right")
    links: list[tuple[np.ndarray, np.ndarray]] = []
    while len(pa_):
        links.append((pa_, pb_))
        ends_a, ends_b = a_end[pa_], b_end[pb_]
        both = ends_a == ends_b
        a_cut[pa_[both]] = True
        b_cut[pb_[both]] = True
        pa_ = pa_ + (ends_a <= ends_b)
        pb_ = pb_ + (ends_b <= ends_a)
        going = pa_ < stop
        if not going.all():
            pa_, pb_, stop = pa_[going], pb_[going], stop[going]
    none = np.zeros(0, np.int64)
    return (
        np.concatenate([none, *(a for a, _ in links)]),
        np.concatenate([none, *(b for _, b in links)]),
        a_cut,
        b_cut,
    )


class Aligner:
    """Aligns blocks of texts; remembers the ids of segments from block to block."""

    def __init__(self, a: Side, b: Side, memo: int = MEMO):
        self.a, self.b, self.memo = a, b, memo
        self.cuts = a.cuts_at_blanks and b.cuts_at_blanks
        self.a_len = np.fromiter(map(len, a.pieces), np.int64, len(a.pieces))
        self.b_len = np.fromiter(map(len, b.pieces), np.int64, len(b.pieces))
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.a_rows, self.b_rows = _Ragged(), _Ragged()
        self.loose, self.same = np.zeros(0, bool), np.zeros(0, bool)

    def _learn(self, segments: list[str]) -> np.ndarray:
        """The number of each segment; what is not known yet is encoded in one batch."""
        missing = [s for s in dict.fromkeys(segments) if s not in self.slots]
        for start in range(0, len(missing), PORTION):
            new = missing[start : start + PORTION]
            self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new)), strict=True))
            rows = self.a.encode(new), self.b.encode(new)
            loose, same = [], []
            for segment, i, j in zip(new, *rows, strict=True):
                expected = f" {segment}".encode()
                loose.append(self.cuts and _LOOSE_EDGE.search(segment) is not None)
                same.append(self._joined(self.a, i) == expected == self._joined(self.b, j))
            self.a_rows.extend(rows[0])
            self.b_rows.extend(rows[1])
            self.loose, self.same = np.concatenate([self.loose, loose]), np.concatenate([self.same, same])
        return np.fromiter(map(self.slots.__getitem__, segments), np.int64, len(segments))

    @staticmethod
    def _joined(one: Side, ids: list[int]) -> bytes:
        return b"".join(map(one.pieces.__getitem__, ids))

    def _segments(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Segment numbers of all texts in a row, and where each text's begin."""
        parts = [[] if not t else t.split(" ") if self.cuts else [t] for t in texts]
        first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        slots = self._learn([s for p in parts for s in p])
        loose = np.concatenate([[0], np.cumsum(self.loose[slots])])
        again = np.flatnonzero(loose[first[1:]] > loose[first[:-1]])
        if len(again):  # blanks beside blanks or at an end: cut these texts at the safe blanks only
            for i in again:
                parts[i] = _SAFE_BLANK.split(texts[i])
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            slots = self._learn([s for p in parts for s in p])
        return slots, first

    def align(self, texts: list[str | None]) -> Alignment:
        """Null and empty texts, and texts that do not come back as their bytes, have no tokens."""
        if len(self.slots) > self.memo:
            self._forget()
        slots, first = self._segments(texts)
        odd = np.concatenate([[0], np.cumsum(~self.same[slots])])
        sizes = np.diff(first)
        for i in np.flatnonzero(odd[first[1:]] > odd[first[:-1]]):
            mine, expected = slots[first[i] : first[i + 1]], f" {texts[i]}".encode()
            a, b = (self._joined(o, r.take(mine)[0].tolist()) for o, r in ((self.a, self.a_rows), (self.b, self.b_rows)))
            if not a == expected == b:
                sizes[i] = 0
        kept = np.repeat(sizes > 0, np.diff(first))
        slots, first = slots[kept], np.concatenate([[0], np.cumsum(sizes)])
        a_ids, a_counts = self.a_rows.take(slots)
        b_ids, b_counts = self.b_rows.take(slots)
        a_first = np.concatenate([[0], np.cumsum(a_counts)])[first]
        b_first = np.concatenate([[0], np.cumsum(b_counts)])[first]
        merged = lockstep(np.cumsum(self.a_len[a_ids]), np.cumsum(self.b_len[b_ids]), a_first)
        return Alignment(a_ids, b_ids, a_first, b_first, *merged)


@lru_cache(maxsize=2)
def _aligner(a: TokenizerFile, b: TokenizerFile) -> Aligner:
    return Aligner(side(a.kind, a.content), side(b.kind, b.content))


def _lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def align_texts(docs: DataFrame, a: TokenizerFile, b: TokenizerFile) -> DataFrame:
    """Every row with the tokens of both tokenizers, their links and the cuts.

    ``a_ids`` and ``b_ids``; ``link_a`` and ``link_b``: the numbers (from 0) of the tokens of each link, in the order
    of the text; ``cut_a`` and ``cut_b``: how many tokens lie before each cut. All are empty for a null or empty text
    and for one whose tokens do not join to a blank and the text (a text with the mark U+2581, say). Texts are aligned
    whole. Repeated rows are kept. Columns of these six names are replaced, others kept.
    """
    made = ("a_ids", "b_ids", "link_a", "link_b", "cut_a", "cut_b")
    docs = docs.drop(*made)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _aligner(a, b)
        for batch in batches:
            column = batch.column(names.index("text"))
            for block in blocks(column, BLOCK // 2):
                n = block.last - block.first
                found = tool.align(column.slice(block.first, n).to_pylist())
                order = np.lexsort((found.link_b, found.link_a))
                link_a, link_b = found.link_a[order], found.link_b[order]
                links = np.searchsorted(link_a, found.a_first)
                at_a, at_b = np.flatnonzero(found.a_cut) + 1, np.flatnonzero(found.b_cut) + 1
                cuts = np.searchsorted(at_a, found.a_first, "right")
                sizes = np.diff(links), np.diff(cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(block.first, n) for c in batch.columns),
                        _lists(found.a_ids, found.a_first, pa.int32()),
                        _lists(found.b_ids, found.b_first, pa.int32()),
                        _lists(link_a - np.repeat(found.a_first[:-1], sizes[0]), links, pa.int32()),
                        _lists(link_b - np.repeat(found.b_first[:-1], sizes[0]), links, pa.int32()),
                        _lists(at_a - np.repeat(found.a_first[:-1], sizes[1]), cuts, pa.int32()),
                        _lists(at_b - np.repeat(found.b_first[:-1], sizes[1]), cuts, pa.int32()),
                    ],
                    names=[*names, *made],
                )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, ", ".join([ddl, *(f"{m} array<int>" for m in made)]))


def _decimals(limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of each number below ``limit``, from the left, and how many there are."""
    width = len(str(max(limit - 1, 0)))
    numbers = np.arange(limit)
    sizes = np.char.str_len(numbers.astype(str)).astype(np.int64)
    digits = np.zeros((limit, width + 1), np.uint8)
    for k in range(width):
        held = sizes > k
        digits[held, k] = 48 + numbers[held] // 10 ** (sizes[held] - 1 - k) % 10
    return digits, sizes


def group_texts(found: Alignment, digits: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3`` with decimal ids; empty without tokens."""
    a_cut, b_cut = np.flatnonzero(found.a_cut) + 1, np.flatnonzero(found.b_cut) + 1
    a_sizes, b_sizes = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
    values = np.empty(len(found.a_ids) + len(found.b_ids), np.int32)
    # A tokens stand behind all B tokens of earlier groups, B tokens behind all A tokens up to their own group
    values[np.arange(len(found.a_ids)) + np.repeat(b_cut - b_sizes, a_sizes)] = found.a_ids
    values[np.arange(len(found.b_ids)) + np.repeat(a_cut, b_sizes)] = found.b_ids
    signs = np.full(len(values), ord(","), np.uint8)
    signs[a_cut + (b_cut - b_sizes) - 1] = ord("|")
    signs[a_cut + b_cut - 1] = ord(";")
    rows, widths = digits[values], sizes[values]
    rows[np.arange(len(rows)), widths] = signs
    flat = rows[np.arange(rows.shape[1]) <= widths[:, None]]
    ends = np.concatenate([[0], np.cumsum(widths + 1)])[found.a_first + found.b_first]
    return [flat[s : max(s, e - 1)].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)]


def _summaries(kind: str, a: TokenizerFile, b: TokenizerFile) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _aligner(a, b)
        b_size = len(tool.b.pieces)
        pairs_in_all = len(tool.a.pieces) * b_size
        digits = _decimals(max(len(tool.a.pieces), b_size))
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for batch in batches:
            column = batch.column("text")
            for block in blocks(column, BLOCK):
                n = block.last - block.first
                found = tool.align(column.slice(block.first, n).to_pylist())
                link_doc = np.searchsorted(found.a_first, found.link_a, "right") - 1
                pair = found.a_ids[found.link_a].astype(np.int64) * b_size + found.b_ids[found.link_b]
                keys, times = np.unique(link_doc * pairs_in_all + pair, return_counts=True)
                first = np.searchsorted(keys, np.arange(n + 1) * pairs_in_all)
                cuts = np.concatenate([[0], np.cumsum(found.a_cut)])[found.a_first]
                texts = group_texts(found, *digits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, number)),
                        batch.column("doc_id").slice(block.first, n),
                        pa.array(np.diff(found.a_first)),
                        pa.array(np.diff(found.b_first)),
                        pa.array(np.diff(cuts)),
                        pa.array(np.bincount(link_doc, minlength=n)),
                        pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts]),
                        _lists(keys % pairs_in_all, first, pa.int64()),
                        _lists(times, first, pa.int32()),
                    ],
                    names=["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )
                number += 1

    return run


_COUNTS = "n_a long, n_b long, n_groups long, n_links long"


def _with_counts(kind: str):
    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(counts["pair"].to_numpy())
        known, total = counts["pair"].to_numpy()[order], counts["total"].to_numpy()[order]
        best = counts["best"].to_numpy()[order]
        docs = docs.combine_chunks()
        pairs = docs["pairs"].combine_chunks()
        times = docs["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(known, pairs.flatten().to_numpy())
        first = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
        sums = [np.concatenate([[0], np.cumsum(times * values[at])])[first] for values in (best, total)]
        out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array(np.diff(sums[0]), pa.int64()))
        out = out.append_column("count_sum", pa.array(np.diff(sums[1]), pa.int64()))
        return out.append_column("groups_sha256", docs["groups_sha256"])

    return run


def alignment_report(docs: DataFrame, a: TokenizerFile, b: TokenizerFile) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): how its tokens align, with counts of linked id pairs over the corpus.

    doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest count of all pairs with its B id, ties
    included), count_sum (of the pairs' counts over all links) and groups_sha256 (of ``group_texts``, or an empty
    string without tokens). Rows are kept as often as they occur, also without doc_id; rows without tokens (null or
    empty text, or one that the tokens do not give back) have zeros. Further columns are ignored. The written tables
    hold, per document, its distinct pairs; pairs of a B id are at most as many as the first vocabulary has entries.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "alignment")
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = f"block long, doc_id {kind}, {_COUNTS}, groups_sha256 string, pairs array<long>, times array<int>"
    rows = saved(docs.select("doc_id", "text").mapInArrow(_summaries(kind, a, b), made), f"{folder}/rows")
    b_size = len(side(b.kind, b.content).pieces)
    each = rows.select("block", F.inline(F.arrays_zip("pairs", "times")))
    local = each.groupBy("block", F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    local = saved(local, f"{folder}/blocks")
    totals = local.groupBy("pair").agg(F.sum("n").alias("total"))
    highest = F.max("total").over(Window.partitionBy(F.col("pair") % b_size))
    totals = totals.withColumn("best", (F.col("total") == highest).cast("int"))
    counts = local.join(totals, "pair").select("block", "pair", "total", "best")
    out = f"doc_id {kind}, {_COUNTS}, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_with_counts(kind), out)
