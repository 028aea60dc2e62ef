"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The vocabulary's own piece scores are taken as they are: the best segmentation has the largest sum. Going through a
text, the search keeps the best score of each boundary in a window as long as the longest piece. Ids are committed
whenever the backpointer paths of all boundaries in the window meet in one boundary; what lies before it can no
longer change. A character in no single-character piece costs the lowest score less 10 and is written as its UTF-8
bytes (byte pieces), so that every text can be decoded exactly. One blank is put before a non-empty text.

Where no piece crosses a blank, paths meet before every word. Such segments that fit in the window are searched many at
once: the search is the same, with one numpy step for a boundary of all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from provwatch.llm.blocks import blocks
from provwatch.llm.tokenizers_public import TokenizerFile

MEMO = 400_000  # segments whose ids a worker remembers; more are encoded again
LANES = 1 << 16  # characters of the segments that are searched at once
_BLANK = "▁"
_U = np.uint64
_NO_CHARACTER = 0x110000  # above all of Unicode: fills lanes behind the end of their segment


class PieceTree:
    """Prefix tree of the pieces: children in an open-addressed table of (node, character), scores and ids by node."""

    def __init__(self, ids: dict[str, int], scores: dict[str, float]):
        nodes: dict[tuple[int, str], int] = {}
        ends: dict[int, str] = {}
        for piece in ids:
            at = 0
            for c in piece:
                at = nodes.setdefault((at, c), len(nodes) + 1)
            ends[at] = piece
        self.score = np.full(len(nodes) + 1, -np.inf)
        self.id = np.zeros(len(nodes) + 1, np.int64)
        for node, piece in ends.items():
            self.score[node], self.id[node] = scores[piece], ids[piece]
        self.bits = max(4, (4 * len(nodes)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.nodes = np.zeros(1 << self.bits, np.int32)
        keys = np.array([node << 21 | ord(c) for node, c in nodes], np.int64)
        values = np.array([*nodes.values()], np.int32)
        at = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[at[placed]], self.nodes[at[placed]] = keys[placed], values[placed]
            left = np.ones(len(keys), bool)
            left[placed] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def children(self, nodes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The child of each node by a character, 0 if there is none."""
        keys = (nodes.astype(np.int64) << 21) | characters
        at = self._slots(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.nodes[at], 0)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[at[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.nodes[at[open_[same]]]
            open_ = open_[~same & (there >= 0)]
        return out


@dataclass
class Vocabulary:
    """Pieces as raw text (the blank mark as a space), their ids and scores."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    longest: int
    unknown: float
    endings: dict[str, tuple[int, ...]]  # by their last three characters, the lengths that longer pieces have
    splits: bool  # no piece holds a blank after another character: paths meet before every word
    pieces: dict[int, bytes] = field(default_factory=dict)

    @classmethod
    def of(cls, ids: dict[str, int], scores: dict[str, float], byte_ids: list[int]) -> Vocabulary:
        splits = not any(re.search("[^ ] ", p) for p in ids)
        pieces = {i: p.encode() for p, i in ids.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        endings: dict[str, set[int]] = {}
        for p in ids:
            if len(p) > 2:
                endings.setdefault(p[-3:], set()).add(len(p))
        ordered = {end: tuple(sorted(lengths, reverse=True)) for end, lengths in endings.items()}
        low = min(scores.values(), default=0.0) - 10
        return cls(ids, scores, byte_ids, max(map(len, ids), default=1), low, ordered, splits, pieces)

    @classmethod
    def of_model(cls, model: bytes) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [
            i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))
        ]
        ids = {m.id_to_piece(i).replace(_BLANK, " "): i for i in plain}
        byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(m.is_byte, byte_ids)):
            raise ValueError("the vocabulary needs byte pieces")
        return cls.of(ids, {p: m.get_score(i) for p, i in ids.items()}, byte_ids)

    @cached_property
    def tree(self) -> PieceTree:
        return PieceTree(self.ids, self.scores)


class StreamingViterbi:
    """Feed characters in any portions; ids come out as soon as they are certain."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text = ""  # characters since the last committed boundary
        self.score: list[float] = [0.0]
        self.back: list[tuple[int, str | None]] = [(0, None)]

    def feed(self, characters: str) -> Iterator[int]:
        for start in range(0, len(characters), 4 * self.v.longest):
            self.text += characters[start : start + 4 * self.v.longest]
            self._advance()
            yield from self._commit(self._meeting())

    def finish(self) -> Iterator[int]:
        yield from self._commit(len(self.text))

    def _advance(self) -> None:
        """Best path to each new boundary; among equal sums the longest last piece wins."""
        text, score, back = self.text, self.score, self.back
        unknown, get, endings = self.v.unknown, self.v.scores.get, self.v.endings.get
        none: tuple[int, ...] = ()
        for end in range(len(score), len(text) + 1):
            best, come = score[-1] + unknown, (end - 1, None)
            for length in (*endings(text[end - 3 : end], none), 2, 1) if end > 2 else (end, 1):
                start = end - length
                if start >= 0:
                    piece = text[start:end]
                    value = get(piece)
                    if value is not None:
                        value += score[start]
                        if value > best:
                            best, come = value, (start, piece)
            score.append(best)
            back.append(come)

    def _meeting(self) -> int:
        """The boundary where the paths of all boundaries that a later piece may start from meet."""
        live = set(range(max(0, len(self.text) - self.v.longest + 1), len(self.text) + 1))
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(self.back[last][0])
        return live.pop()

    def _commit(self, upto: int) -> list[int]:
        out: list[int] = []
        at, back, ids = upto, self.back, self.v.ids
        while at > 0:
            start, piece = back[at]
            if piece is None:
                out.extend(self.v.byte_ids[b] for b in reversed(self.text[start:at].encode()))
            else:
                out.append(ids[piece])
            at = start
        out.reverse()
        if upto == len(self.text):
            self.text, self.score, self.back = "", [0.0], [(0, None)]
            return out
        self.text = self.text[upto:]
        base = self.score[upto]
        self.score = [s - base for s in self.score[upto:]]
        self.back = [(0, None), *((start - upto, piece) for start, piece in self.back[upto + 1 :])]
        return out


def search_lanes(v: Vocabulary, segments: list[str]) -> list[bytes]:
    """Ids of each segment (packed int32), all advanced by one boundary at a time; for segments of similar length.

    As in ``StreamingViterbi``, sums are taken in order of the text and the longest last piece wins among equal ones.
    """
    tree, n = v.tree, len(segments)
    sizes = np.fromiter(map(len, segments), np.int64, n)
    rows, longest = int(sizes.max()), min(v.longest, int(sizes.max()))
    lane = np.repeat(np.arange(n), sizes)
    row = np.arange(len(lane)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text = np.full((rows + longest, n), _NO_CHARACTER, np.int64)
    text[row, lane] = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)

    arcs = np.zeros((longest, rows * n), np.int32)  # by length and first character, the node of a piece
    flat = text.reshape(-1)
    live, node = row * n + lane, np.zeros(len(lane), np.int32)
    for length in range(longest):
        node = tree.children(node, flat[live + length * n])
        on = node > 0
        live, node = live[on], node[on]
        ends = tree.score[node] > -np.inf
        arcs[length, live[ends]] = node[ends]
    arcs = arcs.reshape(longest, rows, n)
    used = arcs.any(axis=2)

    score = np.zeros((rows + 1, n))
    back = np.zeros((rows + 1, n), np.int32)  # length of the last piece, 0 for a character in bytes
    for end in range(1, rows + 1):
        best, come = score[end - 1] + v.unknown, back[end]
        for length in range(min(end, longest), 0, -1):
            start = end - length
            if used[length - 1, start]:
                value = tree.score[arcs[length - 1, start]] + score[start]
                better = value > best
                best = np.where(better, value, best)
                come[better] = length
        score[end] = best

    at, lane = sizes, np.arange(n)
    codes, places = [], []
    while len(lane):
        length = back[at, lane]
        start = at - np.maximum(length, 1)
        codes.append(np.where(length > 0, tree.id[arcs[length - 1, start, lane]], -1 - text[start, lane]))
        places.append(lane * rows + start)
        at, lane = start[start > 0], lane[start > 0]
    found, place = np.concatenate(codes), np.concatenate(places)
    order = np.argsort(place)
    found, lane = found[order], place[order] // rows
    unknown = found < 0
    if unknown.any():
        character = np.where(unknown, -1 - found, 0)
        size = 1 + (character >= 0x80) + (character >= 0x800) + (character >= 0x10000)
        of = np.repeat(np.arange(len(found)), size)
        character, size, left = character[of], size[of], np.cumsum(size)[of] - 1 - np.arange(len(of))  # UTF-8 bytes
        byte = np.where(left + 1 < size, 0x80 | character >> 6 * left & 0x3F, 0xFF00 >> size & 0xFF | character >> 6 * left)
        byte = np.where(size == 1, character, byte)
        found, lane = np.where(unknown[of], np.array(v.byte_ids)[byte], found[of]), lane[of]
    packed, cuts = found.astype(np.int32).tobytes(), (4 * np.cumsum(np.bincount(lane, minlength=n))).tolist()
    return [packed[a:b] for a, b in zip([0, *cuts], cuts)]


def _packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, np.int32).tobytes()


_SEGMENT = re.compile(r" +[^ ]*|[^ ]+")


class Encoder:
    """Encodes whole texts; equal segments between certain meeting points are searched once and remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.memo: dict[str, bytes] = {}  # ids as packed int32

    def _search(self, segments: list[str]) -> Iterator[tuple[str, bytes]]:
        short = sorted((s for s in segments if len(s) <= 2 * self.v.longest), key=len)
        while short:
            n = max(1, min(len(short), LANES // len(short[-1])))
            some, short = short[-n:], short[:-n]
            yield from zip(some, search_lanes(self.v, some), strict=True)
        for segment in segments:
            if len(segment) > 2 * self.v.longest:
                search = StreamingViterbi(self.v)
                yield segment, _packed(chain(search.feed(segment), search.finish()))

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Segments that are not remembered are searched together."""
        memo = self.memo
        split = _SEGMENT.findall if self.v.splits else lambda text: [text]
        segments = [split(" " + t) if t else [] for t in texts]
        known = dict.fromkeys(chain.from_iterable(segments))
        for segment in known:
            known[segment] = memo.get(segment)
        new = dict(self._search([s for s, ids in known.items() if ids is None]))
        known |= new
        if len(memo) + len(new) > MEMO:
            memo.clear()  # what is in use stays
            new = known
        memo |= {s: ids for s, ids in new.items() if len(s) <= 64}
        return [np.frombuffer(b"".join(map(known.__getitem__, s)), np.int32) for s in segments]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.v.pieces.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def encoder(model: bytes) -> Encoder:
    return Encoder(Vocabulary.of_model(model))


_ENCODED = "ids array<int>, n_ids long, decoded string"


def encode_texts(docs: DataFrame, tokenizer: TokenizerFile) -> DataFrame:
    """Every row with ids (array of int), n_ids and decoded (the text that the ids give back).

    A null text gives empty ids and a null decoded text, an empty text empty ids. Texts are encoded whole, whatever
    their length. Columns of ``docs`` named ids, n_ids or decoded are replaced; all others are kept.
    """
    docs = docs.drop("ids", "n_ids", "decoded")
    model, names = tokenizer.content, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model)
        for batch in batches:
            column = batch.column(names.index("text"))
            for block in blocks(column):
                n = block.last - block.first
                texts = column.slice(block.first, n).to_pylist()
                ids = tool.encode_all([t or "" for t in texts])
                sizes = np.fromiter(map(len, ids), np.int64, n)
                offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)  # a text gives at most one id a byte, and a blank
                decoded = [None if t is None else tool.decode(i.tolist()) for t, i in zip(texts, ids, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(block.first, n) for c in batch.columns),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                        pa.array(sizes),
                        pa.array(decoded, pa.string()),
                    ],
                    names=[*names, "ids", "n_ids", "decoded"],
                )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{ddl}, {_ENCODED}")
