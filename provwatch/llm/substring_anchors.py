"""Substring deduplication with difference-cover anchors.

Two equal windows of ``window`` words may begin at any two positions. A difference cover D modulo a period P
holds, for every pair of positions, a shift below P that brings both into D. So it is enough to hash runs of
``window - P + 1`` words at positions whose remainder is in D (4 of 13 positions by default): any two equal
windows hold two equal, aligned anchors. Only windows that hold a repeated anchor are then extended to full
length and compared with each other, by 96 hash bits.

Both rounds are one exchange: every block of texts sends its hashes, packed by hash range, to the task that owns
the range; that task answers with the positions whose hash occurs twice, packed for the task that gathers each
document's. A hash that repeats within a block is
sent once for the block, so that a passage in a third of all documents stays small; the block answers its own
positions itself. The texts are shuffled once and that exchange is used by both rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provwatch.llm.blocks import Block, Words, blocks, mix, range_hashes, word_hashes, words

PERIOD = 13
COVER = (0, 1, 3, 9)  # every remainder modulo 13 is a difference of two of these

_SENT = pa.schema(
    [
        ("range", pa.int32()),
        ("answered", pa.bool_()),
        ("keys", pa.binary()),
        ("checks", pa.binary()),
        ("rows", pa.binary()),
        ("at", pa.binary()),
        ("ids", pa.binary()),
    ]
)
_SENT_DDL = "range int, answered boolean, keys binary, checks binary, rows binary, at binary, ids binary"
_PACKED = pa.schema([("home", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary()), ("at", pa.binary())])
_FOUND = pa.schema([("row_key", pa.int64()), ("hits", pa.binary())])
_NOBODY = 0xFFFF


def _send(ids: np.ndarray, keys, checks, rows, at, ranges: int) -> pa.RecordBatch:
    """Pack the hashes of one block by range; answer what repeats within the block at once."""
    order = np.lexsort((checks, keys)) if checks is not None else np.argsort(keys, kind="stable")
    keys, rows, at = keys[order], rows[order], at[order]
    same = keys[1:] == keys[:-1]
    if checks is not None:
        checks = checks[order]
        same &= checks[1:] == checks[:-1]
    twice = np.zeros(len(keys), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out: dict[str, list] = {name: [] for name in _SENT.names}

    def add(of: int, answered: bool, k, c, r, p, i) -> None:
        for name, value in zip(_SENT.names, (of, answered, k, c, r, p, i), strict=True):
            out[name].append(value)

    def needed(part: np.ndarray) -> tuple[bytes, bytes]:
        """Rows of ``part`` as numbers into the ids that are sent along."""
        used = np.unique(part[part != _NOBODY])
        place = np.full(_NOBODY + 1, _NOBODY, np.uint16)
        place[used] = np.arange(len(used), dtype=np.uint16)
        return place[part].tobytes(), ids[used].tobytes()

    # what repeats here: answered for all its positions, and announced once without a sender
    local = np.flatnonzero(twice)
    if len(local):
        local = local[np.argsort(order[local])]
        numbers, some = needed(rows[local])
        add(int(keys[0] % np.uint64(ranges)), True, None, None, numbers, at[local].tobytes(), some)
    first = np.ones(len(keys), bool)
    first[1:] = ~same
    kept = np.flatnonzero(first)
    rows = np.where(twice, _NOBODY, rows).astype(np.uint16)
    of = (keys[kept] >> np.uint64(20)) % np.uint64(ranges)
    kept = kept[np.lexsort((order[kept], of))]  # rows and positions ascend: they compress well
    cuts = np.searchsorted(np.sort(of), np.arange(ranges + 1, dtype=np.uint64))
    for k in range(ranges):
        part = kept[cuts[k] : cuts[k + 1]]
        if len(part):
            check = checks[part].tobytes() if checks is not None else None
            numbers, some = needed(rows[part])
            add(k, False, keys[part].tobytes(), check, numbers, at[part].tobytes(), some)
    return pa.RecordBatch.from_pydict(out, schema=_SENT)


def _unpacked(batch: pa.RecordBatch, i: int, *columns: tuple[str, type]) -> list[np.ndarray]:
    return [np.frombuffer(batch.column(name)[i].as_buffer(), kind).copy() for name, kind in columns]


def _answer(homes: int) -> Callable:
    """Positions whose hash occurs twice among all that was sent to this task, packed by the documents' home task."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, found = [], []
        for batch in batches:
            for i in range(batch.num_rows):
                ids, rows, at = _unpacked(batch, i, ("ids", np.int64), ("rows", np.uint16), ("at", np.uint32))
                if batch.column("answered")[i].as_py():
                    found.append((ids[rows], at))
                    continue
                (keys,) = _unpacked(batch, i, ("keys", np.uint64))
                checked = batch.column("checks")[i].is_valid
                checks = _unpacked(batch, i, ("checks", np.uint32))[0] if checked else np.zeros(len(rows), np.uint32)
                nobody = rows == _NOBODY
                asked.append((keys, checks, np.append(ids, 0)[np.where(nobody, len(ids), rows)], at, nobody))
        if asked:
            keys, checks, ids, at, nobody = (np.concatenate(x) for x in zip(*asked, strict=True))
            del asked
            order = np.lexsort((checks, keys))
            keys, checks = keys[order], checks[order]
            begins = np.ones(len(keys), bool)
            begins[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
            group = np.cumsum(begins) - 1
            copies = np.bincount(group) + np.bincount(group, weights=nobody[order]).astype(np.int64)
            hit = order[copies[group] > 1]
            hit = hit[~nobody[hit]]
            found.append((ids[hit], at[hit]))
        if not found:
            return
        ids, at = (np.concatenate(x) for x in zip(*found, strict=True))
        home = ids.view(np.uint64) % np.uint64(homes)
        order = np.lexsort((at, ids, home))
        ids, at, home = ids[order], at[order], home[order]
        cuts = np.searchsorted(home, np.arange(homes + 1, dtype=np.uint64))
        for h in range(homes):
            a, b = cuts[h], cuts[h + 1]
            if a < b:
                some, counts = np.unique(ids[a:b], return_counts=True)
                packed = (some.tobytes(), counts.astype(np.uint32).tobytes(), at[a:b].tobytes())
                yield pa.RecordBatch.from_pydict(dict(zip(_PACKED.names, ([h], *([x] for x in packed)), strict=True)), schema=_PACKED)

    return answer


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All positions found for each document whose home this task is."""
    parts = []
    for batch in batches:
        for i in range(batch.num_rows):
            ids, counts, at = _unpacked(batch, i, ("ids", np.int64), ("counts", np.uint32), ("at", np.uint32))
            parts.append((np.repeat(ids, counts), at))
    if not parts:
        return
    ids, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((at, ids))
    ids, at = ids[order], at[order]
    cuts = np.append(np.flatnonzero(np.append(True, ids[1:] != ids[:-1])), len(ids))
    for a in range(0, len(cuts) - 1, 5_000):
        some = cuts[a : a + 5_001]
        hits = [at[x:y].tobytes() for x, y in zip(some[:-1], some[1:], strict=True)]
        yield pa.RecordBatch.from_pydict({"row_key": ids[some[:-1]], "hits": hits}, schema=_FOUND)


def _word_codes(block: Block) -> tuple[Words, np.ndarray]:
    found = words(block)
    return found, word_hashes(block, found, False)


def _anchors(window: int, ranges: int) -> Callable:
    length = window - PERIOD + 1
    in_cover = np.isin(np.arange(PERIOD), COVER)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            for block in blocks(batch.column("text")):
                found, codes = _word_codes(block)
                inside = np.arange(len(codes)) - found.first[:-1][found.rows]
                count = found.count()[found.rows]
                taken = np.flatnonzero(in_cover[inside % PERIOD] & (inside + length <= count) & (count >= window))
                if len(taken):
                    yield _send(
                        keys[block.first : block.last],
                        range_hashes(codes, taken, taken + length),
                        None,
                        found.rows[taken],
                        inside[taken].astype(np.uint32),
                        ranges,
                    )

    return send


def _positions(packed: bytes) -> np.ndarray:
    """Sorted distinct positions of one document."""
    return np.unique(np.frombuffer(packed, np.uint32)).astype(np.int64)


def _windows(window: int, ranges: int) -> Callable:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            hits = batch.column("hits")
            for block in blocks(batch.column("text")):
                found, codes = _word_codes(block)
                marks = np.zeros(len(codes) + 1, np.int64)
                for i in range(block.last - block.first):
                    value = hits[block.first + i].as_py()
                    begin, end = found.first[i], found.first[i + 1]
                    if not value or end - begin < window:
                        continue
                    at = _positions(value)
                    # a window holds the anchor at ``a`` if it begins at a - PERIOD + 1 to a
                    np.add.at(marks, begin + np.maximum(at - PERIOD + 1, 0), 1)
                    np.add.at(marks, begin + np.minimum(at + 1, end - begin), -1)
                taken = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                taken = taken[taken + window <= found.first[1:][found.rows[taken]]]
                if len(taken):
                    checks = range_hashes(mix(codes ^ np.uint64(0xA5A5A5A55A5A5A5A)), taken, taken + window)
                    yield _send(
                        keys[block.first : block.last],
                        range_hashes(codes, taken, taken + window),
                        (checks >> np.uint64(32)).astype(np.uint32),
                        found.rows[taken],
                        (taken - found.first[found.rows[taken]]).astype(np.uint32),
                        ranges,
                    )

    return send


_CUT_DDL = "row_key long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_CUT = pa.schema(
    [("row_key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", _SPANS), ("kept_text", pa.string())]
)


def _cut(window: int, carried: list[str]) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column("hits")
            for block in blocks(batch.column("text")):
                n = block.last - block.first
                n_words, n_removed, spans, texts = [], [], [], []
                for i in range(n):
                    tokens = block.text(i).split()  # bytes split at exactly the six ASCII blanks
                    value = hits[block.first + i].as_py()
                    ranges: list[tuple[int, int]] = []
                    if value:
                        at = _positions(value)
                        new = np.flatnonzero(np.diff(at, prepend=-window - 1) > window)
                        last = np.append(new[1:], len(at)) - 1
                        ranges = [(int(at[a]), int(at[b]) + window) for a, b in zip(new, last, strict=True)]
                    removed = sum(b - a for a, b in ranges)
                    kept, done = [], 0
                    for a, b in ranges:
                        kept += tokens[done:a]
                        done = b
                    kept += tokens[done:]
                    n_words.append(len(tokens))
                    n_removed.append(removed)
                    spans.append([{"start": a, "end": b} for a, b in ranges])
                    texts.append(b" ".join(kept).decode("utf-8", "replace"))
                rows = batch.slice(block.first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(c) for c in carried),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(spans, _SPANS),
                        pa.array(texts, pa.string()),
                    ],
                    names=[*carried, "n_words", "n_removed", "spans", "kept_text"],
                )

    return cut


def remove_repeats(docs: DataFrame, window: int = 35, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Cut every word covered by a window of ``window`` words that also starts anywhere else.

    Returns the ``keep`` columns, n_words, n_removed, the removed spans (word positions, end exclusive) and
    kept_text (kept words joined by one space) for every row. Columns of ``docs`` other than those are ignored.
    A null text has no words and gives an empty kept_text; a text of fewer than ``window`` words is kept whole.
    Repeated rows are copies of each other, so their windows are removed from each. Windows may overlap and may
    repeat within one document. ``window`` must be at least twice the period.
    """
    if window < 2 * PERIOD:
        raise ValueError(f"window must be at least {2 * PERIOD} words")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows are known by content: equal rows have equal answers, and a null or repeated doc_id does no harm
    key = F.xxhash64(*(F.col(c) for c in dict.fromkeys((*keep, "text"))))
    docs = docs.select(key.alias("row_key"), "text", *(F.col(c).alias(f"_{c}") for c in keep if c != "text"))

    def repeated(source: DataFrame, send: Callable) -> DataFrame:
        sent = source.mapInArrow(send, _SENT_DDL).repartitionById(tasks, "range")
        packed = sent.mapInArrow(_answer(tasks), "home int, ids binary, counts binary, at binary")
        return packed.repartitionById(tasks, "home").mapInArrow(_gather, "row_key long, hits binary")

    # one exchange of the texts serves both rounds
    texts = docs.repartition(tasks, "row_key")
    anchored = texts.join(repeated(docs, _anchors(window, tasks)), "row_key")
    # all columns stay, though unused, so that both rounds read the same exchange
    starts = repeated(anchored, _windows(window, tasks))
    carried = ["text" if c == "text" else f"_{c}" for c in keep]
    full = texts.join(starts, "row_key", "left").select(*dict.fromkeys((*carried, "text")), "hits")
    types = {f.name: f.dataType.simpleString() for f in full.schema.fields}
    ddl = ", ".join(f"`{c}` {types[c]}" for c in carried) + ", " + _CUT_DDL.partition(", ")[2]
    return full.mapInArrow(_cut(window, carried), ddl).withColumnsRenamed({f"_{c}": c for c in keep if c != "text"})
