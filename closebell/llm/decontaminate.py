"""Benchmark decontamination by q-gram filtering and banded alignment.

An item of m bytes occurs in a text if some stretch of the text is within
``e = floor(max_edit_rate * m)`` edits. By the q-gram lemma at least ``m - q + 1 - q * e`` of
the item's q-grams then occur in the text on diagonals (text position minus item position) that
lie within e of each other. Shared q-grams are counted in overlapping diagonal bands, each wide
enough for any such run of diagonals; bands that reach the bound are verified by banded alignment.

Texts and items are compared as UTF-8 bytes, lower-cased, with runs of white space as one space.
Items shorter than ``SHORT`` bytes leave no room for edits: they match word for word, from the start
of a word to the end of one. Items shorter than a q-gram are no evidence and match nothing.

Items are also searched by overlapping passages, each with an edit budget of its own, so a text
that quotes part of an item matches wherever the quote is cut: a passage has two thirds of the item,
but ``LEAST_PASSAGE`` to ``PASSAGE`` bytes, and the next one begins after half of it (a quarter in items of
less than one and a half ``PASSAGE``). Where a whole item matches, its passages are not given again.

Defined results: a null or empty text has no matches; a null item matches nothing. Repeated
items match separately, repeated documents too. No items or no documents give an empty result.
Extra columns are ignored by ``matches`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

Q = 8  # bytes: a q-gram is one unsigned 64-bit number
MIN_BYTES = Q
SHORT = 32  # from here on the bound is positive for an edit rate of a tenth
PASSAGE = 100  # bytes, some 17 words
LEAST_PASSAGE = 50
BAND = 32  # diagonals by which one band is shifted against the next
_BUFFER = 4 << 20  # bytes of text searched at a time; a longer text is searched whole
_POSITIONS = 1 << 18  # of a buffer whose q-grams, and hits of whole texts, are held at a time
_TABLE_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ALIGN = 512  # candidate regions aligned at a time

MATCHES = "doc_id long, item_id long, start long, end long, edits long, bytes long"


def normalise(text: str | None) -> bytes:
    return b" ".join((text or "").replace("\0", " ").lower().encode().split())


def _grams(raw: bytes) -> np.ndarray:
    """The q-gram at every position but the last ``Q - 1``: eight shifted views, no arithmetic."""
    n = len(raw) - Q + 1
    out = np.empty(max(n, 0), np.uint64)
    for k in range(min(Q, max(n, 0))):
        size = (n - k + Q - 1) // Q
        out[k::Q] = np.frombuffer(raw, "<u8", size, k)
    return out


class Index:
    """The q-grams of a block of items, with a bitmap that most text positions fail."""

    def __init__(self, items: list[tuple[int | None, bytes]], max_edit_rate: float) -> None:
        self.items = items
        self.edits = np.array(
            [int(max_edit_rate * len(b)) if len(b) >= SHORT else 0 for _, b in items], np.int64)
        sizes = np.array([len(b) for _, b in items], np.int64)
        self.bound = np.maximum(1, sizes - Q + 1 - Q * self.edits)
        grams = [_grams(b) for _, b in items]
        value = np.concatenate(grams)
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        position = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(value, kind="stable")
        self.value = np.unique(value)
        self.first = np.searchsorted(value[order], self.value)
        self.count = np.diff(np.append(self.first, len(value)))
        self.item, self.position = item[order], position[order]
        self.bitmap = np.zeros(1 << _TABLE_BITS, bool)
        self.bitmap[self._slot(self.value)] = True
        self.wide = int(self.edits.max(initial=0))

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return (values * _MIX) >> np.uint64(64 - _TABLE_BITS)

    def hits(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text position, item and item position of the shared q-grams."""
        places, values = [], []
        for start in range(0, max(len(raw), 1), _POSITIONS):
            grams = _grams(raw[start:start + _POSITIONS + Q - 1])
            likely = np.flatnonzero(self.bitmap[self._slot(grams)])
            places.append(likely + start)
            values.append(grams[likely])
        at, found = np.concatenate(places), np.concatenate(values)
        rank = np.minimum(np.searchsorted(self.value, found), len(self.value) - 1)
        same = self.value[rank] == found
        at, rank = at[same], rank[same]
        n = self.count[rank]
        text = np.repeat(at, n)
        row = np.repeat(self.first[rank], n) + (
            np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        )
        return text, self.item[row], self.position[row]


def _bands(index: Index, starts: np.ndarray, raw: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, from, to) of the bands that reach the bound, as ranges of the buffer. Bands are
    counted within a text, so hits are held for some texts at a time."""
    ends, first = np.append(starts[1:], len(raw)), 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _POSITIONS, side="right")))
        yield from _bands_between(index, starts, raw, int(starts[first]), int(ends[last - 1]))
        first = last


def _bands_between(index, starts, raw, begin, end) -> Iterator[tuple[int, int, int, int]]:
    at, item, position = index.hits(raw[begin:end])
    if not len(at):
        return
    at = at + begin
    doc = np.searchsorted(starts, at, side="right") - 1
    offset = max(len(b) for _, b in index.items)
    diagonal = at - position + offset
    band = diagonal // BAND
    key = doc * len(index.items) + item
    local = band - starts[doc] // BAND  # small again within a text
    # a run of e + 1 diagonals that begins in band b ends at most e further on
    spread = diagonal % BAND
    most = index.edits[item]
    keys, locals_ = [key], [local]
    for back in range(1, index.wide // BAND + 2):
        also = spread + back * BAND < BAND + most
        keys.append(key[also])
        locals_.append(local[also] - back)
    key, local = np.concatenate(keys), np.concatenate(locals_)
    base = local.min()
    span = int(local.max() - base + 1)
    packed, count = np.unique(key * span + (local - base), return_counts=True)
    which = (packed // span) % len(index.items)
    good = count >= index.bound[which]
    packed, which = packed[good], which[good]
    docs = packed // span // len(index.items)
    low = (packed % span + base + starts[docs] // BAND) * BAND - offset
    for d, i, diag in zip(docs.tolist(), which.tolist(), low.tolist()):
        e, m = int(index.edits[i]), len(index.items[i][1])
        yield d, i, diag - e, diag + BAND + 2 * e + m


def align(item: bytes, regions: list[bytes], max_edits: int) -> list[tuple[int, int]]:
    """(edits, end) of the best occurrence of ``item`` in each region, starting anywhere in it.

    Regions are aligned side by side; a cell is a diagonal, so row i reads the text at i + d.
    Beyond the region's ends the text is a byte that equals nothing.
    """
    m = len(item)
    width = max(max(len(r) for r in regions) - m + 2 * max_edits + 1, 2 * max_edits + 1)
    text = np.full((len(regions), m + width + 1), 256, np.int16)
    for row, region in enumerate(regions):
        text[row, max_edits:max_edits + len(region)] = np.frombuffer(region, np.uint8)
    kind = np.int16 if m + width <= 30_000 else np.int32
    far = kind(m + width)
    steps = np.arange(width, dtype=kind)
    cost = np.zeros((len(regions), width), kind)
    for i in range(m):
        swap = cost + (text[:, i:i + width] != item[i])
        drop = np.concatenate([cost[:, 1:], np.full((len(regions), 1), far)], axis=1) + 1
        cost = np.minimum(swap, drop)
        cost = np.minimum.accumulate(cost - steps, axis=1) + steps  # text bytes not in the item
        cost = np.minimum(cost, far).astype(kind)
    best = cost.argmin(axis=1)
    return [
        (int(cost[row, d]), int(min(max(m + d - max_edits, 0), len(regions[row]))))
        for row, d in enumerate(best)
    ]


def _buffers(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    """The texts in runs of about ``_BUFFER`` bytes, drawn as they are searched."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > _BUFFER:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + Q
    if held:
        yield held


def find(index: Index, texts: Iterable[bytes]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of every verified match, best one of overlapping regions."""
    found, first = [], 0
    for some in _buffers(texts):
        parts = [text + b"\0" * Q for text in some]  # q-grams over a border hold a zero: no item does
        starts = np.cumsum([0, *map(len, parts[:-1])])
        found += _find(index, b"".join(parts), starts, some, first)
        first += len(some)
    return found


def _find(index, raw, starts, texts, first) -> list[tuple[int, int, int, int, int]]:
    merged: dict[tuple[int, int], list[list[int]]] = {}
    for d, i, low, high in sorted(_bands(index, starts, raw)):
        low = min(max(low - int(starts[d]), 0), len(texts[d]))
        high = min(max(high - int(starts[d]), 0), len(texts[d]))
        spans = merged.setdefault((d, i), [])
        if spans and low <= spans[-1][1] and high - spans[-1][0] <= 4 * len(index.items[i][1]) + 512:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    found, unsure = [], {}
    for (d, i), spans in merged.items():
        item = index.items[i][1]
        for low, high in spans:
            exact = _exact(texts[d], item, low, high)
            if exact >= 0:
                found.append((first + d, i, exact, exact + len(item), 0))
            elif len(item) >= SHORT:
                unsure.setdefault(i, []).append((d, low, high))
    for i, regions in unsure.items():
        item, most = index.items[i][1], int(index.edits[i])
        for k in range(0, len(regions), _ALIGN):
            part = regions[k:k + _ALIGN]
            scores = align(item, [texts[d][low:high] for d, low, high in part], most)
            for (d, low, _), (edits, end) in zip(part, scores):
                if edits <= most:
                    start = max(low, low + end - len(item) - edits)
                    found.append((first + d, i, start, low + end, edits))
    return found


def _exact(text: bytes, item: bytes, low: int, high: int) -> int:
    """Where the item stands word for word; a short one as whole words. -1 if nowhere."""
    at = text.find(item, low, high)
    while at >= 0 and len(item) < SHORT and (
            text[max(at - 1, 0):at].strip() or text[at + len(item):at + len(item) + 1].strip()):
        at = text.find(item, at + 1, high)
    return at


def passages(raw: bytes) -> list[bytes]:
    """Overlapping passages that cover an item; none if it is no longer than one."""
    size = min(PASSAGE, max(LEAST_PASSAGE, 2 * len(raw) // 3))
    step = size // 4 if 2 * len(raw) < 3 * PASSAGE else size // 2
    last = len(raw) - size
    return [raw[k:k + size] for k in (*range(0, last, step), last)] if last > 0 else []


def _without_covered(found: list, owner: list[int], wholes: int) -> list:
    """The matches without passages where the whole item matches. Entries from ``wholes`` on are
    passages, ``owner`` has the item of each entry."""
    spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for t, i, start, end, _ in found:
        if i < wholes:
            spans.setdefault((t, i), []).append((start, end))
    merged = {k: sorted(v) for k, v in spans.items()}
    kept = []
    for match in found:
        t, i, start, end, _ = match
        if i >= wholes:
            held = merged.get((t, owner[i]), [])
            at = bisect_left(held, (end, 0))
            if at and max(e for _, e in held[max(at - 2, 0):at]) > start:
                continue
        kept.append(match)
    return kept


def _blocks(benchmark: DataFrame, id_column: str, text: str, max_bytes: int):
    """The items in blocks of bounded size, streamed in the order of their ids."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_column).cast("long"), F.col(text)).orderBy(id_column, text)
    for item_id, value in rows.toLocalIterator():
        raw = normalise(value)
        if len(raw) < MIN_BYTES:
            continue
        if block and size + len(raw) > max_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, raw))
        size += len(raw)
    if block:
        yield block


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    max_edit_rate: float = 0.1,
    text: str = "text",
    id_column: str = "doc_id",
    item_column: str = "item_id",
    block_bytes: int = 1 << 20,
) -> DataFrame:
    """Rows ``doc_id, item_id, start, end, edits, bytes``: the matches of items in documents, and
    of passages where the whole item does not match; ``bytes`` is the length of what matches.

    Positions are byte offsets in the normalised text. Of overlapping regions of one document
    and item the best match is given. The benchmark is a stated query set: it is taken in blocks
    of ``block_bytes`` and each block is one pass over all documents, without a shuffle.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def scan(items):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cut = [(i, part) for i, (_, raw) in enumerate(items) for part in passages(raw)]
            entries = [*((i, raw) for i, (_, raw) in enumerate(items)), *cut]
            owner = [i for i, _ in entries]
            index = Index(entries, max_edit_rate)
            for batch in batches:
                found = _without_covered(
                    find(index, map(normalise, batch["text"])), owner, len(items))
                ids = batch["doc_id"].astype("Int64")
                yield pd.DataFrame({
                    "doc_id": pd.array([ids.iloc[f[0]] for f in found], "Int64"),
                    "item_id": pd.array([items[owner[f[1]]][0] for f in found], "Int64"),
                    **{c: np.array([f[k] for f in found], np.int64)
                       for k, c in ((2, "start"), (3, "end"), (4, "edits"))},
                    "bytes": np.array([len(entries[f[1]][1]) for f in found], np.int64),
                })
        return run

    parts = [
        rows.mapInPandas(scan(block), MATCHES)
        for block in _blocks(benchmark, item_column, text, block_bytes)
    ]
    if not parts:
        return docs.sparkSession.createDataFrame([], MATCHES)
    return reduce(DataFrame.unionByName, parts)


def contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id, n_matches, edits, bytes``; the
    edits are the fewest of the longest matches, so those of the whole item if it matches."""
    return matches(docs, benchmark, **settings).groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_matches"), F.min(
            F.struct(-F.col("bytes"), "edits"))["edits"].alias("edits"),
        F.max("bytes").alias("bytes"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_column: str = "item_id",
    max_edit_rate: float = 0.1, block_bytes: int = 1 << 20,
) -> DataFrame:
    """The rows of ``docs`` without a match. Each is judged beside its own text, whatever its id."""

    def hit(items):
        entries = [*items, *((i, part) for i, raw in items for part in passages(raw))]

        @F.arrow_udf(BooleanType())  # texts become Python's a buffer at a time, not a batch
        def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            index = Index(entries, max_edit_rate)
            for batch in batches:
                bad = np.zeros(len(batch), bool)
                bad[[f[0] for f in find(index, (normalise(t.as_py()) for t in batch))]] = True
                yield pa.array(bad)

        return judge

    for block in _blocks(benchmark, item_column, "text", block_bytes):
        docs = docs.where(~hit(block)(F.col(f"`{text}`")))
    return docs
