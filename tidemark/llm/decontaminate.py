"""Benchmark passages in documents: SimHash of item-sized windows and rare shingles, then an exact check.

Each benchmark item gives fingerprints of a window that covers most of it, one
for each of the ``stride`` first places where the window can begin. Documents are
read at every ``stride``-th place with the same window, so a passage that holds
the item is met at one of these places by the very same words. A fingerprint
has 64 bits in four blocks of 16: two fingerprints that differ in at most
``RADIUS`` bits differ in at most ``RADIUS // 4`` bits of some block, so looking
up each block's near values finds all pairs within the radius.

Edits move fingerprints further apart, and a window covers only a part of a long
item, so each item is also looked up by shingles: a text with a similarity of
``LINK`` lacks at most 1 - LINK of the item's shingles, and any one more than that, here
those that fewest items have, hold one that the text has. No passage is lost.

Documents and items found are verified: of all the document's windows of the
item's whole length the best one must reach a weighted Jaccard similarity of
``LINK`` on shingles, each weighted by how often it occurs.

Documents are never shuffled. The benchmark is broadcast in blocks of bounded
size; a larger one takes one pass over the documents for each block.

Defined cases: null and empty texts or items match nothing; items shorter than
a shingle are one shingle of all their words and match only whole texts; letters A-Z count as a-z;
repeated items or documents match each for itself; ids may be null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat

WORDS = 5
LINK = 0.8
#: Differing bits up to which all pairs of fingerprints are found.
RADIUS = 11
#: Longest window in shingles; of longer items a window covers a part.
LONGEST = 255
#: Most items, and characters of items, that are broadcast at once (a longer item alone).
ITEMS, CHARACTERS = 1024, 4_000_000

_FLIPS = np.array(
    [sum(1 << b for b in bits) for k in range(RADIUS // 4 + 1) for bits in combinations(range(16), k)], np.uint16
)


#: The bits of a byte, each in a byte of its own.
_SPREAD = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)[:, :, None], axis=2, bitorder="little").reshape(256, 8).copy().view(np.uint64)[:, 0]


def window_of(shingles: int) -> tuple[int, int]:
    """Window length and stride for an item: window + stride - 1 shingles fit into it."""
    best = (1, 1)
    length = 1
    while True:
        stride = max(1, length // 4)
        if length + stride - 1 > shingles or length > LONGEST:
            return best
        best = (length, stride)
        length = max(length + 1, length * 5 // 4)


def _bits(shingles: np.ndarray) -> np.ndarray:
    """Running counts of set bits before each shingle, eight counters of eight bits in each number.

    Counters run over into the next one, but in the difference of two places
    at most LONGEST apart each is exact.
    """
    counts = np.zeros((len(shingles) + 1, 8), np.uint64)
    np.cumsum(_SPREAD[shingles.view(np.uint8).reshape(-1, 8)], axis=0, out=counts[1:])
    return counts


def _fingerprints(counts: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit SimHash of the windows of ``length`` shingles at these places."""
    step, parts = 1 << 16, []
    for k in range(0, len(at), step):
        sums = counts[at[k : k + step] + length] - counts[at[k : k + step]]
        parts.append(np.packbits(sums.view(np.uint8) > length // 2, axis=1))
    return np.concatenate(parts).reshape(-1).view(np.uint64) if parts else np.zeros(0, np.uint64)


@dataclass
class _Size:
    """Fingerprints of all items of one window length, by the near values of each block."""

    length: int
    stride: int
    prints: list[np.ndarray] = field(default_factory=list)
    items: list[int] = field(default_factory=list)

    def close(self) -> None:
        self.all = np.concatenate(self.prints)
        self.item = np.repeat(self.items, [len(p) for p in self.prints])
        self.offset = np.concatenate([np.arange(len(p)) for p in self.prints])
        blocks = self.all.view(np.uint16).reshape(-1, 4)
        self.blocks = []
        for k in range(4):
            near = (blocks[:, k, None] ^ _FLIPS).reshape(-1)
            order = np.argsort(near, kind="stable")
            begin = np.searchsorted(near[order], np.arange((1 << 16) + 1))
            self.blocks.append((begin.astype(np.int32), (order // len(_FLIPS)).astype(np.int32)))

    def found(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, fingerprint) pairs within the radius, each once or more often."""
        windows, others = [], []
        values = prints.view(np.uint16).reshape(-1, 4)
        for k, (begin, entry) in enumerate(self.blocks):
            first = begin[values[:, k]]
            count = begin[values[:, k].astype(np.int32) + 1] - first
            some = np.flatnonzero(count)
            for part in np.array_split(some, max(1, int(count.sum()) >> 20)):
                total = count[part]
                window = np.repeat(part, total)
                place = np.repeat(first[part] - np.concatenate([[0], np.cumsum(total)[:-1]]), total) + np.arange(total.sum())
                other = entry[place]
                good = np.bitwise_count(prints[window] ^ self.all[other]) <= RADIUS
                windows.append(window[good])
                others.append(other[good])
        return np.concatenate(windows), np.concatenate(others)


class Index:
    """The items of one block, ready for look-up."""

    def __init__(self, texts: list[str | None]) -> None:
        values, begin = flat.shingles(*flat.words(pa.array(texts, pa.string()), lower=True), WORDS)
        #: All shingles of the items; an item's distinct ones are places in it, with their number and first place in the item.
        self.known, place = np.unique(values, return_inverse=True)
        self.items = [np.unique(place[a:b], return_index=True, return_counts=True) for a, b in zip(begin[:-1], begin[1:], strict=True)]
        self.some = np.zeros(1 << 22, bool)
        self.some[self.known >> np.uint64(42)] = True
        self._anchor()
        sizes: dict[int, _Size] = {}
        for item, (a, b) in enumerate(zip(begin[:-1], begin[1:], strict=True)):
            if a == b:
                continue
            length, stride = window_of(b - a)
            size = sizes.setdefault(length, _Size(length, stride))
            size.prints.append(_fingerprints(_bits(values[a:b]), np.arange(stride), length))
            size.items.append(item)
        self.sizes = list(sizes.values())
        for size in self.sizes:
            size.close()

    def _anchor(self) -> None:
        """The items that each known shingle leads to: of each item so many shingles that no match lacks them all."""
        holders = np.bincount(np.concatenate([np.zeros(0, np.int64), *[places for places, _, _ in self.items]]), minlength=len(self.known))
        leads, items = [], []
        for item, (places, _, count) in enumerate(self.items):
            order = np.lexsort((places, holders[places]))
            n = int(count.sum())
            spare = n - math.ceil(LINK * n - 1e-9)
            taken = order[: np.searchsorted(np.cumsum(count[order]), spare, "right") + 1]
            leads.append(places[taken])
            items.append(np.full(len(taken), item))
        lead = np.concatenate([np.zeros(0, np.int64), *leads])
        order = np.argsort(lead, kind="stable")
        self.lead = np.searchsorted(lead[order], np.arange(len(self.known) + 1))
        self.led = np.concatenate([np.zeros(0, np.int64), *items])[order]

    def _led(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        """row * items + item, for the items that these known shingles of the rows lead to."""
        pairs = np.unique(row * len(self.known) + place)
        row, place = pairs // len(self.known), pairs % len(self.known)
        count = self.lead[place + 1] - self.lead[place]
        out = [np.zeros(0, np.int64)]
        for part in np.array_split(np.flatnonzero(count), max(1, int(count.sum()) >> 20)):
            total = count[part]
            at = np.repeat(self.lead[place[part]] - (np.cumsum(total) - total), total) + np.arange(total.sum())
            out.append(np.unique(np.repeat(row[part], total) * len(self.items) + self.led[at]))
        return np.concatenate(out)

    def _near(self, values: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """row * items + item, for all windows and fingerprints within the radius."""
        counts, sizes = _bits(values), np.diff(begin)
        out = [np.zeros(0, np.int64)]
        for size in self.sizes:
            places = np.maximum((sizes - size.length) // size.stride + 1, 0) * (sizes >= size.length)
            row = np.repeat(np.arange(len(sizes)), places)
            at = begin[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(places) - places, places)) * size.stride
            window, other = size.found(_fingerprints(counts, at, size.length))
            out.append(row[window] * len(self.items) + size.item[other])
        return np.concatenate(out)

    def best(self, item: int, at: np.ndarray, place: np.ndarray, size: int) -> tuple[float, int]:
        """Best weighted Jaccard similarity of an item and a window of its length, and where the window begins.

        The text has ``size`` shingles, the known ones among them ``at`` these places.
        A text that is shorter than the item is one window.
        """
        mine, first, count = self.items[item]
        length = int(count.sum())
        k = np.minimum(np.searchsorted(mine, place), len(mine) - 1)
        at, k = at[mine[k] == place], k[mine[k] == place]
        if not len(at):
            return 0.0, 0
        # An occurrence counts in windows that hold it and fewer than ``count`` earlier ones of its shingle.
        order = np.lexsort((at, k))
        at, k = at[order], k[order]
        back = np.arange(len(at)) - count[k]
        after = np.where((back >= 0) & (k[back] == k), at[back] + 1, 0)
        low, high = np.maximum(after, at - length + 1), np.minimum(at, max(size - length, 0))
        low, high = np.maximum(low[low <= high], 0), high[low <= high]
        starts, which = np.unique(np.concatenate([low, high + 1]), return_inverse=True)
        both = np.cumsum(np.bincount(which[: len(low)], minlength=len(starts)) - np.bincount(which[len(low) :], minlength=len(starts)))
        top = int(both.argmax())
        share = float(both[top] / (length + min(length, size) - both[top]))
        last = top
        while both[last + 1] == both[top]:
            last += 1
        # Of equally good windows the one that the first common shingle stands in as it does in the item.
        inside = np.flatnonzero(at >= starts[top])
        lead = inside[at[inside].argmin()]
        return share, int(min(max(at[lead] - first[k[lead]], starts[top]), starts[last + 1] - 1))

    def matches(self, column: pa.Array) -> dict[tuple[int, int], tuple[float, int]]:
        """(row, item): best similarity of at least LINK, and the window's first word."""
        values, begin = flat.shingles(*flat.words(column, lower=True), WORDS)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        if not len(values) or not self.sizes:
            return best
        at = np.flatnonzero(self.some[values >> np.uint64(42)])
        place = np.minimum(np.searchsorted(self.known, values[at]), len(self.known) - 1)
        same = self.known[place] == values[at]
        at, place = at[same], place[same]
        row = np.searchsorted(begin, at, "right") - 1
        for pair in np.unique(np.concatenate([self._led(row, place), self._near(values, begin)])).tolist():
            r, item = divmod(pair, len(self.items))
            a, b = np.searchsorted(row, [r, r + 1])
            share, start = self.best(item, at[a:b] - begin[r], place[a:b], int(begin[r + 1] - begin[r]))
            if share >= LINK:
                best[r, item] = (share, start)
        return best


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[tuple[list, list]]:
    """Ids and texts of the items, in blocks of bounded size."""
    items = benchmark.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("text is not null")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("c")).first()
    count = max(1, math.ceil(max(size["n"] / ITEMS, (size["c"] or 0) / CHARACTERS)))
    for k in range(count if size["n"] else 0):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).orderBy("id", "text").toArrow()
        if part.num_rows:
            yield part.column("id").to_pylist(), part.column("text").to_pylist()


_built: dict[int, Index] = {}


def _index(shared) -> Index:
    """The look-up tables, built once in each Python worker from the broadcast texts."""
    key = hash(tuple(shared.value))
    if key not in _built:
        _built.clear()
        _built[key] = Index(shared.value)
    return _built[key]


def matches(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """(id, item, similarity, word) for each document and item it holds; ``word`` is where the passage begins."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    out = spark.createDataFrame([], f"{id_column} long, {item_column} long, similarity double, word long")
    for ids, texts in _blocks(benchmark, item_column, "text"):
        shared = spark.sparkContext.broadcast(texts)

        def work(batches: Iterator[pa.RecordBatch], ids=ids, shared=shared) -> Iterator[pa.RecordBatch]:
            for run in flat.runs(batches):
                found = sorted(_index(shared).matches(run.column("text")).items())
                taken = run.column("id").take(pa.array([r for (r, _), _ in found], pa.int64()))
                columns = [[ids[i] for (_, i), _ in found], [s for _, (s, _) in found], [w for _, (_, w) in found]]
                kinds = (pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [taken, *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]], [id_column, item_column, "similarity", "word"]
                )

        out = out.union(rows.mapInArrow(work, out.schema))
    return out


def without_passages(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """The rows of ``docs`` with all their columns, without those that hold a benchmark item."""
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    text = f"c{names.index(text_column)}"
    for _, texts in _blocks(benchmark, item_column, "text"):
        shared = docs.sparkSession.sparkContext.broadcast(texts)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for run in flat.runs(batches, text):
                held = {r for r, _ in _index(shared).matches(run.column(text))}
                yield run.filter(pa.array([r not in held for r in range(run.num_rows)], pa.bool_()))

        plain = plain.mapInArrow(work, plain.schema)
    return plain.toDF(*names)
