"""Removal of words covered by repeated windows of ``WINDOW`` consecutive words.

A word goes if a window that covers it also starts anywhere else, in another
text or in the same one; windows are judged on the input.

Method: super-k-mers. Each window's minimiser is the least of its runs of
GRAM words. Consecutive windows with one minimiser travel as one packed string
(at most MOST windows) to the bucket of that minimiser; equal windows have equal
minimisers, so they meet there, are sorted, and counted exactly: windows
with equal hashes are compared word by word.

* **Order of minimisers.** Rarer word runs come first, by counters over all texts.
  A line that stands in very many texts is thereby not the minimiser of the
  windows that hold it together with something else, and windows within a common
  passage form the same few strings everywhere.
* **Before the shuffle** equal strings of a task are sent once, with their number.
* **Packing.** Frequent words take two bytes, others stand in full between two
  marks. Any list of frequent words gives the same result.
* **A bucket's minimiser with more than GROUP different strings** doesn't have to fit into
  a task: its windows are handed on, and Spark counts them by their digests.
* **Back to the texts.** Strings with repeated windows are joined to the places
  they came from by their digests (128 bits), the places to the texts.

Defined cases: a null text is empty; texts of fewer than WINDOW words lose
nothing; rows with equal text are occurrences of each other, so all words of a
text that is long enough go; ids may be null or repeated and of any type; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.repeats import _sliding
from tidemark.llm.tables import written, written_and_cleared

WINDOW = 35
#: Words of a minimiser, and most windows of a packed string (bits of a mask).
GRAM, MOST = 4, 32
#: Counters of word runs: 2 ** SKETCH_BITS, whatever the input.
SKETCH_BITS = 17
#: Two-byte codes: both bytes lie below 254; 255 and 254 enclose a word in full.
OPEN, CLOSE, BYTE = 255, 254, 254
DICTIONARY = BYTE * BYTE
#: A word comes into the dictionary by the tasks of whose words it makes up 1 / SHARE; what a run of texts holds once isn't counted.
SHARE = 1 << 18
#: Strings worked on at once, strings of one minimiser counted in a task, strings a task compares before it sends them.
CHUNK, GROUP, FLUSH = 20_000, 200_000, 100_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ONE = np.uint64(1)


class Words:
    """The words of an Arrow column, end to end."""

    def __init__(self, column: pa.Array):
        self.data, offsets = flat.flat_bytes(column)
        self.starts, self.stops, self.first = flat.word_bounds(self.data, offsets)
        self.ends = np.concatenate([[0], np.cumsum(self.stops - self.starts)])
        self.solid = self.data[~flat.WHITE[self.data]]

    def __len__(self) -> int:
        return len(self.starts)

    def binary(self) -> pa.Array:
        return binary_array(self.ends, self.solid)

    def grams(self) -> np.ndarray:
        """The hash of the GRAM words from each word on; runs across rows belong to no window."""
        hashes = flat.span_hashes(self.data, self.starts, self.stops)
        padded = np.concatenate([hashes, np.zeros(GRAM, np.uint64)])
        out = np.zeros(len(self), np.uint64)
        for k in range(GRAM):
            out += padded[k : k + len(self)] * np.uint64(2 * k + 1)
            out = flat.mix(out)
        return out


def binary_array(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    kind, width = (pa.binary(), np.int32) if offsets[-1] < 1 << 31 else (pa.large_binary(), np.int64)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(np.ascontiguousarray(data))])


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of ``data``, which may overlap, end to end, with their offsets."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])], offsets


def packed_words(words: Words, dictionary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words packed end to end, with their offsets."""
    seen = words.binary().dictionary_encode()
    known = pc.fill_null(pc.index_in(seen.dictionary.cast(pa.binary()), value_set=dictionary), -1).to_numpy(zero_copy_only=False)
    code = known[seen.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
    sizes = np.diff(words.ends)
    short = code >= 0
    offsets = np.concatenate([[0], np.cumsum(np.where(short, 2, sizes + 2))])
    out = np.empty(offsets[-1], np.uint8)
    at = offsets[:-1]
    out[at[short]], out[at[short] + 1] = code[short] // BYTE, code[short] % BYTE
    full = np.flatnonzero(~short)
    out[at[full]], out[offsets[1:][full] - 1] = OPEN, CLOSE
    inside, ends = slices(words.solid, words.ends[full], words.ends[full + 1])
    out[np.repeat(at[full] + 1 - ends[:-1], sizes[full]) + np.arange(ends[-1])] = inside
    return out, offsets


def unpacked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of packed strings (equal words of the call have equal numbers), and each string's first word."""
    opens, closes = data == OPEN, data == CLOSE
    inside = (np.cumsum(opens) - np.cumsum(closes)).astype(bool)
    codes = np.flatnonzero(~inside & ~closes)[::2]
    full = np.flatnonzero(opens)
    starts = np.sort(np.concatenate([codes, full]))
    ids = np.empty(len(starts), np.int64)
    ids[np.searchsorted(starts, codes)] = data[codes].astype(np.int64) * BYTE + data[codes + 1]
    if len(full):
        ends = np.concatenate([[0], np.cumsum(np.flatnonzero(closes) - full - 1)])
        ids[np.searchsorted(starts, full)] = DICTIONARY + binary_array(ends, data[inside & ~opens]).dictionary_encode().indices.to_numpy()
    return ids, np.searchsorted(starts, offsets)


def super_kmers(words: Words, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of each super-k-mer, in order."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = words.grams()
    order = ranks[(grams >> np.uint64(64 - SKETCH_BITS)).view(np.int64)].astype(np.uint64) << np.uint64(58) | flat.mix(grams + _ONE) >> np.uint64(6)
    least = _sliding(order, WINDOW - GRAM + 1, np.minimum, np.iinfo(np.uint64).max)[:n]
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    starts = np.flatnonzero(row[:n] == row[WINDOW - 1 :])
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    new = np.concatenate([[True], (np.diff(starts) > 1) | (least[starts[1:]] != least[starts[:-1]])])
    begin = np.flatnonzero(new)
    new[(np.arange(len(starts)) - np.repeat(begin, np.diff(np.append(begin, len(starts))))) % MOST == 0] = True
    begin = np.flatnonzero(new)
    return starts[begin], np.diff(np.append(begin, len(starts))), least[starts[begin]]


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows; of equal texts of a task the first."""
    seen: set[bytes] = set()
    for run in flat.runs(batches):
        new = []
        for i, key in enumerate(run.column("key").to_pylist()):
            if key not in seen:
                seen.add(key)
                new.append(i)
        if new:
            yield run.take(pa.array(new, pa.int64()))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: each text's number of words and hash of them. Kind 1: counters of word runs. Kind 2: frequent words."""
    names = ["kind", "key", "n", "digest"]
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    often: Counter[bytes] = Counter()
    total, lost = 0, 0
    for run in _distinct(batches):
        words = Words(run.column("text"))
        total += len(words)
        if len(words):
            np.add(counts, np.bincount((words.grams() >> np.uint64(64 - SKETCH_BITS)).view(np.int64), minlength=len(counts)), out=counts)
            seen = words.binary().dictionary_encode()
            n = np.bincount(seen.indices.to_numpy())
            many = np.flatnonzero(n > 1)
            often.update(dict(zip(seen.dictionary.take(pa.array(many)).to_pylist(), n[many].tolist(), strict=True)))
            if len(often) > 2 * SHARE:  # lossy counting: what is dropped makes up less than 1 / SHARE
                lost = total // SHARE
                often = Counter({w: c for w, c in often.items() if c > lost})
        digests = [hashlib.sha256(b" ".join(t.encode().split())).digest() for t in run.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(run.num_rows, np.int32)), run.column("key"), pa.array(np.diff(words.first)), pa.array(digests, pa.binary())], names
        )
    full = np.flatnonzero(counts)
    for at in range(0, len(full), 100_000):
        part = full[at : at + 100_000]
        keys = pa.array([int(i).to_bytes(4, "big") for i in part], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(part), np.int32)), keys, pa.array(counts[part]), pa.nulls(len(part), pa.binary())], names)
    kept = [(w, c) for w, c in often.items() if c * SHARE >= total and len(w) > 2]
    for at in range(0, len(kept), 100_000):
        keys, n = zip(*kept[at : at + 100_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([2] * len(n), pa.int32()), pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.nulls(len(n), pa.binary())], names)


def _strings(shared, places: bool):
    """The packed strings of each text: with their places, or once a task (FLUSH strings at a time) with their number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, frequent = shared.value
        dictionary, waiting = pa.array(frequent, pa.binary()), Counter()

        def sent() -> pa.RecordBatch:
            columns = [[m for m, _ in waiting], [p for _, p in waiting], list(waiting.values())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64()), strict=True)], ["minimiser", "packed", "n"])

        for run in _distinct(batches):
            words = Words(run.column("text"))
            first, n, least = super_kmers(words, ranks)
            if not len(first):
                continue
            data, offsets = packed_words(words, dictionary)
            row = np.searchsorted(words.first, first, "right") - 1
            for a in range(0, len(first), FLUSH):
                part = slice(a, a + FLUSH)
                packed, ends = slices(data, offsets[first[part]], offsets[first[part] + n[part] + WINDOW - 1])
                column = binary_array(ends, packed).cast(pa.binary())
                if places:
                    keys = run.column("key").take(pa.array(row[part]))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(first[part] - words.first[row[part]]), column], ["key", "at", "packed"])
                else:
                    waiting.update(zip(least[part].view(np.int64).tolist(), column.to_pylist(), strict=True))
                    if len(waiting) >= FLUSH:
                        yield sent()
                        waiting.clear()
        if waiting:
            yield sent()

    return work


def window_hashes(ids: np.ndarray) -> np.ndarray:
    n = len(ids) - WINDOW + 1
    total = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(flat.mix(ids.astype(np.uint64) + _ONE) * flat.powers(_BASE, len(ids)), out=total[1:])
    return flat.mix((total[WINDOW:] - total[:n]) * flat.powers(_INVERSE, len(ids) + 1)[:n])


def repeated_windows(strings: list[bytes], counts: list[int]) -> np.ndarray:
    """For each string the mask of its windows that occur more than once, a string counting ``counts`` times."""
    data, offsets = np.frombuffer(b"".join(strings), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    ids, first = unpacked(data, offsets)
    n = np.diff(first) - WINDOW + 1
    string = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n)
    starts = first[:-1][string] + place
    hashes = window_hashes(ids)[starts]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    pairs, equal = np.flatnonzero(same), np.ones(len(same), bool)
    for at in range(0, len(pairs), 50_000):
        part = pairs[at : at + 50_000]
        equal[part] = (ids[starts[order[part]][:, None] + np.arange(WINDOW)] == ids[starts[order[part + 1]][:, None] + np.arange(WINDOW)]).all(axis=1)
    many = np.array(counts, np.int64)[string]
    group = np.concatenate([[0], np.cumsum(~same)])
    sums = np.bincount(group, many[order], minlength=group[-1] + 1 if len(group) else 0)
    hit = np.zeros(len(order), bool)
    hit[order] = sums[group] > 1
    for g in np.unique(group[:-1][same & ~equal]):  # different windows with one hash
        members = order[group == g]
        tally: Counter[bytes] = Counter()
        for w in members:
            tally[ids[starts[w] : starts[w] + WINDOW].tobytes()] += int(many[w])
        hit[members] = [tally[ids[starts[w] : starts[w] + WINDOW].tobytes()] > 1 for w in members]
    masks = np.zeros(len(n), np.int64)
    np.add.at(masks, string[hit], np.int64(1) << place[hit])
    return masks


def _windows_of(strings: list[bytes], counts: list[int]) -> pa.RecordBatch:
    """Each window of the strings with a digest of its words."""
    out = []
    for packed, count in zip(strings, counts, strict=True):
        parts, at = [], 0
        while at < len(packed):
            end = packed.index(CLOSE, at) + 1 if packed[at] == OPEN else at + 2
            parts.append(packed[at:end])
            at = end
        for j in range(len(parts) - WINDOW + 1):
            out.append((packed, 1 << j, hashlib.md5(b"".join(parts[j : j + WINDOW])).digest(), count))
    columns = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.binary(), pa.int64()), strict=True)], ["packed", "mask", "window", "n"])


def _counted(group: int):
    """(packed, mask) of strings with repeated windows; rows come sorted by minimiser. Windows of larger groups keep their digests."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: Counter) -> pa.RecordBatch:
            strings = [packed for _, packed in rows]
            masks = repeated_windows(strings, list(rows.values()))
            hit = np.flatnonzero(masks)
            return pa.RecordBatch.from_arrays(
                [pa.array([strings[i] for i in hit], pa.binary()), pa.array(masks[hit]), pa.nulls(len(hit), pa.binary()), pa.nulls(len(hit), pa.int64())], ["packed", "mask", "window", "n"]
            )

        waiting: Counter[tuple[int, bytes]] = Counter()  # whole groups and the one at hand
        here: Counter[tuple[int, bytes]] = Counter()
        large, last = False, None
        for batch in batches:
            for least, packed, n in zip(*(batch.column(c).to_pylist() for c in ("minimiser", "packed", "n")), strict=True):
                if least != last:
                    if large and here:
                        yield _windows_of([p for _, p in here], list(here.values()))
                    elif here:
                        waiting.update(here)
                    if len(waiting) >= CHUNK:
                        yield done(waiting)
                        waiting.clear()
                    here, large, last = Counter(), False, least
                here[least, packed] += n
                if len(here) > (CHUNK if large else group):
                    large = True
                    for at in range(0, len(here), 2000):
                        part = list(here.items())[at : at + 2000]
                        yield _windows_of([p for (_, p), _ in part], [c for _, c in part])
                    here.clear()
        if large and here:
            yield _windows_of([p for _, p in here], list(here.values()))
        elif here:
            waiting.update(here)
        if waiting:
            yield done(waiting)

    return work


def covered(at: list[int], masks: list[int], n: int) -> np.ndarray:
    """Which of a text's ``n`` words lie in the marked windows of the strings that begin ``at``."""
    begin = np.array(at, np.int64)[:, None] + np.arange(MOST)
    starts = begin[(np.array(masks, np.int64)[:, None] >> np.arange(MOST)) & 1 == 1]
    change = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + WINDOW, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text, and the removed spans of words."""
    names = ["key", "n_removed", "kept_sha256", "removed"]
    for run in flat.runs(batches):
        rows = []
        for key, text, found in zip(*(run.column(c).to_pylist() for c in ("key", "text", "found")), strict=True):
            words = text.encode().split()
            gone = covered([f["at"] for f in found], [f["mask"] for f in found], len(words))
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            rest = hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])).hexdigest()
            rows.append((key, int(gone.sum()), rest, edges.tolist()))
        kinds = (pa.binary(), pa.int64(), pa.string(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def repeated_windows_removed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", group: int = GROUP) -> DataFrame:
    """One row for each row of ``docs``: id, n_words, n_removed, kept_sha256, removed.

    ``removed`` lists first word and end of each removed run. ``group``: strings of
    one minimiser that a task counts itself.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    plain = plain.withColumn("key", F.unhex(F.md5("text")))
    texts = plain.select("key", "text")
    base = written(plain.select("id", "key"))

    measured = written(texts.mapInArrow(_measured, "kind int, key binary, n long, digest binary"))
    counters = measured.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
    counters = counters.select(F.conv(F.hex("key"), 16, 10).cast("int").alias("i"), F.log2("n").cast("int").alias("rank")).toPandas()
    ranks = np.zeros(1 << SKETCH_BITS, np.uint8)
    ranks[counters["i"]] = np.minimum(counters["rank"], 31)
    frequent = measured.where("kind = 2").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(DICTIONARY)
    shared = spark.sparkContext.broadcast((ranks, [bytes(r.key) for r in frequent.select("key").collect()]))

    strings = texts.mapInArrow(_strings(shared, False), "minimiser long, packed binary, n long")
    kind = "packed binary, mask long, window binary, n long"
    found = strings.repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(_counted(group), kind)
    found = written_and_cleared(found.select(F.unhex(F.md5("packed")).alias("string"), "mask", "window", "n"))
    again = found.where("window IS NOT NULL").groupBy("window").agg(F.sum("n").alias("m")).where("m > 1").select("window")
    hits = found.where("window IS NULL").select("string", "mask").union(
        found.where("window IS NOT NULL").join(again, "window", "left_semi").select("string", "mask")
    )
    hits = written(hits.groupBy("string").agg(F.bit_or("mask").alias("mask")))

    rows = base.join(measured.where("kind = 0").dropDuplicates(["key"]).select("key", F.col("n").alias("n_words"), "digest"), "key")
    copied = base.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("key", F.lit(True).alias("copied"))
    places = texts.mapInArrow(_strings(shared, True), "key binary, at long, packed binary").select("key", "at", F.unhex(F.md5("packed")).alias("string"))
    places = places.join(hits, "string").groupBy("key").agg(F.collect_set(F.struct("at", "mask")).alias("found"))
    places = written_and_cleared(places.join(copied, "key", "left_anti"))
    rests = texts.join(places, "key").mapInArrow(_rests, "key binary, n_removed long, kept_sha256 string, removed array<long>")

    rows = rows.join(rests, "key", "left").join(copied, "key", "left")
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_words") >= WINDOW)
    return rows.select(
        F.col("id").alias(id_column),
        "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        F.when(gone, F.array(F.lit(0).cast("long"), F.col("n_words"))).otherwise(F.coalesce("removed", F.array().cast("array<long>"))).alias("removed"),
    )
