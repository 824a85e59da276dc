"""Removal of bytes covered by repeated strings of ``LENGTH`` bytes.

Strings are compared in full, over all texts and within them; a byte goes if a
string that covers it also starts anywhere else.

Method. The suffix array of the whole collection is never built: only strings
that can have a partner are ordered. Every window of LENGTH bytes holds
an anchor, the place where the hash of GRAM bytes is least in the window; equal
windows have equal anchors at equal places, so anchors that occur once rule out
all windows that contain them. Around the others lies a context, every window
that contains the anchor. Equal contexts are counted as one. Different contexts
of one anchor are ordered column-wise: from the last column to the first, each
round puts one symbol in front of every context's suffix, and updates the order
of the collection and the common prefixes of neighbours. Where a common
prefix reaches LENGTH, the window that begins there is repeated.

Contexts are dealt over tasks by anchor and ordered in sequential chunks of
bounded size. The few anchors with more than ``GROUP`` different contexts take
another, equally exact way: their windows are hashed and counted by Spark, so
that no group has to fit into one task.

Defined cases: a null text is empty; texts shorter than LENGTH lose nothing;
rows with equal text are occurrences of each other, so all of a text that is
long enough goes; ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.tables import hot_keys, spread_join, written

LENGTH = 200
#: Bytes of an anchor.
GRAM = 40
#: Contexts ordered at once, and most different contexts of one anchor that are ordered together.
CHUNK, GROUP = 20_000, 50_000

#: Windows that contain an anchor: it lies 0 to BEFORE bytes after their start.
BEFORE = LENGTH - GRAM


def _sliding(values: np.ndarray, size: int, of: np.ufunc, empty: int) -> np.ndarray:
    """Least or greatest of each ``size`` neighbours, from blockwise running values."""
    n = len(values) - size + 1
    padded = np.full(-(-len(values) // size) * size, empty, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, size)
    ahead = of.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = of.accumulate(blocks, axis=1).reshape(-1)
    return of(ahead[:n], behind[size - 1 : size - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all rows; every window of LENGTH bytes in a row has one."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places = np.arange(len(data) - GRAM + 1)
    grams = flat.span_hashes(data, places, places + GRAM)
    window = BEFORE + 1
    least = _sliding(grams, window, np.minimum, np.iinfo(np.uint64).max)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.arange(len(least))
    inside = row[starts] == row[starts + LENGTH - 1]
    # A place is an anchor if its hash is the least of some window that lies in one row.
    best = np.concatenate([np.zeros(BEFORE, np.uint64), np.where(inside, least, np.uint64(0)), np.zeros(BEFORE, np.uint64)])
    most = _sliding(best, window, np.maximum, 0)
    at = np.flatnonzero((most == grams) & (most > 0))
    return at, grams[at]


def _found(texts: bool):
    """Anchors of each text (once a task for equal texts), with their contexts' hashes and reach."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for run in flat.runs(batches):
            keys = run.column("key").to_numpy()
            new = []
            for i, key in enumerate(keys.tolist()):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            run = run.take(pa.array(new, pa.int64()))
            data, offsets = flat.flat_bytes(run.column("text"))
            at, hashes = anchors(data, offsets)
            row = np.searchsorted(offsets, at, "right") - 1
            left = np.minimum(at - offsets[row], BEFORE)
            right = np.minimum(offsets[row + 1] - at, LENGTH)
            context = flat.mix(flat.span_hashes(data, at - left, at + right) + left.astype(np.uint64))
            columns = {"anchor": pa.array(hashes.view(np.int64)), "context": pa.array(context.view(np.int64))}
            if texts:
                columns |= {
                    "key": pa.array(run.column("key").to_numpy()[row]), "at": pa.array(at - offsets[row]),
                    "before": pa.array(left.astype(np.int16)), "after": pa.array(right.astype(np.int16)),
                }
            yield pa.RecordBatch.from_pydict(columns)

    return work


def _matrix(contexts: list[bytes], before: np.ndarray) -> np.ndarray:
    """Contexts as rows with their anchors in one column; 256 where a context has no byte."""
    out = np.full((len(contexts), BEFORE + LENGTH), 256, np.uint16)
    for i, (context, left) in enumerate(zip(contexts, before.tolist(), strict=True)):
        out[i, BEFORE - left : BEFORE - left + len(context)] = np.frombuffer(context, np.uint8)
    return out


def common_windows(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context the first and last column at which a repeated window begins (-1: none).

    Column-wise construction: ``order`` holds the contexts by their suffixes from
    the current column on, ``common`` the prefix that each shares with the one before.
    """
    n, width = symbols.shape
    order, common = np.arange(n), np.zeros(n + 1, np.int64)
    first, last = np.full(n, -1), np.full(n, -1)
    for column in range(width - 1, -1, -1):
        ahead = symbols[order, column]
        moved = np.argsort(ahead, kind="stable")
        sorted_ = ahead[moved]
        shared = np.zeros(n + 1, np.int64)
        same = np.flatnonzero((sorted_[1:] == sorted_[:-1]) & (sorted_[1:] != 256)) + 1
        if len(same):
            bounds = np.stack([moved[same - 1] + 1, moved[same] + 1], axis=1).reshape(-1)
            shared[same] = 1 + np.minimum.reduceat(common, bounds)[::2]
        order, common = order[moved], shared
        if column <= BEFORE:
            hit = common[:-1] >= LENGTH
            hit[:-1] |= common[1:-1] >= LENGTH
            found = order[hit]
            first[found] = column
            last[found] = np.where(last[found] < 0, column, last[found])
    return first, last


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, context, low, high) of the contexts with repeated windows; rows come sorted by anchor."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        first, last = common_windows(_matrix([r[3] for r in rows], np.array([r[2] for r in rows])))
        keep = [(r[0], r[1], int(f) - BEFORE, int(m) - BEFORE + LENGTH) for r, f, m in zip(rows, first, last, strict=True) if f >= 0]
        columns = zip(*keep, strict=True) if keep else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "context", "low", "high"])

    waiting: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "before", "bytes")), strict=True):
            if len(waiting) >= CHUNK and waiting[-1][0] != row[0]:
                yield done(waiting)
                waiting = []
            waiting.append(row)
    if waiting:
        yield done(waiting)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, anchor, context, low) for every window of the contexts."""
    for batch in batches:
        for part in flat.runs([batch], "bytes"):
            data, offsets = flat.flat_bytes(part.column("bytes"))
            before = part.column("before").to_numpy().astype(np.int64)
            places = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
            row = np.repeat(np.arange(part.num_rows), places)
            step = np.arange(len(row)) - np.repeat(np.cumsum(places) - places, places)
            start = offsets[:-1][row] + step
            hashes = flat.span_hashes(data, start, start + LENGTH)
            yield pa.RecordBatch.from_pydict(
                {
                    "hash": pa.array(hashes.view(np.int64)), "anchor": pa.array(part.column("anchor").to_numpy()[row]),
                    "context": pa.array(part.column("context").to_numpy()[row]), "low": pa.array(step - before[row]),
                }
            )


def _rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for run in flat.runs(batches):
        rows = []
        for key, text, spans in zip(*(run.column(c).to_pylist() for c in ("key", "text", "spans")), strict=True):
            data, merged = text.encode(), []
            for span in sorted((s["low"], s["high"]) for s in spans):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                else:
                    merged.append(list(span))
            rest, at = hashlib.sha256(), 0
            for low, high in merged:
                rest.update(data[at:low])
                at = high
            rest.update(data[at:])
            rows.append((key, sum(b - a for a, b in merged), len(merged), rest.hexdigest(), [x for span in merged for x in span]))
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["key", "n_removed", "n_spans", "kept_sha256", "removed"])


def repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", group: int = GROUP) -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, removed.

    ``removed`` lists start and end of each removed run, in bytes.
    """
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    plain = plain.withColumn("key", F.xxhash64("text"))
    base = written(plain.select("id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole_sha256")))
    copied = base.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("key", F.lit(True).alias("copied"))

    texts = plain.where(F.octet_length("text") >= LENGTH)
    known = texts.mapInArrow(_found(False), "anchor long, context long")
    counts = known.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("a"), F.max("context").alias("b"))
    shared = written(counts.where("n > 1").select("anchor", "n", (F.col("a") != F.col("b")).alias("several")))
    occurrences = texts.mapInArrow(_found(True), "anchor long, context long, key long, at long, before short, after short")
    occurrences = written(spread_join(occurrences, shared.drop("n"), ["anchor"], ["key", "at"], hot_keys(shared, ["anchor"])))

    groups = occurrences.groupBy("anchor", "context", "several").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "at", "before", "after")).alias("one")
    )
    groups = written(groups.select("anchor", "context", "several", "n", "one.*"))
    whole = groups.where("n > 1").select("anchor", "context", (-F.col("before")).cast("long").alias("low"), F.col("after").cast("long").alias("high"))

    involved = written(texts.join(occurrences.select("key").distinct(), "key").select("key", "text").dropDuplicates(["key"]))
    slice_ = F.substring(F.col("text").cast("binary"), (F.col("at") - F.col("before") + 1).cast("int"), (F.col("before") + F.col("after")).cast("int"))
    open_ = written(groups.where("several").join(involved, "key").select("anchor", "context", "before", slice_.alias("bytes")))
    hot = written(open_.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select("anchor"))
    kind = "anchor long, context long, low long, high long"
    some = open_.join(hot, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_ordered, kind)
    windows = open_.join(hot, "anchor", "left_semi").mapInArrow(_windows, "hash long, anchor long, context long, low long")
    # By anchor and place too: a window is met again around each anchor that it contains.
    same = ["hash", "anchor", "low"]
    twice = windows.groupBy(same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(same)
    rest = windows.join(twice, same, "left_semi").groupBy("anchor", "context").agg(F.min("low").alias("low"), (F.max("low") + LENGTH).alias("high"))
    covered = whole.union(some).union(rest).groupBy("anchor", "context").agg(F.min("low").alias("low"), F.max("high").alias("high"))

    same = ["anchor", "context"]
    met = spread_join(occurrences, covered, same, ["key", "at"], hot_keys(groups, same))
    spans = met.select("key", F.struct((F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high")).alias("span"))
    spans = spans.groupBy("key").agg(F.collect_set("span").alias("spans"))
    rests = involved.join(spans, "key").mapInArrow(_rests, "key long, n_removed long, n_spans long, kept_sha256 string, removed array<long>")

    rows = base.join(rests, "key", "left").join(copied, "key", "left")
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= LENGTH)
    return rows.select(
        F.col("id").alias(id_column),
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(gone, F.array(F.lit(0).cast("long"), F.col("n_bytes"))).otherwise(F.coalesce("removed", F.array().cast("array<long>"))).alias("removed"),
    )
