"""Quality grades by ordinal cumulative-link regression on hashed text.

A text's score is a weighted sum over hashed tokens: its words, the shapes of
its words (beginning and end, letters and digits by kind), repetitions of the
word before, and its length. Grades share these weights; the chance of grade k
or more is the logistic function of the score less the k-th threshold, and the
thresholds rise. ``expected`` is the mean grade, ``tail`` the chance of at least
grade ``SELECT``, by which a text is selected.

Ratings are learned from at most ``SAMPLE`` labelled rows, the first in the
order of a hash of the id, equal texts counted once. Documents are scored where
they are read: nothing is shuffled.

Defined cases: null and empty texts are scored as a text of length 0; without
labelled rows every grade is as likely as any other; with one grade only every
text has it; rows with a null id are scored and never learned from; repeated
rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.toxicity import labelled

#: Most labelled rows read for learning.
SAMPLE = 12_000
#: Hashed weights, as a power of two.
BITS = 15
#: Grades are 0, 1 and 2; texts are selected by the chance of at least SELECT.
GRADES, SELECT = 3, 1
#: Steps of the fit, their length, and the penalty on squared weights.
STEPS, RATE, RIDGE = 150, 0.05, 1e-4
#: Weight of each family of tokens: words, shapes, repetitions, length.
SCALE = (6.0, 6.0, 6.0, 1.0)

_KIND = np.arange(256, dtype=np.uint8)
_KIND[[*range(97, 123), *range(128, 256)]] = 97
_KIND[65:91] = 65
_KIND[48:58] = 48


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 poor, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed tokens of the texts: row, index below 2**BITS, weight."""
    data, offsets = flat.flat_bytes(column)
    starts, ends, first = flat.word_bounds(data, offsets)
    row = np.repeat(np.arange(len(column)), np.diff(first))
    share = 1 / np.maximum(np.diff(first), 1)[row]
    word = flat.span_hashes(data, starts, ends, lower=True)
    kinds = _KIND[data]
    head = flat.span_hashes(kinds, starts, np.minimum(ends, starts + 2))
    tail = flat.span_hashes(kinds, np.maximum(starts, ends - 3), ends)
    again = np.flatnonzero((word[1:] == word[:-1]) & (row[1:] == row[:-1])) + 1
    length = np.floor(2 * np.log2(1 + np.diff(first))).astype(np.uint64)
    families = [
        (row, word, share * SCALE[0]),
        (row, flat.mix(head + np.uint64(3) * tail), share * SCALE[1]),
        (row[again], np.full(len(again), 0x5EED, np.uint64), share[again] * SCALE[2]),
        (np.arange(len(column)), flat.mix(length + np.uint64(1 << 40)), np.full(len(column), SCALE[3])),
    ]
    rows, hashes, weights = (np.concatenate(x) for x in zip(*families, strict=True))
    return rows, (hashes >> np.uint64(64 - BITS)).astype(np.int64), weights


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, column: pa.Array) -> np.ndarray:
        """The chance of each grade from 1 on, or more, for each text."""
        row, index, weight = tokens(column)
        scores = np.bincount(row, self.weights[index] * weight, len(column))
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))


def fit(docs: DataFrame, grades: DataFrame, bound: int = SAMPLE) -> Model:
    """Learn from ``grades`` (doc_id, grade)."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in flat.runs(batches):
            row, index, weight = tokens(run.column("text"))
            both, at = np.unique(row << BITS | index, return_inverse=True)
            sums = np.bincount(at, weight, len(both)).astype(np.float32)
            cut = np.searchsorted(both >> BITS, np.arange(1, run.num_rows))
            kept = (both & ((1 << BITS) - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [run.column("key"), run.column("label"), pa.array(np.split(kept, cut)), pa.array(np.split(sums, cut))], ["key", "label", "index", "weight"]
            )

    rows = labelled(docs, grades, F.col("grade"), bound)
    table = rows.mapInArrow(measured, "key long, label int, index array<int>, weight array<float>").orderBy("key").toArrow()
    if not table.num_rows:
        return Model(np.zeros(1 << BITS), np.log(np.arange(1, GRADES) / (GRADES - np.arange(1, GRADES))))
    grade = table.column("label").to_numpy().clip(0, GRADES - 1)
    lists = table.column("index").combine_chunks()
    row = np.repeat(np.arange(len(grade)), np.diff(lists.offsets.to_numpy()))
    index, weight = lists.flatten().to_numpy(), table.column("weight").combine_chunks().flatten().to_numpy().astype(float)
    return _regress(row, index, weight, grade)


def _regress(row: np.ndarray, index: np.ndarray, weight: np.ndarray, grade: np.ndarray) -> Model:
    """Adam on the sum of the binary losses of all thresholds; these are kept in order."""
    n, size = len(grade), 1 << BITS
    passed = grade[:, None] >= np.arange(1, GRADES)
    rate = np.clip(passed.mean(0), 1 / (n + 2), 1 - 1 / (n + 2))
    state = np.concatenate([np.zeros(size), -np.log(rate / (1 - rate))])
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, STEPS + 1):
        scores = np.bincount(row, state[index] * weight, n)
        gap = 1 / (1 + np.exp(-np.clip(scores[:, None] - state[size:], -40, 40))) - passed
        slope = np.concatenate([np.bincount(index, gap.sum(1)[row] * weight, size) / n + RIDGE * state[:size], -gap.mean(0)])
        first += 0.1 * (slope - first)
        second += 0.001 * (slope**2 - second)
        state -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        state[size:] = np.maximum.accumulate(state[size:])
    return Model(state[:size], state[size:])


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, expected grade, the chances of grades 1 and 2 or more, selected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"tail_{k}" for k in range(1, GRADES)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in flat.runs(batches):
            tails = shared.value.tails(run.column("text"))
            yield pa.RecordBatch.from_arrays(
                [run.column("id"), pa.array(tails.sum(1)), *[pa.array(t) for t in tails.T.copy()], pa.array(tails[:, SELECT - 1] >= 0.5)], ["id", "expected", *names, "selected"]
            )

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = ", ".join(["id long", "expected double", *[f"{x} double" for x in names], "selected boolean"])
    return rows.mapInArrow(work, schema).withColumnRenamed("id", id_column)
