"""Toxicity scores from gradient-boosted trees over dense text features.

Features of a text: density of words, and of word beginnings, from a lexicon;
lexicon words near a second-person word; capitals, punctuation, digits and
words with symbols or digits between letters. The lexicon itself is learned:
words and beginnings far more frequent in texts labelled toxic. Trees are
boosted on the logistic loss and their margins are calibrated by isotonic
regression on labelled rows that the trees have not seen.

Labels are learned from at most ``SAMPLE`` rows, the first in the order of a
hash of the id, equal texts counted once; rows held out by the caller's rule
are never read. Documents are scored where they are read: nothing is shuffled.

Defined cases: null and empty texts get the score of a text without words; with
no labelled row all scores are equal and near 0, with one class only near that class's rate;
rows with a null id are scored and never used for learning; where labels name a
document several times the highest label counts; repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.trees import Trees, fit_isotonic, fit_trees

#: Most labelled rows read for learning.
SAMPLE = 40_000
#: Most entries of the lexicon, its least support in distinct toxic texts, and its least log odds ratio.
LEXICON, SUPPORT, ODDS = 20_000, 4, 2.5
#: Lengths in bytes of the word beginnings that the lexicon holds besides whole words.
BEGINNINGS = (4, 6, 8)
#: Words between a lexicon word and a second-person word that count as near.
NEAR = 5
#: Of this many parts of the labelled rows one calibrates; the others fit the trees.
PARTS = 4

SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos tú usted ustedes vosotros ti"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_TABLE_BITS = 20


@dataclass(frozen=True)
class Lexicon:
    """Sorted hashes with their log odds, and a bit table that most other words fail."""

    hashes: np.ndarray
    odds: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, odds: np.ndarray) -> Lexicon:
        order = np.argsort(hashes)
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[hashes >> np.uint64(64 - _TABLE_BITS)] = True
        return cls(hashes[order], odds[order], table)

    def odds_of(self, values: np.ndarray) -> np.ndarray:
        """Log odds of each value, 0 where it is not in the lexicon."""
        out = np.zeros(len(values))
        some = np.flatnonzero(self.table[values >> np.uint64(64 - _TABLE_BITS)])
        if len(some) and len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, values[some]), len(self.hashes) - 1)
            out[some] = np.where(self.hashes[at] == values[some], self.odds[at], 0)
        return out


def _hash_words(words: list[str]) -> np.ndarray:
    data, offsets = flat.flat_bytes(pa.array(words, pa.string()))
    return flat.span_hashes(data, offsets[:-1], offsets[1:], lower=True)


_YOU = Lexicon.of(np.unique(_hash_words(SECOND_PERSON.split())), np.ones(len(set(SECOND_PERSON.split()))))


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Runs of letters: starts, ends, first of each row, hashes of the words and of their beginnings."""
    starts, ends, first = flat.runs_of(_LETTER, data, offsets)
    hashes = [flat.span_hashes(data, starts, ends, lower=True)]
    for size in BEGINNINGS:
        long = ends - starts > size
        cut = flat.span_hashes(data, starts, np.minimum(ends, starts + size), lower=True)
        hashes.append(np.where(long, cut ^ np.uint64(size), np.uint64(0)))
    return starts, ends, first, hashes


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """The dense features of each text."""
    data, offsets = flat.flat_bytes(column)
    starts, ends, first, hashes = _tokens(data, offsets)
    word = lexicon.odds_of(hashes[0])
    start = np.max([lexicon.odds_of(h) for h in hashes[1:]], axis=0)
    hit = (word > 0) | (start > 0)
    you = _YOU.odds_of(hashes[0])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    near = np.zeros(len(starts), bool)
    at = np.flatnonzero(hit)
    for step in range(1, NEAR + 1):
        for other in (at - step, at + step):
            inside = (other >= 0) & (other < len(starts))
            good = at[inside][(you[other[inside]] > 0) & (row[other[inside]] == row[at[inside]])]
            near[good] = True
    words, size = np.maximum(np.diff(first), 1), np.maximum(np.diff(offsets), 1)
    # A symbol or digit directly between two letters, but for hyphens and apostrophes.
    letter, odd = _LETTER[data], _DIGIT[data] | (_SYMBOL[data] & (data != 0x2D) & (data != 0x27))
    between = np.zeros(len(data), bool)
    between[1:-1] = odd[1:-1] & letter[:-2] & letter[2:]
    edges = np.concatenate([offsets[:-1], offsets[1:] - 1])
    between[edges[(edges >= 0) & (edges < len(data))]] = False
    upper = _UPPER[data]
    capitals = _sums(upper, offsets)
    letters = np.maximum(_sums(letter, offsets), 1)
    shout = np.concatenate([[0], np.cumsum(upper)])
    shouted = (shout[ends] - shout[starts] == ends - starts) & (ends - starts > 1)
    most = np.zeros(len(offsets) - 1)
    np.maximum.at(most, row[at], np.maximum(word, start)[at])
    return np.stack(
        [
            np.log1p(np.diff(first)),
            _sums(word > 0, first), _sums(word > 0, first) / words,
            _sums(start > 0, first), _sums(start > 0, first) / words,
            _sums(word + start, first) / words, most,
            _sums(you, first) / words, _sums(near, first), _sums(near, first) / words,
            capitals / letters, _sums(shouted, first) / words,
            _sums(data == 0x21, offsets) / words, _sums(_SYMBOL[data], offsets) / size,
            _sums(_DIGIT[data], offsets) / size, _sums(between, offsets) / words,
        ],
        axis=1,
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a label have each word or beginning; hash 0 counts the texts."""
    for run in flat.runs(batches):
        data, offsets = flat.flat_bytes(run.column("text"))
        _, _, first, hashes = _tokens(data, offsets)
        label = run.column("label").to_numpy().astype(bool)
        row = np.repeat(np.arange(run.num_rows), np.diff(first))
        found = [np.unique(np.stack([row.astype(np.uint64), h]), axis=1) for h in hashes]
        tokens = np.concatenate([f[1] for f in found])
        toxic = label[np.concatenate([f[0] for f in found]).astype(np.int64)]
        tokens, toxic = tokens[tokens != 0], toxic[tokens != 0]
        every, at = np.unique(np.append(tokens, np.uint64(0)), return_inverse=True)
        ones = np.bincount(at[:-1], toxic, len(every))
        zeros = np.bincount(at[:-1], ~toxic, len(every))
        ones[0], zeros[0] = label.sum(), (~label).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(every.view(np.int64)), pa.array(ones.astype(np.int64)), pa.array(zeros.astype(np.int64))], ["hash", "ones", "zeros"]
        )


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def scores(self, column: pa.Array) -> np.ndarray:
        margins = self.trees.margins(features(column, self.lexicon))
        # A hundredth of the plain logistic score keeps the order inside the flat parts.
        plain = 1 / (1 + np.exp(-np.clip(margins, -40, 40)))
        return np.clip(0.99 * np.interp(margins, *self.knots) + 0.01 * plain, 0, 1)


def labelled(docs: DataFrame, labels: DataFrame, label: Column, bound: int) -> DataFrame:
    """(part, text, label) of at most ``bound`` labelled documents, equal texts once.

    Only the bounded list of ids and labels is broadcast; documents stay where they are.
    """
    ids = (
        labels.select("doc_id", label.cast("int").alias("label")).dropna()
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return (
        rows.select(F.xxhash64("text").alias("key"), F.coalesce("text", F.lit("")).alias("text"), "label")
        .groupBy("key").agg(F.max_by("text", "label").alias("text"), F.max("label").alias("label"))
    )


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """Learn from ``labels`` (doc_id, toxic); leave out rows here that must not be learned from."""
    rows = labelled(docs, labels, F.col("toxic"), bound).persist()
    try:
        counts = rows.mapInArrow(_counted, "hash long, ones long, zeros long").groupBy("hash").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        total = counts.where("hash = 0").first()
        ones, zeros = (total["ones"], total["zeros"]) if total else (0, 0)
        odds = F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((F.col("zeros") + 0.5) / (zeros + 1))
        found = (
            counts.where(f"hash <> 0 and ones >= {SUPPORT}").withColumn("odds", odds).where(f"odds >= {ODDS}")
            .orderBy(F.desc("odds"), "hash").limit(LEXICON).toArrow()
        )
        lexicon = Lexicon.of(found.column("hash").to_numpy().view(np.uint64), found.column("odds").to_numpy())
        shared = docs.sparkSession.sparkContext.broadcast(lexicon)

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for run in flat.runs(batches):
                x = features(run.column("text"), shared.value)
                yield pa.RecordBatch.from_arrays([run.column("key"), run.column("label"), pa.array(list(x))], ["key", "label", "x"])

        table = rows.mapInArrow(measured, "key long, label int, x array<double>").toArrow()
    finally:
        rows.unpersist()
    if not table.num_rows:
        return Model(lexicon, _no_trees(), (np.array([0.0]), np.array([0.0])))
    order = np.argsort(table.column("key").to_numpy())
    x = np.stack(table.column("x").to_numpy(zero_copy_only=False))[order]
    y = table.column("label").to_numpy()[order].clip(0, 1).astype(float)
    if y.min() == y.max():
        return Model(lexicon, _no_trees(), (np.array([0.0]), y[:1]))
    part = np.arange(len(y)) % PARTS == 0
    if min(y[part].sum(), (1 - y[part]).sum(), y[~part].sum(), (1 - y[~part]).sum()) < 2:
        part = np.zeros(len(y), bool)
    trees = fit_trees(x[~part], y[~part])
    held = part if part.any() else ~part
    return Model(lexicon, trees, fit_isotonic(trees.margins(x[held]), y[held]))


def _no_trees() -> Trees:
    return Trees(0.0, np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 1)))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in flat.runs(batches):
            yield pa.RecordBatch.from_arrays([run.column("id"), pa.array(shared.value.scores(run.column("text")))], ["id", "score"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(work, "id long, score double").select(F.col("id").alias(id_column), "score")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, without those scored ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    text = f"c{names.index(text_column)}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in flat.runs(batches, text):
            yield run.filter(pa.array(shared.value.scores(run.column(text)) < threshold))

    return plain.mapInArrow(work, plain.schema).toDF(*names)
