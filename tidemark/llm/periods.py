"""Periodic runs of words: a stretch repeated at least LEAST_REPEATS times, found exactly.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least max(LEAST_WORDS, LEAST_REPEATS * q) words that no
neighbouring word extends keeping the period.

Method: recompression.

* **Grammar.** The words of a batch of texts become one sequence of symbols, texts
  kept apart by symbols that occur once. Block compression (a stretch of one
  symbol becomes a symbol of its own) and pair compression (a symbol of the left half of
  the alphabet and a following one of the right half become one) alternate until little
  is left: a run-length grammar, as levels that each refer to the one below.
* **Extensions.** How far two places agree, forwards or backwards, is answered
  by climbing the levels while both places begin a phrase and carry the same symbol,
  and descending where they differ; all questions of a batch go together, one level at a time.
* **Candidates.** A run with period p has 2p consecutive words (or, for short
  periods, LEAST_WORDS - p) that equal the word p later. So it has a place on the
  harmonic grid (multiples of p; for short periods of half that stretch) from which
  as many words agree as the grid is wide. Such places of all p together number
  n log n; the few whose first CHECKED words agree are extended by the grammar.

Equal stretches with several periods are one run with the smallest. No step
looks at more than one text's words at once, so texts are independent of each
other and of how Spark deals them.

Defined cases: null and empty texts have no words and no runs; each row has
its own result, also where texts or ids repeat; ids may be null and of any type; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.substring import Words

LEAST_WORDS, LEAST_REPEATS = 24, 3
#: Words compared at a grid place before it is extended, and candidates extended at once.
CHECKED, AT_ONCE = 8, 1 << 19
#: Rounds of compression; what is left then is compared symbol by symbol.
ROUNDS = 96
#: A run of so many periods rules out candidates inside it whose period is a multiple.
LONG = 8


@dataclass
class Level:
    """A sequence of symbols; ``first`` are the first children of the next level's symbols (with an end)."""

    symbols: np.ndarray
    lengths: np.ndarray
    parent: np.ndarray | None = None
    first: np.ndarray | None = None
    blocks: bool = False


def _named(left: np.ndarray, right: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """Numbers from ``fresh`` on for pairs, equal for equal ones, and the next free number."""
    pairs, names = np.unique(left * (max(fresh, int(right.max(initial=0)) + 1)) + right, return_inverse=True)
    return names + fresh, fresh + len(pairs)


def grammar(symbols: np.ndarray, apart: int) -> list[Level]:
    """Levels from the symbols up; negative symbols, ``apart`` in number, are never joined."""
    levels = [Level(symbols, np.ones(len(symbols), np.int64))]
    fresh = int(symbols.max(initial=0)) + 1
    for turn in range(ROUNDS):
        below = levels[-1]
        s, n = below.symbols, len(below.symbols)
        if n <= 2 * apart:
            break
        begins = np.ones(n, bool)
        if turn % 2 == 0:
            begins[1:] = (s[1:] != s[:-1]) | (s[1:] < 0)
        else:
            left = flat.mix(s.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1) == 0
            begins[1:] = ~((s[:-1] >= 0) & (s[1:] >= 0) & left[:-1] & ~left[1:])
        first = np.append(np.flatnonzero(begins), n)
        size = np.diff(first)
        joined = np.flatnonzero(size > 1)
        if not len(joined):
            continue
        above = s[first[:-1]].copy()
        head = first[:-1][joined]
        above[joined], fresh = _named(s[head], size[joined] if turn % 2 == 0 else s[head + 1], fresh)
        below.parent, below.first, below.blocks = np.cumsum(begins) - 1, first, turn % 2 == 0
        levels.append(Level(above, np.add.reduceat(below.lengths, first[:-1])))
    return levels


def agreement(levels: list[Level], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many words agree from places ``a`` and ``b`` on, forwards or backwards.

    The sequence ends on both sides with symbols that occur once.
    """
    a, b = a.astype(np.int64), b.astype(np.int64)
    total = np.zeros(len(a), np.int64)
    differ: list[list[np.ndarray]] = [[] for _ in levels]

    def advanced(level: Level, at: np.ndarray) -> None:
        steps = np.ones(len(at), np.int64)
        if level.blocks:
            pa_, pb = level.parent[a[at]], level.parent[b[at]]
            if forward:
                steps = np.minimum(level.first[pa_ + 1] - a[at], level.first[pb + 1] - b[at])
            else:
                steps = np.minimum(a[at] - level.first[pa_], b[at] - level.first[pb]) + 1
        total[at] += steps * level.lengths[a[at]]
        a[at] += steps if forward else -steps
        b[at] += steps if forward else -steps

    climbing = np.arange(len(a))
    for h, level in enumerate(levels):
        here, climbing = climbing, []
        while len(here):
            same = level.symbols[a[here]] == level.symbols[b[here]]
            differ[h].append(here[~same])
            here = here[same]
            if level.parent is not None:
                pa_, pb = level.parent[a[here]], level.parent[b[here]]
                edge = (level.first[pa_] == a[here]) & (level.first[pb] == b[here]) if forward else (level.first[pa_ + 1] - 1 == a[here]) & (level.first[pb + 1] - 1 == b[here])
                climbing.append(here[edge])
                here = here[~edge]
            advanced(level, here)
        climbing = np.concatenate(climbing) if climbing else np.zeros(0, np.int64)
        if len(climbing):
            a[climbing], b[climbing] = level.parent[a[climbing]], level.parent[b[climbing]]
    for h in range(len(levels) - 1, 0, -1):
        level = levels[h - 1]
        here = np.concatenate(differ[h]) if differ[h] else np.zeros(0, np.int64)
        if not len(here):
            continue
        a[here], b[here] = (level.first[a[here]], level.first[b[here]]) if forward else (level.first[a[here] + 1] - 1, level.first[b[here] + 1] - 1)
        while len(here):
            same = level.symbols[a[here]] == level.symbols[b[here]]
            differ[h - 1].append(here[~same])
            here = here[same]
            advanced(level, here)
    return total


def _grid(p: int) -> int:
    return max(1, max(LEAST_WORDS - p, (LEAST_REPEATS - 1) * p) // 2)


def _extended(symbols: np.ndarray, text: np.ndarray, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) around the candidates, by a grammar of their texts alone."""
    wanted = np.zeros(int(text.max()) + 2, bool)
    wanted[text[at]] = True
    keep = wanted[text]
    # The symbol before a text belongs to the text before it in ``symbols``: begin with one of its own.
    part = np.concatenate([[-len(symbols) - 1], symbols[keep]])
    moved = np.cumsum(keep)
    levels = grammar(part, int(wanted.sum()) + 1)
    a = moved[at]
    ahead = agreement(levels, a, a + period, True)
    behind = agreement(levels, a - 1, a + period - 1, False)
    runs = np.stack([at - behind, at + ahead + period, period], axis=1)
    size = runs[:, 1] - runs[:, 0]
    return runs[size >= np.maximum(LEAST_WORDS, LEAST_REPEATS * period)]


def _least_periods(runs: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, in order of start and end."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[new]


def find_runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of all texts of a batch: their texts, and (start, length, period) within them, by start and period.

    ``ids`` number the words, ``first`` has the first word of each text and the end.
    """
    count = np.diff(first)
    by_size = np.argsort(-count, kind="stable")
    size = count[by_size]
    ends = np.cumsum(size + 1)  # each text is followed by a symbol that occurs once
    begin = ends - size - 1
    symbols = np.empty(int(size.sum() + len(size)), np.int64)
    text = np.repeat(np.arange(len(size)), size + 1)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[~inside] = -1 - np.arange(len(size))
    words = np.repeat(first[:-1][by_size] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    symbols[inside] = ids[words]

    runs = np.zeros((0, 3), np.int64)
    waiting: list[tuple[np.ndarray, int]] = []
    held = 0

    def settle(runs: np.ndarray) -> np.ndarray:
        at = np.concatenate([w[0] for w in waiting])
        period = np.concatenate([np.full(len(w[0]), w[1]) for w in waiting])
        width = np.minimum(np.maximum(np.maximum(LEAST_WORDS - period, (LEAST_REPEATS - 1) * period) // 2, 1), CHECKED)
        sound = text[at] == text[at + period]
        at, period, width = at[sound], period[sound], width[sound]
        for j in range(1, CHECKED):
            # Places beyond a text's end hold a symbol that occurs once; beyond the last one nothing agrees.
            far = np.minimum(at + period + j, len(symbols) - 1)
            same = (j >= width) | (symbols[np.minimum(at + j, len(symbols) - 1)] == symbols[far]) & (at + period + j < len(symbols))
            at, period, width = at[same], period[same], width[same]
        if len(runs):
            long = runs[runs[:, 1] - runs[:, 0] >= LONG * runs[:, 2]]
            if len(long):
                near = np.maximum(np.searchsorted(long[:, 0], at, "right") - 1, 0)
                known = (long[near, 0] <= at) & (at + period < long[near, 1]) & (period % long[near, 2] == 0)
                at, period = at[~known], period[~known]
        if not len(at):
            return runs
        return _least_periods(np.concatenate([runs, _extended(symbols, text, at, period)]))

    longest = int(size[0]) // LEAST_REPEATS if len(size) and size[0] >= LEAST_WORDS else 0
    # Texts that can hold a run with period p are the first ones; their symbols end here.
    reach = np.searchsorted(-size, -LEAST_REPEATS * np.arange(1, longest + 1), "right")
    for p in range(1, longest + 1):
        stop, step = int(ends[reach[p - 1] - 1]), _grid(p)
        hit = np.flatnonzero(symbols[: stop - p : step] == symbols[p:stop:step])
        if len(hit):
            waiting.append((hit * step, p))
            held += len(hit)
            if held >= AT_ONCE:
                runs, waiting, held = settle(runs), [], 0
    if waiting:
        runs = settle(runs)
    owner = text[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    out = np.stack([runs[:, 0] - begin[owner], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    owner = by_size[owner]
    order = np.lexsort((out[:, 2], out[:, 0], owner))
    return owner[order], out[order]


def strongest(runs: np.ndarray) -> tuple[int, int, int, int]:
    """(start, length, period, floor of 1000 * length / period) of the run with the greatest length / period."""
    ratio = runs[:, 1] / runs[:, 2]
    close = runs[ratio >= ratio.max() * (1 - 1e-9)].tolist()
    start, length, period = min(close, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return start, length, period, 1000 * length // period


_SCHEMA = """id long, n_runs long, start long, length long, period long, exponent_milli long,
    runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>"""
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def _described(id_type: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for run in flat.runs(batches):
            words = Words(run.column("text"))
            ids = words.binary().dictionary_encode().indices.to_numpy().astype(np.int64)
            owner, found = find_runs(ids, words.first)
            bounds = np.searchsorted(owner, np.arange(run.num_rows + 1))
            rows = []
            for i, text in enumerate(run.column("text").to_pylist()):
                kept, mine = text.encode().split(), found[bounds[i] : bounds[i + 1]]
                if len(mine):
                    change = np.zeros(len(kept) + 1, np.int64)
                    np.add.at(change, mine[:, 0] + mine[:, 2], 1)
                    np.add.at(change, mine[:, 0] + mine[:, 1], -1)
                    kept = [w for w, c in zip(kept, np.cumsum(change).tolist(), strict=False) if not c]
                    listed = "".join(f"{s},{n},{p}\n" for s, n, p in mine.tolist())
                    best = (*strongest(mine), hashlib.sha256(listed.encode()).hexdigest())
                else:
                    best = (None, None, None, None, empty)
                runs = [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()]
                rows.append((len(mine), *best, hashlib.sha256(b" ".join(kept)).hexdigest(), runs))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(_RUN)]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"]
            yield pa.RecordBatch.from_arrays([run.column("id"), *columns], ["id", *names])

    return work


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_runs, the run with the greatest length / period
    (start, length, period, exponent_milli; null without runs), runs_sha256, collapsed_sha256, runs.

    Ties between runs go to the smallest start, then period. ``collapsed_sha256``
    is of the words joined by one space, without those that a run repeats.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = plain.mapInArrow(_described(id_type), _SCHEMA.replace("id long", f"id {id_type}", 1))
    return rows.withColumnRenamed("id", id_column)
