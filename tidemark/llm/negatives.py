"""Hard negatives by Fagin's threshold algorithm.

For each anchor and each of its first positives (rows of its label with the
greatest inner products): the first rows of other labels whose score lies in a
window below the positive's.

Method. Every task holds blocks of rows with, per dimension, a list of the
rows in order of that component. For an anchor each list is read from the end
that its component's sign makes the better one (sorted access), DEPTH entries
further each time; rows not met before are scored as whole integer inner products (random
access). The threshold, the sum of anchor component times the component last
read, bounds the score of all rows not met. The search stops once it falls strictly below
the score of the last row each window still needs (strictly, since equal scores go by id),
or below what the window takes at all. The search over positives is the
same with one window without bounds. What a task knows already bounds its next
blocks.

Anchors go in blocks of about ANCHORS, each broadcast by itself and given up
when its rows are written, so neither the driver nor a task holds more, however many there are.
Before the rows of a block of anchors are searched, a hashed part of all rows (1 / PART)
gives each window a score that its last row can't lie below; tasks return only
rows from there on. Tasks return at most as many rows per window as it takes; Spark ranks them.

Defined cases: rows without id, label or vector, or with a component that is null or not finite,
take no part; several rows of one id are one, the least by label and vector;
components are floor(scale * x), cut to +-LARGEST; of vectors of
different lengths the shorter one counts as 0 beyond its end; windows of a positive score
below 1 are empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import written

POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's.
WINDOW = (30, 90)
SCALE, LARGEST = 256, 1 << 26
#: Anchors of a block, rows of a task's block, and about the rows of a task.
ANCHORS, ROWS, TASK_ROWS = 8192, 8192, 8192
#: Most tasks of a search; beyond TASK_ROWS * TASKS rows the tasks grow.
TASKS = 4096
#: Entries read of each list at first; doubled each time.
DEPTH = 32
PART = 16

_NONE = np.iinfo(np.int64).min
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame, id_column: str, label_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """(id, label, vector) of the rows that take part, components as whole numbers."""

    def whole(x: Column) -> Column:
        return F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LARGEST).cast("long")), F.lit(-LARGEST).cast("long"))

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    vector = F.col(vector_column)
    plain = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"), vector.alias("vector"))
    plain = plain.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    return plain.where(~F.exists("vector", bad)).select("id", "label", F.transform("vector", whole).alias("vector"))


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows, with 0 beyond their ends."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
    return out


class Lists:
    """A block of rows with its sorted lists, one per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)

    def search(self, anchor: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and rows from which the first ``k`` of each window low..high among the ``wanted`` rows can be taken, and how many rows were scored.

        Rows are returned by score from the greatest on; those below every window's k-th may be missing.
        """
        n = len(self.ids)
        used = np.flatnonzero(anchor[: self.vectors.shape[1]])
        weight = anchor[used]
        up = weight < 0
        lists = self.order[used]
        met = np.zeros(n, bool)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        scores, depth, step = np.zeros(0, np.int64), 0, DEPTH
        while True:
            end = min(n, depth + step)
            new = np.zeros(n, bool)
            new[lists[up, depth:end].reshape(-1)] = True
            new[lists[~up, n - end : n - depth].reshape(-1)] = True
            if not len(used):
                new[depth:end] = True
            new &= ~met
            met |= new
            at = np.flatnonzero(new & wanted)
            score = self.vectors[at][:, : len(anchor)] @ anchor[: self.vectors.shape[1]]
            keep = (score >= low.min()) & (score <= high.max())
            found.append((score[keep], at[keep]))
            scores = np.sort(np.concatenate([scores, score[keep]]))
            if end == n:
                break
            last = np.where(up, lists[:, end - 1], lists[:, n - end])
            threshold = int((weight * self.vectors[last, used]).sum()) if len(used) else 0
            place = np.searchsorted(scores, high, "right") - k
            kth = np.maximum(np.where(place >= 0, scores[np.maximum(place, 0)] if len(scores) else _NONE, _NONE), low)
            if threshold < kth.min():
                break
            depth, step = end, 2 * step
        score, at = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((self.ids[at], -score))
        return score[order], at[order], int(met.sum())


class Anchors:
    """A block of anchors, and for each the slots ``first[i]:first[i + 1]`` of scores that it looks for."""

    def __init__(self, ids: np.ndarray, labels: list[str], vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        n = len(ids)
        self.first = np.arange(n + 1)
        self.low, self.high = np.full(n, _NONE + 1), np.full(n, -(_NONE + 1))

    def with_windows(self, first: np.ndarray, low: np.ndarray, high: np.ndarray) -> Anchors:
        other = Anchors(self.ids, self.labels, self.vectors)
        other.first, other.low, other.high = first, low, high
        return other


def _searched(shared, k: int, same: bool):
    """(slot, id, score): each slot's first ``k`` rows of a task, of the anchor's label or of others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        number = {name: i for i, name in enumerate(dict.fromkeys(anchors.labels))}
        mine = np.array([number[name] for name in anchors.labels], np.int64)
        low, high, first = anchors.low, anchors.high, anchors.first
        scores, ids = np.full((len(low), k), _NONE), np.zeros((len(low), k), np.int64)
        open_ = [i for i in range(len(mine)) if first[i] < first[i + 1] and (low[first[i] : first[i + 1]] <= high[first[i] : first[i + 1]]).any()]

        def take(block: list[pa.RecordBatch]) -> None:
            labels = np.array([number.get(x, -1) for b in block for x in b.column("label").to_pylist()], np.int64)
            parts = [matrix(b.column("vector"), anchors.vectors.shape[1]) for b in block]
            width = max(p.shape[1] for p in parts)
            rows = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])
            lists = Lists(np.concatenate([b.column("id").to_numpy() for b in block]), labels, rows)
            for i in open_:
                a, b = first[i], first[i + 1]
                wanted = (lists.labels == mine[i]) & (lists.ids != anchors.ids[i]) if same else lists.labels != mine[i]
                least = np.maximum(low[a:b], scores[a:b, k - 1])
                score, at, _ = lists.search(anchors.vectors[i], wanted, least, high[a:b], k)
                begin = len(score) - np.searchsorted(score[::-1], high[a:b], "right")
                stop = np.minimum(len(score) - np.searchsorted(score[::-1], least, "left"), begin + k)
                for slot, x, y in zip(range(a, b), begin.tolist(), stop.tolist(), strict=True):
                    if x < y:
                        s, w = np.concatenate([scores[slot], score[x:y]]), np.concatenate([ids[slot], lists.ids[at[x:y]]])
                        best = np.lexsort((w, -np.maximum(s, _NONE + 1)))[:k]
                        scores[slot], ids[slot] = s[best], w[best]

        waiting, held = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                waiting.append(batch.slice(at, ROWS))
                held += waiting[-1].num_rows
                if held >= ROWS:
                    take(waiting)
                    waiting, held = [], 0
        if held:
            take(waiting)
        slot, place = np.nonzero(scores != _NONE)
        for at in range(0, len(slot), 100_000):
            s, p = slot[at : at + 100_000], place[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(ids[s, p]), pa.array(scores[s, p])], ["slot", "id", "score"])

    return work


def _first(rows: DataFrame, anchors: Anchors, k: int, same: bool) -> DataFrame:
    """(slot, id, score, rank) of each slot's first ``k`` rows, written."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)
    found = rows.mapInArrow(_searched(shared, k, same), "slot long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "id"))
    found = written(found.withColumn("rank", rank).where(F.col("rank") <= k))
    shared.destroy()
    return found


def _of_block(rows: DataFrame, anchors: Anchors, positives: int, negatives: int, window: tuple[int, int]) -> DataFrame:
    """The result for one block of anchors."""
    spark = rows.sparkSession
    pairs = _first(rows, anchors, positives, True).toPandas().sort_values(["slot", "rank"])
    slot, score = pairs["slot"].to_numpy(np.int64), pairs["score"].to_numpy(np.int64)
    low, high = -(-window[0] * score // 100), window[1] * score // 100
    low, high = np.where(low <= high, low, -(_NONE + 1)), np.where(low <= high, high, _NONE)
    wanted = anchors.with_windows(np.searchsorted(slot, np.arange(len(anchors.ids) + 1)), low, high)
    part = rows.where(F.pmod(F.xxhash64("id"), F.lit(PART)) == 0)
    sure = _first(part, wanted, negatives, False).where(F.col("rank") == negatives).toPandas()
    wanted.low[sure["slot"].to_numpy(np.int64)] = sure["score"].to_numpy(np.int64)
    found = _first(rows, wanted, negatives, False)
    pairs = pairs.assign(anchor_id=anchors.ids[slot], place=np.arange(len(slot)))[["place", "anchor_id", "id", "score"]]
    known = spark.createDataFrame(list(pairs.itertuples(index=False, name=None)), "slot long, anchor_id long, positive_id long, positive_score long")
    return found.join(known, "slot").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def hard_negatives(
    rows: DataFrame,
    anchor: str,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    anchors_at_once: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor``: SQL condition on ``id`` of the rows to search for. ``window``: lowest and
    highest score of a negative, in hundredths of the positive's.
    """
    spark = rows.sparkSession
    plain = usable(rows, id_column, label_column, vector_column)
    tasks = max(1, min(TASKS, -(-plain.count() // TASK_ROWS)))
    one = plain.repartition(tasks, "id").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    stored = written(one.select("id", "row.label", "row.vector"))
    chosen = stored.where(anchor)
    blocks = -(-chosen.count() // anchors_at_once)
    results = []
    for b in range(blocks):
        block = chosen.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)) == b).orderBy("id").toArrow()
        if block.num_rows:
            block = block.combine_chunks()
            anchors = Anchors(block["id"].to_numpy(), block["label"].to_pylist(), matrix(block["vector"].combine_chunks()))
            results.append(written(_of_block(stored, anchors, positives, negatives, window)))
    out = results[0] if results else spark.createDataFrame([], RESULT)
    for part in results[1:]:
        out = out.unionByName(part)
    return out
