"""Hard negatives by the threshold algorithm, against row-by-row results."""

import random

import brute
import numpy as np
import pytest

from tidemark.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def made(seed, n=400, width=6, labels=4):
    """Clusters with many ties and equal vectors."""
    draw = random.Random(seed)
    centres = [[draw.uniform(-1, 1) for _ in range(width)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = draw.randrange(labels)
        vector = [round(c + draw.choice([0, 0, 0.25, -0.5, draw.uniform(-1, 1)]), 2) for c in centres[draw.randrange(labels)]]
        rows.append((i, label, vector if draw.random() < 0.8 else centres[0]))
    nan, inf = float("nan"), float("inf")
    return rows + [
        (1000, None, [1.0] * width), (1001, 1, None), (1002, 1, [nan] + [1.0] * (width - 1)), (1003, 2, [inf] * width), (1004, 1, [None] * width),
        (1010, 1, [1.0, 2.0]), (1020, 2, []), (1030, 3, [0.0] * width), (1040, 1, [1e30] + [0.5] * (width - 1)), (1050, 0, [-1e30, 0.1]),
        (None, 1, [1.0] * width), rows[10], rows[10], (20, 3, [0.5] * width),
    ]


def floats(rows):
    return [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = negatives.hard_negatives(df, "id % 10 = 0", **options)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute.hard_negatives(floats(rows), lambda i: i % 10 == 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_row_by_row(spark, seed):
    check(spark, made(seed))


def test_blocks_of_rows_and_anchors_and_small_steps(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TASK_ROWS", 100)
    check(spark, made(3), anchors_at_once=7)


def test_no_rows_no_anchors_one_row_and_extra_columns(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA), "id = 0").collect() == []
    some = spark.createDataFrame(made(4), SCHEMA)
    assert negatives.hard_negatives(some, "id < 0").collect() == []
    assert negatives.hard_negatives(spark.createDataFrame([(0, 1, [1.0])], SCHEMA), "id = 0").collect() == []
    from pyspark.sql import functions as F

    clashing = some.select("*", *[F.lit("x").alias(c) for c in ("id", "vector", "slot", "score", "rank", "anchor_id", "row")])
    assert sorted(negatives.hard_negatives(clashing, "id % 10 = 0").collect()) == sorted(negatives.hard_negatives(some, "id % 10 = 0").collect())


def lists_of(seed, n=3000, width=8):
    draw = np.random.default_rng(seed)
    return negatives.Lists(np.arange(n), draw.integers(0, 3, n), draw.integers(-200, 200, (n, width)))


def test_the_search_ends_before_all_rows_are_scored():
    lists = lists_of(1)
    anchor = np.array([250, -3, 2, -1, 0, 0, 1, 0])
    everything = np.ones(3000, bool)
    whole = np.sort(lists.vectors @ anchor)[::-1]
    score, at, met = lists.search(anchor, everything, np.array([negatives._NONE + 1]), np.array([1 << 60]), 10)
    assert met < 2000 and score[:10].tolist() == whole[:10].tolist()
    assert (lists.vectors[at[:10]] @ anchor).tolist() == whole[:10].tolist()
    # Nothing is needed where the window's rows are known to lie above the threshold's reach.
    _, _, least = lists.search(anchor, everything, np.array([whole[5]]), np.array([1 << 60]), 10)
    assert least <= met


def test_windows_below_other_windows_are_whole():
    lists = lists_of(2)
    anchor = np.array([90, -80, 70, 60, -50, 40, 30, 20])
    wanted = lists.labels != 1
    scores = np.sort((lists.vectors @ anchor)[wanted])[::-1]
    low, high = np.array([scores[400], scores[900]]), np.array([scores[100], scores[700]])
    score, at, _ = lists.search(anchor, wanted, low, high, 10)
    for a, b in zip(low, high, strict=True):
        assert score[(score <= b) & (score >= a)][:10].tolist() == scores[(scores <= b) & (scores >= a)][:10].tolist()
    assert all(wanted[at])


def test_other_labels_and_no_positives(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 2, [1.0, 0.0]), (2, 2, [0.5, 0.0])]
    assert negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), "id = 0").collect() == []
    rows += [(3, 1, [1.0, 1.0])]
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), "id = 0").collect()
    assert [tuple(r) for r in got] == [(0, 3, 1, 2, 65536, 32768)]
