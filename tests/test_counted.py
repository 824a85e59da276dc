"""Counted rows against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest

from tidemark.functions.counted import (
    BLOCK_DAYS,
    block_medians,
    day_blocks,
    day_counts,
    expand_rows,
    gap_counts,
    gap_median,
    rank_counts,
)


@pytest.mark.parametrize("parts", [(1,), (4, 2), (6, 4), (100, 10)])
def test_expand_rows(spark, parts):
    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 0), ("d", 3)], "k string, n bigint")
    rows = expand_rows(df, "n", index="i", parts=parts).collect()
    expected = [(k, i) for k, n in (("a", 7), ("b", 1), ("d", 3)) for i in range(1, n + 1)]
    assert sorted((r.k, r.i) for r in rows) == sorted(expected)


def random_days(seed):
    rng = random.Random(seed)
    start = date(2000, 1, 1)
    return [
        (key, start + timedelta(days=rng.randint(0, rng.choice([0, 5, 300]))))
        for key in range(30)
        for _ in range(rng.randint(1, 12))
    ]


def gaps_by_key(rows):
    days = defaultdict(list)
    for key, day in rows:
        days[key].append(day)
    return {
        key: [(b - a).days for a, b in zip(sorted(values), sorted(values)[1:])]
        for key, values in days.items()
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_gaps_ranks_and_medians(spark, seed):
    rows = random_days(seed)
    gaps = gaps_by_key(rows)
    days = day_counts(spark.createDataFrame(rows, "k int, day date"), "k", "day")

    counted = gap_counts(days, "k", "day")
    expanded = Counter((r.k, r.interval_days) for r in expand_rows(counted, "n").collect())
    expected = Counter((k, g) for k, values in gaps.items() for g in [None, *values])
    assert expanded == expected

    counts = (
        counted.where("interval_days IS NOT NULL").groupBy("k", "interval_days").sum("n").toDF("k", "gap", "n")
    )
    for row in rank_counts(counts, "k", "gap").collect():
        assert row.cnt == len(gaps[row.k])
        assert row.before == sum(1 for g in gaps[row.k] if g < row.gap)

    medians = {r.k: r.median for r in gap_median(counted, "k", "median").collect()}
    assert medians == {k: sorted(g)[(len(g) + 1) // 2 - 1] for k, g in gaps.items() if g}


def far_days(seed):
    """Days around ends of words and blocks, before 1970 too, with repeats, and rows without a day."""
    rng = random.Random(seed)
    ends = [date(1970, 1, 1) + timedelta(days=d) for d in (-1025, -1024, -65, -64, -1, 0, 63, 64, 127, 1023, 1024, 2047, 2048, 11263, 11264)]
    rows = [(key, rng.choice([rng.choice(ends), date(1999, 1, 1) + timedelta(days=rng.randint(0, 3000)), None])) for key in range(40) for _ in range(rng.randint(1, 12))]
    return rows + [(100, None), (101, None), (101, None), (102, date(1969, 12, 31)), (103, date(2000, 1, 1)), (103, date(2000, 1, 1))]


@pytest.mark.parametrize("rows", [random_days(3), far_days(4), far_days(5)])
def test_medians_from_blocks_of_days(spark, rows):
    gaps = gaps_by_key([r for r in rows if r[1] is not None])
    df = spark.createDataFrame(rows, "k int, day date")
    blocks = day_blocks(df, "k", "day", "1", {"last": "max(day)"})
    assert blocks.count() <= len({(k, d and (d - date(1970, 1, 1)).days // BLOCK_DAYS) for k, d in rows})
    found = block_medians(blocks, "k", "median", {"last": "max(last)"}).collect()
    assert sorted(r.k for r in found) == sorted({k for k, _ in rows})
    for row in found:
        values, dated = sorted(gaps.get(row.k, [])), [d for k, d in rows if k == row.k and d]
        assert row.median == (values[(len(values) + 1) // 2 - 1] if values else None)
        assert row.last == (max(dated) if dated else None)


def test_rows_that_count_several_times(spark):
    df = spark.createDataFrame([(1, date(2000, 1, 1), 3), (1, date(2000, 1, 8), 1), (1, date(2000, 1, 9), 4)], "k int, day date, n long")
    (row,) = block_medians(day_blocks(df, "k", "day", "n", {}), "k", "median", {}).collect()
    assert row.median == 0  # 0 0 7 1 0 0 0
