"""Periodic runs by recompression, against row-by-row results."""

import hashlib
import random
import zlib
from fractions import Fraction

import brute
import numpy as np
import pytest

from tidemark.llm import periods, queries


def words_with_runs(draw):
    n, kinds = draw.choice([0, 1, 23, 24, 25, 40, 80, 200, 500]), draw.choice([1, 2, 3, 5, 50, 1000])
    words = [draw.randrange(kinds) for _ in range(n)]
    for _ in range(draw.choice([0, 1, 2, 3])):
        if n >= 10:
            a, p, size = draw.randrange(n), draw.randrange(1, n // 3 + 1), draw.randrange(1, n)
            for i in range(a, min(n, a + size)):
                words[i] = words[a + (i - a) % p]
    return words


def found(docs):
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    owner, runs = periods.find_runs(np.array([x for d in docs for x in d], np.int64), first)
    return [[tuple(r) for r in runs[owner == i].tolist()] for i in range(len(docs))]


@pytest.mark.parametrize("at_once", [1 << 19, 40])
def test_runs_row_by_row(monkeypatch, at_once):
    monkeypatch.setattr(periods, "AT_ONCE", at_once)
    draw = random.Random(at_once)
    for _ in range(60):
        docs = [words_with_runs(draw) for _ in range(draw.choice([1, 2, 7]))]
        assert found(docs) == [brute.runs(d) for d in docs]


def test_fibonacci_and_thue_morse_words():
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    morse = [i.bit_count() % 2 for i in range(600)]
    powers = ([0, 1, 2] * 9 + [0]) * 4 + [0] * 24 + [1] * 23 + [0, 1] * 12
    docs = [b, morse, powers, [0] * 23, [0] * 24, [5] * 700]
    assert found(docs) == [brute.runs(d) for d in docs]


def test_extensions_by_the_grammar():
    draw = random.Random(5)
    words = (np.array([draw.randrange(2) for _ in range(120)] * 3 + [1] * 90 + [0, 1] * 40) + 7).astype(np.int64)
    symbols = np.concatenate([[-1], words, [-2]])
    levels = periods.grammar(symbols, 2)
    assert len(levels) > 4 and len(levels[-1].symbols) < 40
    for low, high in zip(levels[:-1], levels[1:], strict=True):
        assert high.lengths.sum() == len(symbols) and (np.diff(low.first) > 0).all()
    pairs = [(draw.randrange(1, len(words) + 1), draw.randrange(1, len(words) + 1)) for _ in range(400)]
    a, b = np.array([p for p in pairs if p[0] != p[1]]).T
    for forward, step in ((True, 1), (False, -1)):
        want = []
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            n = 0
            while symbols[x] == symbols[y]:
                n, x, y = n + 1, x + step, y + step
            want.append(n)
        assert periods.agreement(levels, a, b, forward).tolist() == want


def row_of(text):
    w = brute.words(text)
    runs = brute.runs(w)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)))


def test_rows(spark, odd, nothing, clashing):
    docs = {(r.doc_id, r.text) for r in odd.collect()}
    for rows in (odd, clashing):
        got = periods.periodic_runs(rows).drop("runs").collect()
        assert len(got) == odd.count()
        assert {tuple(r) for r in got} == {(i, *row_of(t)) for i, t in docs}
    assert periods.periodic_runs(nothing).count() == 0
    named = spark.createDataFrame([("x", "a b c " * 20), (None, None)], "name string, body string")
    got = {r.name: r.runs for r in periods.periodic_runs(named, "name", "body").collect()}
    assert [tuple(r) for r in got["x"]] == [(0, 60, 3)] and got[None] == []


def test_ties_go_to_the_first_start():
    assert periods.strongest(np.array([[50, 40, 10], [0, 40, 10], [90, 24, 6], [100, 120, 30]])) == (0, 40, 10, 4000)
    assert periods.strongest(np.array([[5, 300001, 100000], [0, 300000, 100000]])) == (5, 300001, 100000, 3000)


def test_a_very_long_text(spark):
    """A million equal words, and a long text that repeats itself four times."""
    part = " ".join(f"w{k * 7919 % 100003}" for k in range(60_000))
    docs = [(1, "ha " * 1_000_000), (2, " ".join([part] * 4)), (3, part)]
    rows = periods.periodic_runs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in rows} == {1: [(0, 1_000_000, 1)], 2: [(0, 240_000, 60_000)], 3: []}


def test_the_query_plants_tails(spark):
    docs = [(i, " ".join(f"w{i}x{k % 97}" for k in range(200))) for i in range(60)] + [(60, None), (61, ""), (None, "a b"), (None, None)]
    rows = queries.with_periodic_tails(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for (i, text), r in zip(docs, rows, strict=True):
        w, h = brute.words(text), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert r.text.split() == [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        else:
            assert r.text == text
