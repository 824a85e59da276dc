"""Removal of repeated windows of words by super-k-mers, against row-by-row results."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import DOCS, text

from tidemark.llm import substring

COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def check(spark, docs, **options):
    rows = substring.repeated_windows_removed(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), **options)
    assert sorted(map(tuple, rows.select(COLUMNS).collect()), key=str) == sorted(brute.windows(docs), key=str)


def made(seed, n=40, vocabulary=400):
    """Texts with shared passages around the window, a common line, near copies, and few different words."""
    draw = random.Random(seed)
    passages = [[f"p{k}x{draw.randrange(vocabulary)}" for _ in range(draw.choice([20, 34, 35, 36, 60, 90]))] for k in range(8)]
    line = [f"line{k}" for k in range(12)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(draw.randrange(6)):
            words += draw.choice([line, draw.choice(passages), [f"w{draw.randrange(vocabulary)}" for _ in range(draw.randrange(50))], ["ha"] * draw.choice([3, 34, 35, 36, 90])])
        docs.append((i * 7, draw.choice([" ", "  ", "\n", "\t "]).join(words)))
    base = [f"n{k}" for k in range(150)]
    for i in range(20):
        words = list(base)
        for _ in range(i % 4):
            words[draw.randrange(150)] = f"changed{i}"
        docs.append((1000 + i, " ".join(words)))
    return docs + [(1, None), (2, ""), (3, " \n"), (4, text(5, 34)), (5, text(5, 35)), (6, text(5, 35)), (6, text(9)), (None, text(9)), (None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_texts_row_by_row(spark, seed):
    check(spark, made(seed))


def test_windows_of_a_large_bucket_counted_by_spark(spark, monkeypatch):
    check(spark, made(3), group=0)
    check(spark, made(3), group=3)


def test_odd_rows_extra_columns_and_no_rows(spark, odd, nothing, clashing):
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for rows in (odd, clashing):
        got = substring.repeated_windows_removed(rows).select(COLUMNS).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute.windows(docs), key=str)
    assert substring.repeated_windows_removed(nothing).count() == 0
    removed = {r.doc_id: r.removed for r in substring.repeated_windows_removed(odd).collect() if r.doc_id in (1, 3, 4)}
    assert (removed[1], removed[3], removed[4]) == ([0, 60], [0, 58], [])


def test_ids_of_any_type(spark):
    rows = spark.createDataFrame([("a", text(1)), ("b", text(1)), (None, text(2))], "name string, body string")
    got = substring.repeated_windows_removed(rows, "name", "body").collect()
    assert {(r.name, r.n_removed) for r in got} == {("a", 60), ("b", 60), (None, 0)}


def test_packed_words_come_back():
    rows = ["the cat sat on the mat", None, "", "größe the 日本語 x" * 2, "cat " * 300]
    words = substring.Words(pa.array(rows))
    data, offsets = substring.packed_words(words, pa.array([b"the", b"cat", "größe".encode()], pa.binary()))
    ids, first = substring.unpacked(data, offsets[words.first])
    assert np.diff(first).tolist() == [len(brute.words(r)) for r in rows]
    names, plain = {}, [w for r in rows for w in brute.words(r)]
    assert [names.setdefault(w, i) for w, i in zip(plain, ids.tolist(), strict=True)] == ids.tolist() and len(set(names.values())) == len(names)


def test_super_kmers_hold_every_window_once_and_equal_windows_meet():
    draw = random.Random(4)
    rows = [" ".join(str(draw.randrange(30)) for _ in range(n)) for n in (10, 34, 35, 36, 400)] + ["ha " * 200] * 2
    words = substring.Words(pa.array(rows))
    first, n, least = substring.super_kmers(words, np.zeros(1 << substring.SKETCH_BITS, np.uint8))
    windows = [(a + j, m) for a, k, m in zip(first.tolist(), n.tolist(), least.tolist(), strict=True) for j in range(k)]
    every = [b + i for b, r in zip(words.first.tolist(), rows, strict=False) for i in range(len(r.split()) - substring.WINDOW + 1)]
    assert [w for w, _ in windows] == every and n.max() <= substring.MOST
    plain = [w for r in rows for w in r.split()]
    met = {}
    assert all(met.setdefault(tuple(plain[w : w + substring.WINDOW]), m) == m for w, m in windows)


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring, "window_hashes", lambda ids: np.zeros(len(ids) - substring.WINDOW + 1, np.uint64))
    pack = lambda ws: b"".join(bytes([255]) + w.encode() + bytes([254]) for w in ws)
    one, two = [f"a{k}" for k in range(36)], [f"b{k}" for k in range(35)]
    masks = substring.repeated_windows([pack(one), pack(two), pack(one[1:])], [1, 1, 1])
    assert masks.tolist() == [2, 0, 1]


def test_a_common_line_does_not_gather_the_texts(spark):
    """The line stands in every text; no minimiser but those of whole common windows has more than a few strings."""
    line = " ".join(f"line{k}" for k in range(20))
    docs = spark.createDataFrame([(i, f"{text(i, 50)} {line} {text(i + 5000, 50)}") for i in range(300)], DOCS.split(", lang")[0])
    ranks = np.zeros(1 << substring.SKETCH_BITS, np.uint8)
    words = substring.Words(pa.array([r.text for r in docs.collect()]))
    counts = np.bincount((words.grams() >> np.uint64(64 - substring.SKETCH_BITS)).view(np.int64), minlength=len(ranks))
    ranks[:] = np.log2(np.maximum(counts, 1))
    _, _, least = substring.super_kmers(words, ranks)
    assert np.unique(least, return_counts=True)[1].max() <= 3
