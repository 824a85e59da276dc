"""Flat tokens, similarity join and repeats against row-by-row results."""

import random
import re
import tempfile
import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import DOCS
from pyspark.sql import functions as F

from tidemark.llm import flat, graph, ngram_join, repeats, tables
from tidemark.llm.graph import components


def by_id(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=str)


def test_flat_words_are_the_rows_words():
    rows = ["a b c", None, "", "  x\ty\n", "A b", "ä ö b"]
    hashes, first = flat.words(pa.array(rows))
    assert np.diff(first).tolist() == [len(brute.words(r)) for r in rows]
    assert hashes[1] == hashes[6] and hashes[0] != hashes[5]
    lower, _ = flat.words(pa.array(rows), lower=True)
    assert lower[0] == lower[5]


def test_runs_keep_all_rows_and_never_cut_a_text():
    rows = ["a" * n for n in (10, flat.RUN_BYTES * 2, 0, 5)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], ["text"])
    assert [t for run in flat.runs([batch]) for t in run.column(0).to_pylist()] == rows


def test_shingles_do_not_cross_rows_and_short_texts_are_one():
    sets = flat.shingle_sets(pa.array(["a b c d e", "a b c d", "a b", "", None, "b c d e"]), 4)
    assert [len(s) for s in sets] == [2, 1, 1, 0, 0, 1]
    assert sets[1][0] in sets[0] and sets[5][0] in sets[0] and sets[2][0] not in sets[0]


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (500, 400)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 400: 400, 500: 400}


@pytest.mark.parametrize("few", [0, 1 << 40])
def test_components_in_rounds_and_in_one_task(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    draw = random.Random(few)
    edges = [(draw.randrange(-400, 400), draw.randrange(-400, 400)) for _ in range(300)] + [(1000 + k * 7 % 50, 1000 + (k * 7 + 7) % 50) for k in range(49)] + [(3, 3), (None, 5), (5, None)]
    root = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in root:
        for a, b in edges:
            if None not in (a, b) and a != b:
                root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    assert len(found) == len(root) and dict(map(tuple, found)) == root
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def check_similar(spark, docs, **options):
    rows = ngram_join.similar_documents(spark.createDataFrame(docs, "doc_id long, text string"), **options).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute.similar(docs)
    assert len(rows) == len(docs)


def near_copies(seed, groups=12, copies=14, size=80):
    """Groups of copies with a few changed words, around the bound."""
    draw, docs = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{draw.randrange(60)}" for _ in range(size)]
        for _ in range(copies):
            words = list(base)
            for _ in range(draw.choice([0, 1, 1, 2, 3, 4])):
                words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
            docs.append((len(docs) * 3 + 1, " ".join(words)))
    docs += [(10_000 + k, t) for k, t in enumerate([None, "", " ", "a b", "A b", "a b c", "a b", "common line here now"])]
    return docs


def test_similar_documents_row_by_row(spark):
    check_similar(spark, near_copies(1))


def test_similar_documents_with_all_groups_compared_blockwise(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "MOST_PAIRS", 0)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 3000)
    check_similar(spark, near_copies(2, groups=6))


def test_blocks_of_short_texts_hold_few_classes_and_only_sizes_that_can_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 50)
    sizes = [5 + k % 60 for k in range(600)]
    groups = spark.createDataFrame([(7, k, n) for k, n in enumerate(sizes)], "token long, cls long, n int")
    texts = spark.createDataFrame([(k, f"text {k}") for k in range(600)], "cls long, text string")
    met = {}
    for r in ngram_join._dealt(groups, texts, (85, 100)).collect():
        met.setdefault((r["low"], r["high"]), set()).add(r["cls"])
    assert max(len(m) for m in met.values()) <= 200
    together = {(a, b) for m in met.values() for a in m for b in m}
    assert all((a, b) in together for a in range(600) for b in range(600) if 100 * min(sizes[a], sizes[b]) >= 85 * max(sizes[a], sizes[b]))
    assert (0, 59) not in together and sum(len(m) for m in met.values()) < 600 * 12


def test_similar_documents_in_blocks_of_few_classes(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "MOST_PAIRS", 0)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    monkeypatch.setattr(ngram_join, "STRIP", 3)
    check_similar(spark, near_copies(3, groups=6))


def test_similar_documents_with_all_shingles_and_classes_split(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 1)
    monkeypatch.setattr(tables, "HOT", 10**6)
    check_similar(spark, near_copies(4))


def test_leaders_of_frequent_shingles_are_those_of_all_rows(spark):
    draw = random.Random(5)
    rows = sorted({(draw.randrange(40), draw.randrange(300)) for _ in range(2000)} | {(99, 1), (98, 2), (98, 2)})
    rows = [(t, c, 10 + c, 1, 1, t % 2 == 0) for t, c in rows]
    led = ngram_join._led(spark.createDataFrame(rows * 2, "token long, cls long, n int, level byte, matches byte, frequent boolean").repartition(7)).collect()
    classes = {}
    for t, c, *_ in rows:
        classes.setdefault(t, set()).add(c)
    expected = {(t, c, min(of), 10 + min(of)) for t, of in classes.items() if len(of) > 1 for c in of}
    assert len(led) == len(expected) and {(r["token"], r["cls"], r["leader"], r["leader_n"]) for r in led} == expected


def test_sketches_leave_all_pairs_that_link():
    draw, dropped = np.random.default_rng(8), 0
    for n in (1, 2, 3, 17, 63, 64, 65, 130, 900, 5000):
        for changed in (0, 0.02, 0.06, 0.08, 0.1, 0.5, 0.9):
            x = np.unique(draw.integers(0, 1 << 63, n, np.uint64))
            y = np.unique(np.concatenate([x[draw.random(n) >= changed], draw.integers(0, 1 << 63, int(n * changed), np.uint64)]))
            if not len(y):
                continue
            both = len(np.intersect1d(x, y))
            for link in ((85, 100), (80, 100), (1, 2)):
                links = link[1] * both >= link[0] * (len(x) + len(y) - both)
                assert links == (len(x) + len(y) - 2 * both <= ngram_join.most_apart(len(x) + len(y), link))
                pair = {"a": [1], "b": [2], "n_a": [len(x)], "n_b": [len(y)], "sketch_a": [ngram_join.sketch(x)], "sketch_b": [ngram_join.sketch(y)]}
                left = next(ngram_join._alike(link)(iter([pa.RecordBatch.from_pydict(pair)]))).num_rows
                assert left or not links
                # In blocks, where they only count between components.
                rows = {"cls": [1, 2], "shingles": [len(x), len(y)], "sketch": [ngram_join.sketch(x), ngram_join.sketch(y)]}
                assert ngram_join._close(link)(pa.table(rows | {"comp": [1, 2]}))["cls"].to_pylist() == [1, 2] * left
                assert not ngram_join._close(link)(pa.table(rows | {"comp": [1, 1]})).num_rows
                dropped += not left
    assert dropped > 40


def test_only_near_pairs_are_verified_and_little_is_left_on_disk(spark, monkeypatch, tmp_path):
    common = "every text here begins with one and the same common line".split()
    docs = [(k, " ".join([*common, *(f"d{k % 150}w{j}" for j in range(40)), *["other"] * (k >= 150)])) for k in range(170)]
    asked, links = [], ngram_join._links
    monkeypatch.setattr(ngram_join, "_links", lambda pairs, *rest: asked.append(pairs.count()) or links(pairs, *rest))
    monkeypatch.setattr(tables, "folder", lambda _: tempfile.mkdtemp(dir=tmp_path) + "/table")
    shuffled = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().endswith(".data") and f.length() > 1000}
    before = shuffled()
    rows = ngram_join.similar_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert not left
    assert len(list(tmp_path.glob("*/table"))) == 3
    assert {r["doc_id"]: r["component_id"] for r in rows.collect()} == {k: k % 150 for k in range(170)}
    # A pair of copies each, not the pairs that the common line makes.
    assert 20 <= sum(asked) <= 60


def test_rows_of_a_hot_key_are_dealt_to_many_tasks(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("key"), F.col("id").alias("at")).repartition(8)
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = tables.hot_keys(counts, ["key"])
    assert [r["key"] for r in hot.collect()] == [7]
    for how, few in (("inner", counts.where("key % 3 = 1")), ("left", counts.where("key % 3 = 0"))):
        joined = tables.spread_join(rows, few, ["key"], ["at"], hot, how)
        assert sorted(map(tuple, joined.select("at", "n").collect())) == sorted(map(tuple, rows.join(few, "key", how).select("at", "n").collect()))
    # As with tables too large to broadcast.
    for name, value in (large := {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}).items():
        spark.conf.set(name, value)
    try:
        parts = tables.spread_join(rows, counts, ["key"], ["at"], hot).where("key = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name in large:
            spark.conf.unset(name)
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 5000


def test_similar_documents_on_odd_rows(odd, nothing, clashing):
    rows = ngram_join.similar_documents(odd).collect()
    assert len(rows) == odd.count()
    component = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert [component[k] for k in (1, 2, 3, 15)] == [1, 1, 1, 1]
    assert [component[k] for k in (5, 6, 7, 8, 9, 10, 11)] == [5, 6, 7, 8, 8, 10, 11]
    assert {r["n_shingles"] for r in rows if r["doc_id"] in (5, 6, 7)} == {0}
    assert ngram_join.similar_documents(nothing).collect() == []
    assert by_id(ngram_join.similar_documents(clashing).collect(), "doc_id", "component_id") == by_id(rows, "doc_id", "component_id")


def test_one_of_each_keeps_the_smallest_id_and_all_columns(clashing, nothing):
    kept = ngram_join.one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(map(str, [1, 4, 5, 6, 7, 8, 10, 11, None, None, 12, 13, 14]))
    assert ngram_join.one_of_each(nothing).collect() == []


def test_one_of_each_deals_rows_once(spark):
    rows = [(7, "one two three four five"), (7, "one two three four five"), (None, "a b c d e"), (None, "a b c d e"), (0, "a b c d e"), (None, "v w x y z"), (3, "")]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(kept.collect(), "doc_id", "text") == sorted([(7, rows[0][1]), (0, rows[2][1]), (None, rows[5][1]), (3, "")], key=str)
    for name, value in (large := {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}).items():
        spark.conf.set(name, value)
    try:
        plan = kept.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in large:
            spark.conf.unset(name)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and re.search(r"\bc0#", x)]
    keyed = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and re.search(r"\bkey#", x)]
    assert not dealt and len(keyed) == 2, plan  # the documents, and the rows that stay


def test_prefixes_of_similar_sets_share_enough():
    draw = np.random.default_rng(3)
    counts = draw.integers(1, 50, 1 << ngram_join.SKETCH_BITS).astype(np.int32)
    for _ in range(200):
        n = int(draw.integers(3, 200))
        x = np.unique(draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[draw.random(len(x)) > 0.06], draw.integers(0, 1 << 63, 4, np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        (a, level_a, most_a), (b, level_b, most_b) = (ngram_join.prefix(s, counts, (85, 100)) for s in (x, y))
        need = min(most_a, most_b)
        assert len(np.intersect1d(a[level_a <= need], b[level_b <= need])) >= need


def repeating(seed):
    draw = random.Random(seed)
    piece = lambda n: "".join(draw.choice("abcdefgh äß") for _ in range(n))
    passages = [piece(n) for n in (150, 199, 200, 205, 260, 500, 900)]
    docs = []
    for k in range(60):
        docs.append((k, "".join(piece(draw.randrange(0, 300)) + draw.choice(passages) for _ in range(draw.randrange(0, 4)))))
    docs += [(100, docs[5][1]), (101, docs[5][1]), (102, None), (103, ""), (104, "ab" * 400), (105, "x" * 199), (106, "x" * 200), (107, "x" * 201)]
    return docs


def check_repeats(spark, docs, **options):
    rows = repeats.repeated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), **options).collect()
    expected = brute.repeats(docs)
    assert {r["doc_id"]: tuple(r)[1:5] for r in rows} == expected and len(rows) == len(docs)
    for r in rows:
        assert sum(r["removed"][1::2]) - sum(r["removed"][::2]) == r["n_removed"] and len(r["removed"]) == 2 * r["n_spans"]


def test_repeats_row_by_row(spark):
    check_repeats(spark, repeating(1))


def test_repeats_with_all_groups_counted_by_spark(spark):
    check_repeats(spark, repeating(2), group=1)


def test_repeats_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 3)
    check_repeats(spark, repeating(3))


def test_repeats_with_all_keys_split(spark, monkeypatch):
    monkeypatch.setattr(tables, "HOT", 10**6)
    check_repeats(spark, repeating(4))


def test_repeats_on_odd_rows(odd, nothing, clashing):
    rows = repeats.repeated(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["n_removed"] == r["n_bytes"] for r in rows if r["doc_id"] in (1, 2, 11))
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (5, 6, 8))
    assert repeats.repeated(nothing).collect() == []
    assert by_id(repeats.repeated(clashing).collect(), "doc_id", "kept_sha256") == by_id(rows, "doc_id", "kept_sha256")


@pytest.mark.parametrize("seed", range(5))
def test_every_window_has_an_anchor(seed):
    draw = np.random.default_rng(seed)
    sizes = draw.integers(0, 900, 8)
    data = draw.integers(97, 99 + seed, sizes.sum()).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at, _ = repeats.anchors(data, offsets)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        own = at[(at >= a) & (at + repeats.GRAM <= b)]
        for start in range(a, b - repeats.LENGTH + 1):
            assert ((own >= start) & (own <= start + repeats.BEFORE)).any()


def test_docs_schema_is_the_tables(odd):
    assert odd.schema.simpleString() == "struct<" + DOCS.replace(" long", ":bigint").replace(" string", ":string").replace(", ", ",") + ">"
