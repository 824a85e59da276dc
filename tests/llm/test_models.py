"""Trees, isotonic calibration, toxicity and quality grades: held-out accuracy."""

import random

import numpy as np
import pytest
from conftest import text
from pyspark.sql import functions as F

from tidemark.llm import quality_classifier, toxicity
from tidemark.llm.queries import held_out
from tidemark.llm.trees import fit_isotonic, fit_trees

INSULTS = ["scumbag", "moronic", "trashy", "loserish"]


def labelled_texts(n=600, seed=0):
    draw, docs, labels = random.Random(seed), [], []
    for k in range(n):
        words = text(k, draw.randrange(20, 120)).split()
        toxic, poor = draw.random() < 0.3, draw.random() < 0.3
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                words.insert(draw.randrange(len(words)), f"you {draw.choice(INSULTS)}{draw.choice(['', 's', ',', 'ly'])}")
        if poor:
            words = [w + draw.choice(["###", "$$$", "%%%"]) for w in words]
        docs.append((k, " ".join(words)))
        labels.append((k, int(not poor), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = labelled_texts()
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(0)
    x = draw.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = fit_trees(x[:3000], y[:3000])
    assert (((trees.margins(x[3000:]) > 0) == y[3000:]).mean()) > 0.97


def test_isotonic_is_the_best_rising_fit():
    knots, values = fit_isotonic(np.array([1.0, 2, 3, 4, 5, 6]), np.array([0.0, 1, 0, 0, 1, 1]))
    fitted = np.interp([1, 2, 3, 4, 5, 6], knots, values)
    assert np.allclose(fitted, [0, 1 / 3, 1 / 3, 1 / 3, 1, 1]) and (np.diff(values) >= 0).all()


def test_toxicity_held_out(spark, tables):
    docs, labels, rows = tables
    model = toxicity.fit(docs, labels.where(~held_out()))
    scored = {r["doc_id"]: (r["score"], r["held"]) for r in toxicity.score(docs, model).withColumn("held", held_out()).collect()}
    held = [(scored[k][0] >= 0.5, bool(t)) for k, _, t in rows if scored[k][1]]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= s <= 1 for s, _ in scored.values())
    kept = toxicity.without_toxic(docs, model)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k in scored if scored[k][0] < 0.5)


def test_a_score_depends_on_the_text_alone(spark, tables):
    docs, labels, _ = tables
    model = toxicity.fit(docs, labels)
    score = lambda df: {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert score(docs.repartition(7)) == score(docs.coalesce(1))


def test_toxicity_on_odd_rows(spark, odd, nothing, clashing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (8, None), (999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    assert toxicity.score(odd, model).count() == odd.count() == toxicity.score(clashing, model).count()
    assert toxicity.without_toxic(clashing, model).columns == clashing.columns
    assert toxicity.score(nothing, model).collect() == []
    for no in (labels.limit(0), labels.where("doc_id = 999")):
        empty = toxicity.fit(odd, no)
        assert len({r["score"] for r in toxicity.score(odd, empty).collect()}) == 1
    ones = toxicity.fit(odd, labels.where("toxic = 1"))
    assert toxicity.score(odd, ones).where("score < 0.9").count() == 0


def test_grades_held_out(spark, tables):
    docs, labels, rows = tables
    model = quality_classifier.fit(docs, quality_classifier.graded(labels.where(~held_out())))
    scored = {r["doc_id"]: r for r in quality_classifier.score(docs, model).withColumn("held", held_out()).collect()}
    held = [(scored[k]["selected"], bool(q)) for k, q, _ in rows if scored[k]["held"]]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(1 >= r["tail_1"] >= r["tail_2"] >= 0 and abs(r["expected"] - r["tail_1"] - r["tail_2"]) < 1e-9 for r in scored.values())
    assert (np.diff(model.thresholds) >= 0).all()


def test_grades_on_odd_rows(spark, odd, nothing, clashing):
    labels = spark.createDataFrame([(1, 2), (4, 0), (None, 1), (8, None), (11, 1)], "doc_id long, grade int")
    model = quality_classifier.fit(odd, labels)
    assert quality_classifier.score(odd, model).count() == odd.count() == quality_classifier.score(clashing, model).count()
    assert quality_classifier.score(nothing, model).collect() == []
    even = quality_classifier.fit(odd, labels.limit(0))
    rows = quality_classifier.score(odd, even).collect()
    assert all(abs(r["tail_1"] - 2 / 3) < 1e-9 and abs(r["tail_2"] - 1 / 3) < 1e-9 for r in rows)


def test_samples_are_bounded_and_equal_texts_count_once(spark, tables):
    docs, labels, _ = tables
    assert toxicity.labelled(docs, labels, F.col("toxic"), 50).count() == 50
    twice = docs.union(docs.withColumn("doc_id", F.col("doc_id") + 10_000))
    more = labels.union(labels.withColumn("doc_id", F.col("doc_id") + 10_000))
    assert toxicity.labelled(twice, more, F.col("toxic"), 10_000).count() == docs.count()
