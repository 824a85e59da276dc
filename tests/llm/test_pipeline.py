"""The pipeline's stages and the registered queries over the smallest tables."""

import random
import sys
from pathlib import Path

import brute
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402
from tidemark.llm.tables import table, written  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, TINY, "documents").collect()}


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, TINY, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, TINY))
        out.append(docs)
    return out


def test_stages_keep_the_columns_and_only_drop_rows(spark, stages, documents):
    before = set(documents)
    for docs in stages[:-1]:
        assert docs.columns == table(spark, TINY, "documents").columns
        now = [r["doc_id"] for r in docs.collect()]
        assert len(now) == len(set(now)) and set(now) <= before
        before = set(now)
    assert {r["doc_id"] for r in stages[-1].collect()} == before


def test_one_of_each_group_stays(stages):
    docs = [(r["doc_id"], r["text"]) for r in stages[0].collect()]
    component = brute.similar(docs, size=5, link=80)
    assert {r["doc_id"] for r in stages[1].collect()} == {i for i, (n, least) in component.items() if n == 0 or i == least}


def test_no_benchmark_item_stays_and_clean_documents_do(spark, stages):
    items = [" ".join(brute.words(r["text"])) for r in table(spark, TINY, "benchmark").collect()]
    plain = {r["doc_id"]: " ".join(brute.words(r["text"])) for r in stages[1].collect()}
    held = {k for k, t in plain.items() if any(i in t for i in items)}
    kept = {r["doc_id"] for r in stages[2].collect()}
    assert held and not held & kept
    near = {x for i in items for x in brute.shingles(i, 5)}
    assert {k for k, t in plain.items() if not brute.shingles(t, 5) & near} <= kept


def test_no_personal_data_stays(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    for r in stages[3].collect():
        assert sum(brute.personal(r["text"])[0]) == 0
        if sum(brute.personal(before[r["doc_id"]])[0]) == 0:
            assert r["text"] == before[r["doc_id"]]


def test_run_gives_the_last_stage(spark, stages):
    rows = lambda df: sorted((r["doc_id"], r["piece"], r["n_words"]) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, TINY)) == rows(stages[-1])


def run(spark, name):
    return {r[0]: tuple(r)[1:] for r in QUERIES[name](spark, TINY).collect()}


def test_similar_documents_query(spark, documents):
    assert run(spark, "op5_ngram_join") == brute.similar(list(documents.items()))


def test_repeats_query(spark, documents):
    some = dict(random.Random(0).sample(sorted(documents.items()), len(documents)))
    assert run(spark, "op8_repeats") == brute.repeats(list(some.items()))


def test_quality_rules_query(spark, documents):
    rows = run(spark, "op1_quality_rules")
    for k, t in documents.items():
        n, *_, repeated = measures = brute.measures(t)
        assert rows[k][:6] == (*measures, n < 10 or 100 * repeated > 20 * n)
        assert not (rows[k][5] and rows[k][6])


@pytest.mark.parametrize(("name", "base"), [("op9_secrets", brute.secrets), ("op10_pii", brute.personal)])
def test_span_queries(spark, documents, name, base):
    rows = run(spark, name)
    for k, t in documents.items():
        counts, listed, hashed = base(t)
        assert rows[k][: len(counts) + 1] == (*counts, hashed)
        assert set(filter(None, listed.split(","))) <= set(rows[k][len(counts) + 1].split(","))


@pytest.mark.parametrize("name", ["op2_decontaminate", "op3_quality_classifier", "op4_toxicity", "op6_html_extract", "op7_packing"])
def test_other_queries_run(spark, documents, name):
    rows = QUERIES[name](spark, TINY).collect()
    if name in ("op3_quality_classifier", "op4_toxicity"):
        assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    if name == "op7_packing":
        assert {r["doc_id"] for r in rows} == set(documents)
    if name == "op6_html_extract":
        assert all(r["n_chars"] == len(r["text"]) for r in rows) and len(rows) == table(spark, TINY, "pages").count()
    if name == "op2_decontaminate":
        items = {r["item_id"]: " ".join(brute.words(r["text"])) for r in table(spark, TINY, "benchmark").collect()}
        verbatim = {(d, i) for d, t in documents.items() for i, x in items.items() if x in " ".join(brute.words(t))}
        assert verbatim and verbatim <= {(r["doc_id"], r["item_id"]) for r in rows}
