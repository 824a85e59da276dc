"""A corpus pipeline of the operators for training data.

Toxic documents go, one document of each group of near copies stays, documents
that hold a benchmark item go, personal data in the texts is replaced, and what
is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, ngram_join, packing, pii, toxicity
from tidemark.llm.queries import held_out
from tidemark.llm.tables import table, written

#: Near copies: five-word shingles and a similarity of 0.8 or more.
COPIES = {"words": 5, "link": (80, 100)}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.without_toxic(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, **COPIES)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs)


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("best-fit packing", into_sequences),
]

#: SQL can't express trained scores and fingerprints; tests/llm/test_pipeline.py has the stages row by row.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
