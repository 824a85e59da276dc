"""The operators applied to the driver's tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    html_extract,
    negatives,
    ngram_join,
    packing,
    periods,
    pii,
    quality_classifier,
    quality_rules,
    repeats,
    secrets,
    substring,
    toxicity,
)
from tidemark.llm.tables import table


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judged(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good_chance"
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, quality_classifier.graded(labels.where(~held_out())))
    return quality_classifier.score(docs, model).withColumn("held_out", held_out())


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out()))
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extracted(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated(table(spark, sf_dir, "documents")).drop("removed")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source is an owner, its texts of one language are a repository."""
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, repository=F.struct("source", "lang"), owner=F.col("source")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 7 take the next label first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), anchor="id % 100 = 0")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Texts of which one in ten, by the checksum h of the id, repeats a piece from word a on to its end."""
    words = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    words = words.withColumn("w", F.expr(r"""IF(h % 10 = 0, filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> ''), NULL)"""))
    words = words.withColumn("g", F.expr("h div 10")).withColumn("n", F.expr("size(w)"))
    words = words.withColumn("a", F.expr("IF(n > 0, CAST(g % n AS INT), NULL)"))
    words = words.withColumn("p", F.expr("1 + CAST((n - a) div (3 + g % 8) AS INT)"))
    tail = "transform(sequence(0, n - 1), i -> w[IF(i < a, i, a + (i - a) % p)])"
    return words.select("doc_id", F.expr(f"IF(n > 0 AND h % 10 = 0, array_join({tail}, ' '), text)").alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents"))).drop("runs")


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_windows_removed(table(spark, sf_dir, "documents")).drop("removed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_join": op5_ngram_join,
    "op6_html_extract": op6_html_extract,
    "op7_packing": op7_packing,
    "op8_repeats": op8_repeats,
    "op9_secrets": op9_secrets,
    "op10_pii": op10_pii,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_substring_dedup": op13_substring_dedup,
}
