"""Personal data, and the terms that give it away.

Entities are found by pattern: mail addresses, IP addresses, payment cards
that pass the Luhn check, and phone numbers in international form. Terms of
the texts that hold an entity are then judged by what the corpus knows: a term
discloses an entity if their pointwise mutual information reaches a share of the
entity's own information, log2(N / texts with the entity), and if at least
``SUPPORT`` different texts hold both. Disclosing terms are spans of kind ``term``,
at each of their places in the texts that hold the entity; in the sanitised text they
are generalised, or removed where they reveal nearly all.

Entities, terms, both together and N are counted over different texts, so copies
of a text are no evidence and hide none. All work on texts is DataFrame
expressions; terms are counted over all documents, summed before they are shuffled.

Defined cases: null and empty texts have no spans (a null text stays null);
rows with equal id and text get equal results; an id may be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.spans import apart, listed, matches, replaced, sha256, tagged
from tidemark.llm.tables import written

#: A match starts where a run of its characters starts, or where the match before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]+){2}\.[0-9]+"
#: Runs with too few digits match nowhere else inside, so the least number can stand in the pattern.
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = r"[\p{L}\p{N}]{3,}"
#: Different texts that must hold a term and an entity.
SUPPORT = 3
#: Shares of the entity's information from which a term is generalised, and removed.
DISCLOSES, REVEALS = 0.8, 0.95


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def entities(text: Column) -> Column:
    """All tagged spans of the four kinds in a text (not null)."""
    part = lambda p: F.char_length(F.ltrim(p, F.lit("0"))) <= 3
    small = lambda p: part(p) & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255)
    ip = F.filter(matches(text, IP), lambda s: F.forall(F.split(s["value"], r"\."), small))
    size = lambda s: F.char_length(_digits(s["value"]))
    card = F.filter(matches(text, CARD), lambda s: size(s).between(14, 19) & F.call_function("luhn_check", _digits(s["value"])))
    phone = F.filter(matches(text, PHONE), lambda s: size(s).between(10, 15))
    return F.concat(tagged(matches(text, EMAIL), "email", 0), tagged(ip, "ip", 1), tagged(card, "card", 2), tagged(phone, "phone", 3))


def _terms(text: Column) -> Column:
    """The different terms of a text, in small letters."""
    return F.array_distinct(F.transform(F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: F.char_length(w) >= 3), F.lower))


def _together(held: DataFrame) -> DataFrame:
    """(key, entity, term) for all terms of the texts (key, text, entities)."""
    return held.select("key", F.explode("entities").alias("entity"), _terms(F.col("text")).alias("terms")).select("key", "entity", F.explode("terms").alias("term"))


def _disclosing(docs: DataFrame, held: DataFrame) -> DataFrame:
    """(entity, term, share) of the terms that disclose an entity, over the different ones of ``docs`` (key, text); ``held`` are texts with entities that enough texts hold."""
    together = _together(held).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")).where(F.col("both") >= SUPPORT)
    with_entity = held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    # Copies of a text are one before their terms are counted.
    different = docs.groupBy("key").agg(F.first(_terms(F.col("text"))).alias("terms"))
    with_term = different.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    total = docs.select("key").distinct().count()
    joined = together.join(with_entity, "entity").join(with_term, "term")
    own = F.log2(F.lit(float(max(total, 2))) / F.col("n_entity"))
    shared = F.log2(F.col("both") * float(max(total, 2)) / (F.col("n_entity") * F.greatest("n_term", "both")))
    return joined.where(own > 0).select("entity", "term", (shared / own).alias("share")).where(F.col("share") >= DISCLOSES)


def _places(held: DataFrame, told: DataFrame) -> DataFrame:
    """(key, start, end, share) for every place of the terms ``told`` (key, term, share) in their texts."""
    texts = held.join(told.select("key").distinct(), "key", "left_semi")
    parts = F.arrays_zip(F.split("text", TERM, -1).alias("between"), F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("value"))
    parts = texts.select("key", F.posexplode(parts).alias("at", "part")).select("key", "at", "part.between", "part.value")
    size = F.char_length("between") + F.coalesce(F.char_length("value"), F.lit(0))
    ends = parts.withColumn("end", F.sum(size).over(Window.partitionBy("key").orderBy("at")).cast("int"))
    found = ends.withColumn("term", F.lower("value")).join(told, ["key", "term"])
    return found.select("key", (F.col("end") - F.char_length("value")).alias("start"), "end", "share")


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, key, base, more): entities, and disclosing terms with their share; one row for each row of ``docs``.

    ``key`` is a hash of the text.
    """
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = plain.select("id", F.xxhash64("text").alias("key"), entities(F.col("text")).alias("base"), "text")
    # Texts are kept only where an entity was found, for their terms.
    rows = written(found.withColumn("text", F.when(F.size("base") > 0, F.col("text"))))
    names = F.array_distinct(F.transform("base", lambda s: F.xxhash64(s["kind"], s["value"])))
    held = rows.where(F.size("base") > 0).groupBy("key").agg(F.first("text").alias("text"), F.first(names).alias("entities"))
    # Only entities that enough texts hold can have a disclosing term.
    known = written(held.select("key", F.explode("entities").alias("entity")))
    enough = known.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SUPPORT).select("entity")
    known = known.join(enough, "entity").groupBy("key").agg(F.collect_list("entity").alias("entities"))
    held = written(held.drop("entities").join(known, "key"))
    shares = written(_disclosing(plain.select(F.xxhash64("text").alias("key"), "text"), held))
    told = _together(held).join(shares, ["entity", "term"]).groupBy("key", "term").agg(F.max("share").alias("share"))
    places = _places(held, written(told))
    term = F.struct(F.col("start"), F.lit(len(KINDS)).alias("order"), F.col("end"), F.lit("term").alias("kind"), F.col("share"))
    more = places.groupBy("key").agg(F.collect_list(term).alias("more"))
    joined = rows.drop("text").join(more, "key", "left")
    # A term inside an entity goes with it.
    empty = F.array().cast(more.schema["more"].dataType)
    return joined.select(F.col("id").alias(id_column), "key", "base", apart(F.coalesce("more", empty), F.col("base")).alias("more"))


def _plain(spans: Column | str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_column,
        *[of(kind).alias(f"n_{kind}") for kind in KINDS],
        sha256(listed(_plain("base"))).alias("base_sha256"),
        listed(F.array_distinct(F.concat(_plain("base"), _plain("more")))).alias("spans"),
    )


def sanitised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns; in the text entities and disclosing terms are replaced."""
    names = docs.columns
    found = find(docs, id_column, text_column)
    spans = found.where((F.size("base") > 0) | (F.size("more") > 0)).groupBy(id_column, "key").agg(F.first("base").alias("base"), F.first("more").alias("more"))
    spans = spans.toDF("found_id", "key", "base", "more")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("new")))
    more = F.transform(
        "more",
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= REVEALS, "").otherwise("[TERM]").alias("new")),
    )
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    number, text = (F.col(f"c{names.index(c)}") for c in (id_column, text_column))
    same = number.eqNullSafe(F.col("found_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("key"))
    new = F.when(F.col("key").isNull(), text).otherwise(replaced(text, F.concat(base, more)))
    joined = plain.join(spans, same, "left")
    return joined.select(*[(new if c == text_column else F.col(f"c{k}")).alias(c) for k, c in enumerate(names)])
