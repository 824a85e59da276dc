"""Secret scan with corpus-wide ownership of the candidates.

Candidates are found by pattern: assignments to names like ``password``, access
keys, long hexadecimal runs, and tokens that mix letters and digits. For each
distinct value the corpus tells how many repositories and owners have it. A
value that many owners have is a copied example; one that a single owner has
(or two), in however many repositories, and that looks like no placeholder is taken for live. Tokens count as secrets
only if they are live in this sense; the other kinds are reported always.

All work on texts is one pass of DataFrame expressions. Only hashes of values
are shuffled, first summed by value, repository and owner, so that a value in
very many texts meets no single task as rows.

Defined cases: null and empty texts have no spans; a null repository or owner
is one of its own; repeated rows are several texts of one owner; an id may be
null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import apart, listed, matches, sha256, tagged
from tidemark.llm.tables import written

ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
#: The value of an assignment, from its whole text.
ASSIGNED = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
#: Maximal runs that are too short match nowhere else inside, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*[0-9])(?=[0-9_+/-]*[A-Za-z])[A-Za-z0-9_+/-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "token")
LEAST_ASSIGNED = 6
#: Different characters that a token needs at least.
LEAST_VARIETY = 10
#: Owners from which on a value counts as a copied example. One owner's own repositories make it no example, however many.
COPIED_OWNERS = 3
PLACEHOLDER = r"(?i)example|changeme|placeholder|dummy|sample|your|xxxx|\*\*\*\*|0000000|1234567"


def _candidates(text: Column) -> Column:
    """All tagged spans with the value that ownership is counted for."""
    assigned = F.filter(
        F.transform(
            matches(text, ASSIGN),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.regexp_extract(s["value"], ASSIGNED, 1).alias("value")),
        ),
        lambda s: F.char_length(s["value"]) >= LEAST_ASSIGNED,
    )
    base = F.concat(tagged(assigned, "assign", 0), tagged(matches(text, ACCESS), "access", 1), tagged(matches(text, HEX), "hex", 2))
    varied = F.filter(matches(text, TOKEN), lambda s: F.size(F.array_distinct(F.split(s["value"], ""))) > LEAST_VARIETY)
    return F.struct(base.alias("base"), tagged(varied, "token", 3).alias("more"))


def scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", repository: Column | None = None, owner: Column | None = None
) -> DataFrame:
    """One row for each row of ``docs``: id, base, more, live, copied (arrays of spans).

    ``base`` are the patterns' spans, ``more`` the tokens taken for live;
    ``live`` and ``copied`` divide the spans of ``base`` by ownership.
    """
    repository = F.col("repository") if repository is None else repository
    owner = F.col("owner") if owner is None else owner
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.xxhash64(F.lit("owner"), owner).alias("owner"),
        F.xxhash64(F.lit("repository"), repository).alias("repository"),
    )
    found = plain.select("id", "owner", "repository", _candidates(text).alias("found")).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "owner",
        "repository",
        F.col("found.base").alias("base"),
        # A token inside a span of another kind adds nothing.
        apart(F.col("found.more"), F.col("found.base")).alias("more"),
    )
    rows = written(found.select(*found.columns, F.concat("base", "more").alias("spans")))
    values = rows.where(F.size("spans") > 0).select("row", "owner", "repository", F.explode("spans").alias("span"))
    values = values.withColumn("hash", F.sha2("span.value", 256))
    owned = values.groupBy("hash", "repository", "owner").agg(F.max(F.col("span.value").rlike(PLACEHOLDER)).alias("placeholder"))
    by_owner = owned.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.max("placeholder").alias("placeholder"))
    verdict = by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.max("placeholder").alias("placeholder")
    )
    live = (F.col("owners") < COPIED_OWNERS) & ~F.col("placeholder")
    judged = values.join(verdict.select("hash", live.alias("is_live")), "hash")
    spans = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("is_live"), F.col("span"))).alias("live"), F.collect_list(F.when(~F.col("is_live"), F.col("span"))).alias("copied")
    )
    none = F.array().cast(rows.schema["base"].dataType)
    of_base = lambda name: F.filter(F.coalesce(name, none), lambda s: s["kind"] != "token")
    return rows.drop("spans").join(spans, "row", "left").select(
        F.col("id").alias(id_column),
        "base",
        F.filter(F.coalesce("live", none), lambda s: s["kind"] == "token").alias("more"),
        of_base("live").alias("live"),
        of_base("copied").alias("copied"),
    )


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_column,
        *[of(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        sha256(listed(F.col("base"))).alias("base_sha256"),
        listed(F.concat("base", "more")).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.size("copied").cast("long").alias("n_copied"),
    )
