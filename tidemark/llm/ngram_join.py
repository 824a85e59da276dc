"""Similarity self-join of texts by their word shingles (adaptive multi-match prefixes).

Two texts link when the Jaccard similarity of their sets of distinct word
shingles reaches a bound; ``similar_documents`` returns the connected
components of these links.

Method. All shingles have one global order, rare ones first. If two sets are
similar enough, the first ``n - t + l`` shingles of both share at least ``l``
(``t``: the least overlap a set of n needs with any partner). Each document
picks its own l: a longer prefix costs more lookups, but demands more matches
before a pair is verified. Frequencies come from counters over all documents.
A pair needs as many matches as the smaller l of the two.

Texts with equal sets form one class, which is compared once. Components don't
need every pair of a large group of near copies: first each class is verified
against the leader (smallest class) of the prefix shingles it shares. Then
every candidate pair whose classes are still in different components is
verified, so that no link between components is lost. Shingles that very many
classes still share are left to a blockwise comparison of these classes.

Texts travel late. Each class has a sketch, the parities of its shingles'
numbers in as many buckets as it has shingles or more: buckets whose parities
differ are at most as many as the shingles that only one of two sets has, so
pairs whose sketches differ too much can't link, and nearly all pairs that
merely share a common shingle go by 64 bytes or so. Only classes with a pair
left are read again, and the shuffles of each step go before the next begins.

Defined cases: null or empty texts and texts without words have an empty set
and link with nothing; a text with fewer words than a shingle is one shingle;
repeated rows are rows of the same class; rows with a null id count as rows,
their id never becomes a component's id unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.graph import components
from tidemark.llm.tables import PARTS, dropped, hot_keys, passing, spread_join, written, written_and_cleared

WORDS = 4
#: Similarity bound as a fraction.
LINK = (85, 100)
#: Counters of the frequency sketch, as a power of two: 2 MB, whatever the input.
SKETCH_BITS = 19
#: Classes, by its counter, from which on a shingle is frequent: its rows are dealt to several tasks.
FREQUENT = 10_000
#: Longest prefix extension considered.
MOST_MATCHES = 8
#: Cost of verifying a pair, in lookups for each shingle of the document.
VERIFY_COST = 0.1

#: Pairs up to which the classes of a shingle's group are paired one by one.
MOST_PAIRS = 4096
#: Bytes of text or of sketches, and classes, in a block of a hot cluster.
BLOCK_BYTES, BLOCK_CLASSES = 1 << 21, 2000
#: Buckets of the smallest sketch.
LEAST_BUCKETS = 64
#: Rows of a matrix that are worked on at once.
STRIP = 512


def least_overlap(n: int | np.ndarray, link: tuple[int, int]):
    """The overlap a set of n needs with any partner it links with."""
    return -(-link[0] * n // link[1])


def _class_of(values: np.ndarray) -> int:
    """64-bit name of a set of shingles."""
    folded = np.bitwise_xor.reduce(flat.mix(values * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(values))))
    return int(flat.mix(np.array([values.sum(dtype=np.uint64) ^ folded + np.uint64(len(values))], np.uint64))[0].view(np.int64))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def sketch(values: np.ndarray) -> bytes:
    """The parities of a set's numbers of shingles in a power of two of buckets, at least as many as shingles."""
    buckets = max(LEAST_BUCKETS, 1 << (len(values) - 1).bit_length())
    counts = np.bincount((values & np.uint64(buckets - 1)).view(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded(parities: bytes, size: int) -> bytes:
    """A sketch as one of ``size`` bytes, with fewer buckets."""
    while len(parities) > size:
        half = len(parities) // 2
        parities = (int.from_bytes(parities[:half]) ^ int.from_bytes(parities[half:])).to_bytes(half)
    return parities


def most_apart(sizes, link: tuple[int, int]):
    """The most shingles that only one of two sets has, given the sum of their sizes, if they link."""
    return sizes - 2 * -(-link[0] * sizes // (link[0] + link[1]))


def _scan(words: int):
    """Of each text its size and class (kind 0), with the class's sketch once a task; of each task its shingle counts (kind 1).

    A class counts once a task: further copies change no order that matters.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        seen = set()
        names = ["kind", "id", "key", "cls", "n", "sketch"]
        for run in flat.runs(batches):
            sets = flat.shingle_sets(run.column("text"), words)
            classes = [_class_of(s) if len(s) else 0 for s in sets]
            new, sketches = [], [None] * len(sets)
            for i, (s, c) in enumerate(zip(sets, classes, strict=True)):
                if len(s) and c not in seen:
                    seen.add(c)
                    new.append(s)
                    sketches[i] = sketch(s)
            if new:
                counts += np.bincount((np.concatenate(new) >> np.uint64(64 - SKETCH_BITS)).view(np.int64), minlength=len(counts))
            n = run.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int8)), run.column("id"), run.column("key"), pa.array(classes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sketches, pa.binary())], names
            )
        full = np.flatnonzero(counts)
        for at in range(0, len(full), 100_000):
            part = full[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(part), np.int8)), pa.array(part), *[pa.array(np.zeros(len(part), np.int64))] * 2, pa.array(counts[part]), pa.nulls(len(part), pa.binary())], names
            )

    return work


def prefix(values: np.ndarray, counts: np.ndarray, link: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """The prefix of a sorted set in the global order, the level of each shingle, and l.

    A shingle of level k belongs to the prefixes for k matches and more.
    """
    n, cost = len(values), counts[(values >> np.uint64(64 - SKETCH_BITS)).view(np.int64)]
    order = np.lexsort((values, cost))
    need = int(least_overlap(n, link))
    first = n - need + 1
    most = min(MOST_MATCHES, need)
    lookups = np.cumsum(cost[order[: first + most - 1]].astype(np.float64))[first - 1 :]
    matches = np.arange(1, most + 1)
    chosen = int(np.argmin(lookups + lookups / matches * (VERIFY_COST * n))) + 1
    length = first + chosen - 1
    level = np.maximum(np.arange(length) - first + 2, 1)
    return values[order[:length]], level, chosen


def _prefixes(words: int, link: tuple[int, int], counts):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = counts.value, set()
        for run in flat.runs(batches):
            tokens, classes, sizes, levels, chosen, frequent = [], [], [], [], [], []
            for s in flat.shingle_sets(run.column("text"), words):
                if not len(s) or (c := _class_of(s)) in seen:
                    continue
                seen.add(c)
                part, level, most = prefix(s, table, link)
                tokens.append(part)
                classes.append(np.full(len(part), c, np.int64))
                sizes.append(np.full(len(part), len(s), np.int32))
                levels.append(level.astype(np.int8))
                chosen.append(np.full(len(part), most, np.int8))
                frequent.append(table[(part >> np.uint64(64 - SKETCH_BITS)).view(np.int64)] >= FREQUENT)
            if tokens:
                columns = [np.concatenate(x) for x in (classes, sizes, levels, chosen, frequent)]
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(tokens)), *map(pa.array, columns)], ["token", "cls", "n", "level", "matches", "frequent"])

    return work


def _verified(words: int, link: tuple[int, int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] = ("", np.zeros(0, np.uint64))
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                left = flat.shingle_sets(batch.column("text_a").slice(i, 1), words)[0]
                text = batch.column("text_b")[i].as_py()
                if text != last[0]:
                    last = (text, flat.shingle_sets(batch.column("text_b").slice(i, 1), words)[0])
                both = len(np.intersect1d(left, last[1], assume_unique=True))
                kept.append(link[1] * both >= link[0] * (len(left) + len(last[1]) - both))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return work


def _alike(link: tuple[int, int]):
    """The pairs whose sketches leave open that they link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = most_apart(batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy(), link).tolist()
            kept = []
            for x, y, limit in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), most, strict=True):
                size = min(len(x), len(y))
                kept.append((int.from_bytes(folded(x, size)) ^ int.from_bytes(folded(y, size))).bit_count() <= limit)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return work


def _near(pairs: DataFrame, classes: DataFrame, link: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of classes that may link, by their sketches; all that link are among them."""
    side = lambda name: classes.select(F.col("cls").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))
    return written_and_cleared(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInArrow(_alike(link), "a long, b long"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls")))


def _texts(plain: DataFrame, classes: DataFrame, some: DataFrame) -> DataFrame:
    """(cls, text) of the classes in ``some``, written."""
    one = classes.join(some.distinct(), "cls", "left_semi").select("cls", "one")
    here = F.col("id").eqNullSafe(F.col("one.id")) & (F.col("key") == F.col("one.key"))
    return written_and_cleared(plain.join(one, here).select("cls", "text"))


def _links(pairs: DataFrame, texts: DataFrame, words: int, link: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of classes that link, verified on the texts."""
    side = lambda name: texts.select(F.col("cls").alias(name), F.col("text").alias(f"text_{name}"))
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInArrow(_verified(words, link), "a long, b long")


def _fits(n: str, m: str, link: tuple[int, int]):
    return F.least(n, m) * link[1] >= F.greatest(n, m) * link[0]


def similar_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, link: tuple[int, int] = LINK
) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id.

    ``component_id`` is the smallest id reachable by links, the row's own included.
    """
    members = _components(docs, id_column, text_column, words, link)
    least = members.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    alone = members.where("root is null").select("id", "n", F.col("id").alias("component_id"))
    rows = members.join(least, "root").select("id", "n", "component_id").union(alone)
    return rows.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, link: tuple[int, int] = LINK
) -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each component: the one with the smallest id.

    Texts without words link with nothing and all stay.
    """
    members = _components(docs, id_column, text_column, words, link).where("root is not null")
    first = members.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "key")).alias("first"))
    # Joined and freed of repetitions by the same columns, so the rows with their texts are dealt once.
    first = first.select("first.unknown", F.coalesce("first.id", F.lit(0)).alias("number"), "first.key")
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    number, text = (F.col(f"c{names.index(c)}") for c in (id_column, text_column))
    worded = F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    number = number.cast("long")
    by = {"unknown": number.isNull(), "number": F.coalesce(number, F.lit(0)), "key": F.xxhash64(text)}
    kept = plain.where(worded).withColumns(by).join(first, list(by), "left_semi")
    kept = kept.dropDuplicates([f"c{names.index(id_column)}", *by]).drop(*by)
    return kept.union(plain.where(~worded)).toDF(*names)


def _components(docs: DataFrame, id_column: str, text_column: str, words: int, link: tuple[int, int]) -> DataFrame:
    """(id, key, n, root) for each row; ``key`` is a hash of the text, ``root`` names the component (null: no words)."""
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    plain = plain.withColumn("key", F.xxhash64("text"))
    with passing() as kept:
        members, classes, roots = _roots(plain, words, link)
        kept += [members, classes, roots]
    members = members.where("kind = 0").select("id", "key", "cls", "n")
    return spread_join(members, roots, ["cls"], ["id", "key"], hot_keys(classes, ["cls"], "rows"), "left").select(
        "id", "key", "n", F.when(F.col("n") > 0, F.coalesce("root", "cls")).alias("root")
    )


def _roots(plain: DataFrame, words: int, link: tuple[int, int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``_scan``, a row for each class (cls, one, rows, n, sketch), and (cls, root) for linked classes; all three written."""
    spark = plain.sparkSession
    scanned = written(plain.mapInArrow(_scan(words), "kind byte, id long, key long, cls long, n long, sketch binary"))
    sums = scanned.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    counts[sums.column("id").to_numpy()] = sums.column("n").to_numpy()
    # Counters hold many shingles each: what all hold is no sign of a frequent one.
    counts = np.maximum(counts - int(np.median(counts)), 1)
    table = spark.sparkContext.broadcast(np.minimum(counts, 1 << 30).astype(np.int32))

    rows = plain.mapInArrow(_prefixes(words, link, table), "token long, cls long, n int, level byte, matches byte, frequent boolean")
    shared = _led(rows)

    classes = scanned.where("kind = 0").groupBy("cls").agg(
        F.min(F.struct("id", "key")).alias("one"), F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
    )
    classes = written_and_cleared(classes)

    first = (
        shared.where("cls <> leader").where(_fits("n", "leader_n", link))
        .groupBy("cls", "leader").agg(F.count(F.lit(1)).alias("found"))
        .groupBy("cls").agg(F.max_by("leader", F.struct("found", "leader")).alias("b"))
        .select(F.col("cls").alias("a"), "b")
    )
    near = _near(first, classes, link)
    texts = _texts(plain, classes, _ends(near))
    links = written_and_cleared(_links(near, texts, words, link))
    dropped(near, texts)

    joined = shared.join(components(links), F.col("cls") == F.col("node"), "left").select(
        "token", "cls", "n", "level", "matches", F.coalesce("root", "cls").alias("comp")
    )
    rest = _remaining(joined, plain, classes, words, link)
    roots = components(written(links.union(rest)))
    roots = written(roots.select(F.col("node").alias("cls"), "root"))
    return scanned, classes, roots


def _led(rows: DataFrame) -> DataFrame:
    """(token, cls, n, level, matches, leader, leader_n) of the prefix shingles that several classes share; the leader is their smallest.

    A frequent shingle's rows are dealt to ``PARTS`` tasks, whose leaders are joined to them.
    """
    dealt = rows.withColumn("part", F.when(F.col("frequent"), F.pmod(F.xxhash64("cls"), F.lit(PARTS)).cast("int")).otherwise(0))
    group = Window.partitionBy("token", "part")
    dealt = dealt.withColumn("leader", F.min(F.struct("cls", "n")).over(group)).withColumn("last", F.max("cls").over(group))
    dealt = written_and_cleared(dealt.where("frequent or leader.cls <> last").dropDuplicates(["token", "part", "cls"]))
    names = ["token", "cls", "n", "level", "matches", "leader"]
    often = dealt.where("frequent")
    ends = often.groupBy("token").agg(F.min("leader").alias("leader"), F.max("last").alias("last")).where("leader.cls <> last")
    ends = ends.select("token", "leader", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    often = written_and_cleared(often.drop("leader", "last").join(ends, ["token", "part"]).select(names))
    return dealt.where("not frequent").select(names).union(often).select(*names[:-1], F.col("leader.cls").alias("leader"), F.col("leader.n").alias("leader_n"))


def _remaining(rows: DataFrame, plain: DataFrame, classes: DataFrame, words: int, link: tuple[int, int]) -> DataFrame:
    """The links (a, b) between classes in different components, or enough of them to connect the same.

    In each shingle's group the largest component is set apart: pairs are made
    of the other classes with each other and with it, never within it. Groups
    that would still make many pairs are compared blockwise instead: first the
    sketches of their classes, then the texts of those that have a partner left.
    """
    sizes = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("size"))
    major = sizes.groupBy("token").agg(
        F.max_by("comp", F.struct("size", "comp")).alias("major"), F.count(F.lit(1)).alias("comps"), F.sum("size").alias("all"), F.max("size").alias("most")
    ).where("comps > 1")
    hot = (F.col("all") - F.col("most")) * F.col("all") > MOST_PAIRS
    tagged = written_and_cleared(rows.join(major.select("token", "major", hot.alias("hot")), "token"))
    few = tagged.where("not hot")
    names = ("cls", "n", "level", "matches", "comp")
    both = few.where("comp <> major").join(few.select("token", *[F.col(c).alias(f"{c}_b") for c in names]), "token")
    need = F.least("matches", "matches_b")
    pairs = (
        both.where("comp <> comp_b").where("comp_b = major or cls < cls_b")
        .where(_fits("n", "n_b", link))
        .where(F.greatest("level", "level_b") <= need)
        .groupBy(F.least("cls", "cls_b").alias("a"), F.greatest("cls", "cls_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("found"), F.max(need).alias("need"))
    )
    # Matches on hot shingles aren't counted for a pair; it has at most as many as either class.
    uncounted = tagged.where("hot").groupBy("cls").agg(F.count(F.lit(1)).alias("uncounted"))
    side = lambda name: uncounted.select(F.col("cls").alias(name), F.col("uncounted").alias(f"uncounted_{name}"))
    unsure = pairs.where("found < need").join(side("a"), "a").join(side("b"), "b").where("found + least(uncounted_a, uncounted_b) >= need")
    pairs = pairs.where("found >= need").select("a", "b").union(unsure.select("a", "b"))
    near = _near(written_and_cleared(pairs), classes, link)
    groups = tagged.where("hot").select("token", "cls", "n").distinct()
    if groups.isEmpty():
        return written_and_cleared(_links(near, _texts(plain, classes, _ends(near)), words, link))
    clusters = _clusters(groups)
    sketches = tagged.where("hot").select("cls", "comp").distinct().join(classes.select("cls", F.col("n").alias("shingles"), "sketch"), "cls")
    close = _dealt(clusters, sketches, link, "sketch").groupBy("cluster", "low", "high").applyInArrow(_close(link), "cls long")
    close = written_and_cleared(close.distinct())
    texts = _texts(plain, classes, _ends(near).union(close))
    return written_and_cleared(_links(near, texts, words, link).union(_blockwise(clusters.join(close, "cls", "left_semi"), texts, words, link)))


def _clusters(groups: DataFrame) -> DataFrame:
    """(cluster, cls, n), written: groups (token, cls, n) that share classes form a cluster."""
    star = groups.join(groups.groupBy("token").agg(F.min("cls").alias("b")), "token").select(F.col("cls").alias("a"), "b")
    clusters = components(star).select(F.col("node").alias("cls"), F.col("root").alias("cluster"))
    return written_and_cleared(clusters.join(groups.groupBy("cls").agg(F.max("n").alias("n")), "cls").select("cluster", "cls", "n"))


def _blockwise(clusters: DataFrame, texts: DataFrame, words: int, link: tuple[int, int]) -> DataFrame:
    """Links that connect what all links among the classes of clusters (cluster, cls, n) connect.

    Every two blocks that meet do so in a task of their own, which compares
    their sets as matrices and gives a spanning forest.
    """
    return _dealt(clusters, texts, link).groupBy("cluster", "low", "high").applyInArrow(_forest(words, link), "a long, b long")


def _dealt(groups: DataFrame, rows: DataFrame, link: tuple[int, int], content: str = "text") -> DataFrame:
    """(cluster, low, high) and the columns of ``rows``, one for each class with its ``content``: the classes of each two blocks that must meet.

    ``groups`` are hot groups (token, cls, n) or their clusters. A cluster of several blocks is split into
    bands of set sizes, each so wide that only sets of the same or of neighbouring bands
    can link; a band's rows are dealt into blocks of bounded size.
    """
    clusters = groups if "cluster" in groups.columns else _clusters(groups)
    members = clusters.join(rows, "cls")
    size = F.greatest(F.sum(F.octet_length(content)) / BLOCK_BYTES, F.count(F.lit(1)) / BLOCK_CLASSES)
    blocks = F.greatest(F.ceil(size).cast("int"), F.lit(1))
    # A little wider than needed, for what rounding may do to the logarithms.
    width = float(np.log(1.001 * link[1] / link[0]))
    band = F.when(F.col("whole") > 1, F.floor(F.log("n") / width).cast("long")).otherwise(F.lit(0).cast("long"))
    members = members.join(members.groupBy("cluster").agg(blocks.alias("whole")), "cluster").withColumn("band", band)
    bands = members.groupBy("cluster", "band").agg(blocks.alias("blocks"))
    beside = bands.select("cluster", F.col("band").alias("other"), F.col("blocks").alias("others"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    beside = bands.join(beside, ["cluster", "band"]).groupBy("cluster", "band", "blocks").agg(F.collect_list(F.struct("other", "others")).alias("beside"))
    name = lambda band, block: band * F.lit(1 << 32) + block
    met = F.flatten(F.transform("beside", lambda o: F.transform(F.sequence(F.lit(0), o["others"] - 1), lambda k: name(o["other"], k))))
    dealt = members.join(beside, ["cluster", "band"]).withColumn("own", name(F.col("band"), F.pmod(F.xxhash64("cls"), "blocks")))
    dealt = dealt.select("cluster", "own", F.explode(met).alias("met"), *rows.columns)
    return dealt.select("cluster", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"), *rows.columns)


def _close(link: tuple[int, int]):
    """The classes that may link, by their sketches, with one of another component."""

    def work(table: pa.Table) -> pa.Table:
        classes, comps, shingles = (table.column(c).to_numpy() for c in ("cls", "comp", "shingles"))
        sketches = table.column("sketch").to_pylist()
        lengths = np.array([len(s) for s in sketches])
        found = np.zeros(len(classes), bool)
        for size in np.unique(lengths).tolist():
            # Each pair is compared by as many buckets as its smaller sketch has.
            left, right = np.flatnonzero(lengths == size), np.flatnonzero(lengths >= size)
            bits = np.frombuffer(b"".join(folded(sketches[i], size) for i in right), np.uint8).reshape(len(right), size)
            ours = lengths[right] == size
            both = np.zeros((len(left), len(right)), np.float32)
            for at in range(0, size, 256):
                part = np.unpackbits(bits[:, at : at + 256], axis=1).astype(np.float32)
                own = part[ours]
                for k in range(0, len(left), STRIP):
                    both[k : k + STRIP] += own[k : k + STRIP] @ part.T
            ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
            for k in range(0, len(left), STRIP):
                some = left[k : k + STRIP]
                apart = ones[ours][k : k + STRIP, None] + ones[None, :] - 2 * both[k : k + STRIP]
                near = (apart <= most_apart(shingles[some, None] + shingles[None, right], link)) & (comps[some, None] != comps[None, right])
                found[some] |= near.any(axis=1)
                found[right] |= near.any(axis=0)
        return pa.table({"cls": classes[found]})

    return work


def _forest(words: int, link: tuple[int, int]):
    def work(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks()
        classes = batch.column("cls").to_numpy()
        sets = [s for run in flat.runs(iter(batch.to_batches())) for s in flat.shingle_sets(run.column("text"), words)]
        sizes = np.array([len(s) for s in sets])
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        values = values[counts > 1]  # others add nothing to an intersection
        row, column = [], []
        for i, s in enumerate(sets):
            at = np.searchsorted(values, s)
            at = at[(at < len(values)) & (values[np.minimum(at, max(len(values) - 1, 0))] == s)] if len(values) else at[:0]
            row.append(np.full(len(at), i))
            column.append(at)
        row, column = np.concatenate(row), np.concatenate(column)
        both = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for first in range(0, len(values), 2048):
            a, b = np.searchsorted(column, [first, first + 2048])
            part = np.zeros((len(sets), 2048), np.float32)
            part[row[a:b], column[a:b] - first] = 1
            for k in range(0, len(sets), STRIP):
                both[k : k + STRIP] += part[k : k + STRIP] @ part.T
        linked = np.empty(both.shape, bool)
        strips = [slice(k, k + STRIP) for k in range(0, len(sets), STRIP)]
        for rows in strips:
            linked[rows] = link[1] * both[rows] >= link[0] * (sizes[rows, None] + sizes[None, :] - both[rows])
        del both
        label = np.arange(len(sets))
        while True:
            least = np.concatenate([np.where(linked[rows], label[None, :], len(sets)).min(axis=1) for rows in strips])
            least = np.minimum(label, least)
            if (least == label).all():
                break
            label = least[least]
        apart = np.flatnonzero(label != np.arange(len(sets)))
        return pa.table({"a": classes[apart], "b": classes[label[apart]]})

    return work
