"""Best-fit packing of texts into sequences of fixed length, with conflicts.

A sequence (bin) holds pieces of at most ``CAPACITY`` words in all, at most
``PER_SOURCE`` of one source, and none twice of one duplicate cluster. Open bins
stand in the order of what is left in them and carry bitmaps of their sources
and clusters. A piece goes into the tightest bin that it fits and that has no
conflict: the search starts at the first bin with enough room and goes on to
the next larger ones until one is compatible; without any, a bin is opened. Of
several equally tight ones the oldest is taken.

Pieces are placed longest first. Texts longer than a bin are cut into full
pieces and a rest; nothing is dropped.

Texts are dealt over shards by a hash of all their columns, so that each shard holds a
like mix of sources and clusters, about ``SHARD`` texts; only keys and lengths
are dealt, never texts. A hot source or cluster is spread over all shards like
any other. Each shard is packed by itself, with bins of its own. Rows that are
equal in all columns are counted and numbered, and the order in a shard rests on columns and
numbers only, so the bins don't depend on how the input is partitioned.

Defined cases: null and empty texts have length 0 and one empty piece; a null
source or cluster is one of its own and never conflicts; repeated rows are
packed each for itself (they are one cluster where clusters are hashes of the
text); an id may be null.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.counted import expand_rows
from tidemark.llm.tables import written

CAPACITY = 2048
PER_SOURCE = 2
SHARD = 4096

WHITE = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text (null: none)."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")).cast("long")


def text_cluster(text: Column) -> Column:
    """The cluster of texts that are equal but for case and white space; a text without words has none."""
    plain = F.trim(F.regexp_replace(F.lower(text), WHITE, " "))
    return F.when(plain != "", F.xxhash64(plain))


class Shelf:
    """The open bins of a shard, ordered by what is left in them."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (room left, bin)
        self.used: list[int] = []
        self.sources: list[list[int]] = []  # bitmaps: sources met once or more, twice or more, ...
        self.clusters: list[int] = []  # bitmap
        self.names: dict[tuple, int] = {}

    def _bit(self, kind: str, name) -> int:
        return 0 if name is None else 1 << self.names.setdefault((kind, name), len(self.names))

    def place(self, length: int, source, cluster) -> tuple[int, int]:
        """The bin of a piece and where in it the piece begins."""
        source_bit, cluster_bit = self._bit("source", source), self._bit("cluster", cluster)
        at, chosen = bisect_left(self.order, (length, -1)), -1
        while at < len(self.order):
            number = self.order[at][1]
            if not (self.clusters[number] & cluster_bit or self.sources[number][-1] & source_bit):
                chosen = number
                break
            at += 1
        if chosen < 0:
            chosen = len(self.used)
            self.used.append(0)
            self.sources.append([0] * self.per_source)
            self.clusters.append(0)
        else:
            del self.order[at]
        begin = self.used[chosen]
        self.used[chosen] += length
        for k, bits in enumerate(self.sources[chosen]):
            if not bits & source_bit:
                self.sources[chosen][k] |= source_bit
                break
        self.clusters[chosen] |= cluster_bit
        insort(self.order, (self.capacity - self.used[chosen], chosen))
        return chosen, begin


def _packed(capacity: int, per_source: int):
    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "key", "tie", "piece"], ascending=[False, True, True, True], kind="stable")
        shelf = Shelf(capacity, per_source)
        optional = lambda name: [None if missing else value for value, missing in zip(rows[name].tolist(), rows[name].isna(), strict=True)]
        places = [shelf.place(*piece) for piece in zip(rows["length"].tolist(), optional("source"), optional("cluster"), strict=True)]
        rows = rows.assign(bin=[p[0] for p in places], begin=[p[1] for p in places])
        return rows[["row", "shard", "piece", "first", "length", "bin", "begin"]]

    return work


def packed(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD) -> DataFrame:
    """One row for each piece of ``docs`` (id, source, cluster, length), with all its columns.

    Adds piece, first_word and n_words of the piece, shard and bin, and begin,
    its place in the bin. Columns must be of types that can be grouped.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    of = {name: F.col(f"c{k}") for k, name in enumerate(names)}
    counted = plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("n_equal"))
    single = expand_rows(counted, "n_equal", "copy")
    # Hashes pass over nulls, so which columns are null is hashed too.
    whole = [*[F.col(c).isNull() for c in plain.columns], *plain.columns, "copy"]
    rows = written(
        single.select(
            *plain.columns, F.monotonically_increasing_id().alias("row"), F.xxhash64(*whole).alias("key"), F.xxhash64(F.lit("tie"), *whole).alias("tie")
        )
    )
    shards = max(1, math.ceil(rows.count() / shard))
    pieces = F.greatest(F.ceil(of["length"] / capacity), F.lit(1)).cast("int")
    long = (
        rows.select(
            "row", "key", "tie", F.pmod("key", F.lit(shards)).cast("int").alias("shard"),
            of["source"].cast("string").alias("source"), of["cluster"].cast("string").alias("cluster"), of["length"].alias("all"),
            F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"),
        )
        .withColumn("first", F.col("piece").cast("long") * capacity)
        .withColumn("length", F.least(F.col("all") - F.col("first"), F.lit(capacity)).cast("long"))
        .drop("all")
    )
    done = long.groupBy("shard").applyInPandas(
        _packed(capacity, per_source), "row long, shard int, piece int, first long, length long, bin long, begin long"
    )
    return done.join(rows.drop("key", "tie"), "row").select(
        *[of[name].alias(name) for name in names], "piece", F.col("first").alias("first_word"), F.col("length").alias("n_words"), "shard", "bin", "begin"
    )


def packed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Documents packed by their words; texts that are equal but for case and white space are one cluster."""
    text = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), text_cluster(text).alias("cluster"), n_words(text).alias("length"))
    return packed(rows).withColumnRenamed("id", id_column)
