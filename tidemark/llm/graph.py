"""Connected components of a graph given as pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written_and_cleared

#: Links up to which one task joins them; a round over all tasks costs more than these.
FEW = 10_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all links (u, v) at once."""
    root: dict[int, int] = {}

    def of(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for u, v in zip(*(batch.column(c).to_pylist() for c in ("u", "v")), strict=True):
            u, v = of(u), of(v)
            root[max(u, v)] = min(u, v)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([of(x) for x in nodes], pa.int64())], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Alternates two steps until nothing changes: every node links its larger
    neighbours, then its smaller ones, to the smallest of them. Each step is an
    aggregation and a join, so that a node with very many neighbours is split
    over tasks; no list of neighbours is ever built. Rounds grow with the
    logarithm of the longest chain. Nulls and self-links are ignored. At most
    ``FEW`` different links are joined by one task.
    """
    pairs = edges.select("a", "b").where("a <> b")
    links = written_and_cleared(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    if links.count() <= FEW:
        return written_and_cleared(links.coalesce(1).mapInArrow(_joined, "node long, root long"))
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
            .distinct()
        )
        after = written_and_cleared(small)
        same = after.count() == links.count() and not after.join(links, ["u", "v"], "left_anti").limit(1).count()
        links = after
        if same:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
