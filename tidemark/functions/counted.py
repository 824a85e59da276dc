"""Counted rows: relations that hold equal rows once, with a count.

Ordering all rows of one customer in a window puts that customer into one
task. The helpers here reduce rows to distinct days first, which Spark does
map-side, so that a window or an array has at most one entry per calendar day
however many rows the customer has. ``expand_rows`` turns counts back into rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import aggregate

# A count is split into parts of these sizes, the smallest being what one row
# is expanded to after the shuffle.
PARTS = (1_000_000, 1_000)

# Days of a block of ``day_blocks``: 16 words of 64 bits.
BLOCK_DAYS = 1024


def expand_rows(
    df: DataFrame, count: str, index: str | None = None, parts: Sequence[int] = PARTS
) -> DataFrame:
    """Repeat each row ``count`` times; ``index`` names a 1-based copy number.

    A large count is cut into parts, which are spread over the cluster before
    the copies are made, so neither one task nor one array holds all of them.
    """
    first, stop = "0L", count
    rows, helpers = df.where(f"{count} > 0"), [count]
    for size in parts:
        helpers += [f"_first_{size}", f"_stop_{size}"]
        rows = rows.selectExpr("*", f"explode(sequence({first}, {stop} - 1, {size}L)) AS _first_{size}")
        rows = rows.selectExpr("*", f"least({stop}, _first_{size} + {size}) AS _stop_{size}")
        first, stop = f"_first_{size}", f"_stop_{size}"
    copies = f"explode(sequence({first} + 1, {stop})) AS {index or '_copy'}"
    return rows.hint("rebalance").selectExpr("*", copies).drop(*helpers, "_copy")


def day_counts(df: DataFrame, key: str, day: str, count: str = "1") -> DataFrame:
    """One row per (key, day) with ``n``, the number of rows (or the sum of a count)."""
    return df.groupBy(key, day).agg(F.expr(f"sum({count})").alias("n"))


def gap_counts(days: DataFrame, key: str, day: str, gap: str = "interval_days") -> DataFrame:
    """Days between consecutive rows per key, as counted rows (key, gap, n).

    Of the ``n`` rows on one day the first lies a whole gap after the previous
    day (NULL for the first day); the others follow after 0 days. Rows without
    a day come first; gaps to or from them are NULL.
    """
    by_day = Window.partitionBy(key).orderBy(day)
    steps = days.withColumn("_step", F.datediff(day, F.lag(day).over(by_day)))
    one = F.lit(1).cast("bigint")
    pieces = F.array(
        F.struct(F.col("_step").alias(gap), one.alias("n")),
        F.struct(F.when(F.col(day).isNotNull(), F.lit(0)).alias(gap), (F.col("n") - 1).alias("n")),
    )
    return steps.select(key, F.inline(pieces)).where(F.col("n") > 0)


def rank_counts(counts: DataFrame, key: str, value: str) -> DataFrame:
    """Counted rows (key, value, n) with ``before`` (rows of the key that sort
    lower) and ``cnt`` (all rows of the key). Expects each value once per key."""
    per_key = Window.partitionBy(key)
    upto = per_key.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("cnt", F.sum("n").over(per_key)).withColumn(
        "before", F.sum("n").over(upto) - F.col("n")
    )


def gap_median(gaps: DataFrame, key: str, name: str, gap: str = "interval_days") -> DataFrame:
    """The lower median of a key's known counted gaps, as (key, name)."""
    counts = gaps.where(f"{gap} IS NOT NULL").groupBy(key, gap).agg(F.sum("n").alias("n"))
    middle = "(cnt + 1) div 2"
    ranked = rank_counts(counts, key, gap).where(f"before < {middle} AND {middle} <= before + n")
    return ranked.select(key, F.col(gap).alias(name))


def day_blocks(df: DataFrame, key: str, day: str, count: str, columns: Mapping[str, str]) -> DataFrame:
    """One row per key and BLOCK_DAYS days: ``block`` (their number), ``bits0`` to ``bits15`` (one bit
    for each day with rows), ``n_rows`` (rows with a day) and the aggregates ``columns``.

    All states are of fixed width, so rows are combined map-side in a plain hash
    aggregation, and at most one row per block of a key is shuffled per map task.
    Rows without a day have the block NULL and no bits.
    """
    number = f"unix_date({day})"
    bits = {
        f"bits{i}": f"bit_or(CASE WHEN shiftright({number}, 6) & 15 = {i} THEN shiftleft(1L, {number} & 63) END)"
        for i in range(BLOCK_DAYS // 64)
    }
    dated = df.selectExpr("*", f"shiftright({number}, 10) AS block")
    rows = {"n_rows": f"sum(CASE WHEN {day} IS NOT NULL THEN {count} ELSE 0 END)"}
    return aggregate(dated, [key, "block"], bits | rows | dict(columns))


def block_medians(blocks: DataFrame, key: str, name: str, columns: Mapping[str, str]) -> DataFrame:
    """One row per key: the lower median of the days between its consecutive rows, and ``columns``.

    ``columns`` are aggregates of the blocks. A key's blocks (one for each BLOCK_DAYS days, however many
    rows it has) meet in a window. As binary text a block is its days as ones, and the zeros between
    two ones are the days between; only the first day's gap needs the block before. Rows sharing a day are 0 days
    apart; those zeros sort before every gap between two days, so only their number matters.
    """
    parts = [f"lpad(bin(coalesce(bits{i}, 0L)), 64, '0')" for i in reversed(range(BLOCK_DAYS // 64))]
    pieces = blocks.selectExpr("*", f"split(concat({', '.join(parts)}), '1') AS zeros").selectExpr(
        "*",
        "size(zeros) - 1 AS n_days",
        f"block * {BLOCK_DAYS} + length(element_at(zeros, -1)) AS first_day",
        f"block * {BLOCK_DAYS} + {BLOCK_DAYS - 1} - length(zeros[0]) AS last_day",
        "transform(slice(zeros, 2, greatest(size(zeros) - 2, 0)), z -> length(z) + 1) AS inner_gaps",
    )
    of_key = Window.partitionBy(key)
    in_order = of_key.orderBy("block")
    steps = pieces.withColumns({"before": F.lag("last_day").over(in_order), "after": F.lead("block").over(in_order)})
    gaps = F.expr("IF(before IS NULL, inner_gaps, concat(array(first_day - before), inner_gaps))")
    whole = steps.withColumn("gaps", gaps).withColumns(
        {
            "all_gaps": F.flatten(F.collect_list("gaps").over(of_key)),
            "total": F.sum("n_rows").over(of_key),
            "days": F.sum("n_days").over(of_key),
            **{column: F.expr(sql).over(of_key) for column, sql in columns.items()},
        }
    )
    middle = "total div 2"
    median = f"""
        CASE WHEN total > 1 AND {middle} <= total - days THEN 0
             WHEN total > 1 THEN sort_array(all_gaps)[CAST({middle} - (total - days) - 1 AS INT)] END"""
    return whole.where("after IS NULL").selectExpr(key, *columns, f"{median} AS {name}")


def top_rows(df: DataFrame, key: str | list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key with their position ``rn``.

    The position filter sits directly on the window, so that Spark keeps only
    ``k`` rows per key and map task before the shuffle.
    """
    keys = [key] if isinstance(key, str) else key
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rn", position).where(F.col("rn") <= k)
