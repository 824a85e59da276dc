"""SQL expressions used by several operators.

Aggregations here have dozens of columns. They are written as SQL texts,
which Spark parses in one step each; conditions shared by many aggregates are
computed once per row as flag columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_literal(day: date) -> str:
    return f"DATE'{day.isoformat()}'"


def days_before(day: date, days: int) -> str:
    return day_literal(day - timedelta(days=days))


def within_last(column: str, day: date, days: int, until: int = 0) -> str:
    """``column`` lies in [day - days, day - until], both ends in."""
    return f"{column} BETWEEN {days_before(day, days)} AND {days_before(day, until)}"


def line_cents(price: str = "price_at_purchase", quantity: str = "quantity") -> str:
    """Value of an order line in whole cents.

    Sums over BIGINT cents are exact, independent of row order, and stay in
    fixed-width aggregation buffers, unlike DECIMAL(38, 2).
    """
    return f"CAST(CAST({price} AS DECIMAL(18,2)) * 100 AS BIGINT) * {quantity}"


def money(cents: str) -> str:
    """Whole cents as an amount (DOUBLE)."""
    return f"({cents}) / 100"


def ratio(numerator: str, denominator: str) -> str:
    """DOUBLE quotient, NULL where the denominator is 0."""
    return f"({numerator}) / nullif({denominator}, 0)"


def sum_if(condition: str, value: str = "1") -> str:
    """Sum over the matching rows; NULL, not 0, if no row matches.

    A customer without any qualifying row thereby gets NULL, as from a left
    join to a filtered aggregate.
    """
    return f"sum(CASE WHEN {condition} THEN {value} END)"


def sum_or_zero(condition: str, value: str = "1") -> str:
    return f"sum(CASE WHEN {condition} THEN {value} ELSE 0 END)"


def aggregate(df: DataFrame, keys: str | list[str], columns: Mapping[str, str]) -> DataFrame:
    """Group by ``keys``; ``columns`` maps names to aggregate expressions."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys).agg(*[F.expr(sql).alias(name) for name, sql in columns.items()])


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select("*", *[F.expr(sql).alias(name) for name, sql in columns.items()])


def fenced(df: DataFrame, key: str) -> DataFrame:
    """The same rows; what lies below is planned alike for readers of different columns.

    Spark prunes columns and moves conditions down to below a shuffle, for each reader on
    its own, after which two readers no longer share the shuffle. An expansion of
    one entry per row takes all columns and lets only conditions on ``key`` through.
    """
    others = [name for name in df.columns if name != key]
    fields = ", ".join(f"'{name}', {name}" for name in others)
    return df.selectExpr(key, f"inline(array(named_struct({fields})))").select(*df.columns)
