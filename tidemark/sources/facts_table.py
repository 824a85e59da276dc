"""Order facts and session days kept as tables, a folder for each month.

Both serve the matrix and the label of any number of days. They are kept up by
rewriting the months that changed, from the raw tables; doing so twice gives the same table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.operators.facts import order_facts
from tidemark.operators.session_days import session_days
from tidemark.schema import ORDER_ITEMS, ORDERS, SESSIONS
from tidemark.sources.files import mismatch
from tidemark.sources.sinks import remove_folder, shared_folder, stored_schema

MONTH = "order_month"
VISIT_MONTH = "session_month"


def _with_month(rows: DataFrame, day: str, month: str) -> DataFrame:
    return rows.withColumn(month, F.date_format(day, "yyyy-MM"))


def _write(rows: DataFrame, month: str, path: str, mode: str = "overwrite", **options) -> None:
    """A month goes to as many files as its size asks for: Spark splits large months and keeps small ones whole."""
    rows.hint("rebalance", F.col(month)).write.mode(mode).options(**options).partitionBy(month).parquet(path)


def _read(spark: SparkSession, path: str, schema: StructType, month: str) -> DataFrame:
    """The table with its months; an error if a column is missing or of another type."""
    wanted = StructType([*schema.fields]).add(month, StringType())
    found = stored_schema(spark, path)
    if found is None:
        raise ValueError(f"{path}: no table")
    have = StructType([f for f in found.fields if f.name in wanted.names])
    wrong = mismatch(have, wanted)
    if wrong:
        raise ValueError(f"{path}: {wrong}")
    return spark.read.schema(wanted).parquet(path)


def _until(rows: DataFrame, month: str, until: date | None) -> DataFrame:
    if until is None:
        return rows
    return rows.where(F.col(month).isNull() | (F.col(month) <= until.strftime("%Y-%m")))


def _in_months(rows: DataFrame, month: str, months: list[str | None]) -> DataFrame:
    dated = F.col(month).isin([m for m in months if m is not None])
    return rows.where(dated | F.col(month).isNull() if None in months else dated)


def _replace_months(spark: SparkSession, path: str, fresh: DataFrame, month: str, months: list[str | None], staging: str | None) -> None:
    """Put ``fresh`` in place of the given months.

    Written in a folder of its own first, since it may be made from the table itself;
    months of which nothing is left are removed.
    """
    place = shared_folder(spark, staging)
    try:
        _write(fresh, month, place)
        rows = spark.read.schema(fresh.schema).parquet(place)
        left = {r[0] for r in rows.select(month).distinct().collect()}
        _write(rows, month, path, partitionOverwriteMode="dynamic")
        for gone in set(months) - left:
            remove_folder(spark, f"{path}/{month}={gone or '__HIVE_DEFAULT_PARTITION__'}")
    finally:
        remove_folder(spark, place)
    spark.catalog.refreshByPath(path)


def is_kept(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written there."""
    return stored_schema(spark, path) is not None


# --- order facts --------------------------------------------------------------


def _facts_schema(spark: SparkSession) -> StructType:
    return order_facts(spark.createDataFrame([], ORDERS), spark.createDataFrame([], ORDER_ITEMS)).schema


def write_facts(facts: DataFrame, path: str) -> None:
    """Write order facts (``order_facts``), a folder for each month of the order date."""
    _write(_with_month(facts, "order_date", MONTH), MONTH, path)


def read_facts(spark: SparkSession, path: str, until: date | None = None) -> DataFrame:
    """Order facts written before; with ``until`` only the months up to this day are read.

    A table without the columns of order facts, or with others' types, is an error.
    Orders without a date are always read.
    """
    return _until(_read(spark, path, _facts_schema(spark), MONTH), MONTH, until).drop(MONTH)


def update_facts(spark: SparkSession, path: str, orders: DataFrame, items: DataFrame, changed: DataFrame, staging: str | None = None) -> list[str | None]:
    """Bring kept facts up to date; returns the months rewritten (None: orders without a date).

    ``changed`` has the ``order_id`` of every order that is new, gone, or has another
    header, status, return or line than before; ``orders`` and ``items`` are the raw tables
    as they are now. Only the months these orders were or are in are read and written.
    """
    ids = changed.select("order_id").distinct()
    fresh = order_facts(orders.join(ids, "order_id", "left_semi"), items.join(ids, "order_id", "left_semi"))
    fresh = _with_month(fresh, "order_date", MONTH)
    kept = _read(spark, path, _facts_schema(spark), MONTH)
    touched = kept.join(ids, "order_id", "left_semi").select(MONTH).union(
        orders.join(ids, "order_id", "left_semi").select(F.date_format("order_date", "yyyy-MM"))
    )
    months = [r[0] for r in touched.distinct().collect()]
    if months:
        others = _in_months(kept, MONTH, months).join(ids, "order_id", "left_anti")
        _replace_months(spark, path, others.unionByName(fresh), MONTH, months, staging)
    return months


# --- session days -------------------------------------------------------------


def _days_schema(spark: SparkSession) -> StructType:
    return session_days(spark.createDataFrame([], SESSIONS)).schema


def write_session_days(sessions: DataFrame, path: str) -> None:
    """Write sessions as ``session_days``, a folder for each month."""
    _write(_with_month(session_days(sessions), "session_date", VISIT_MONTH), VISIT_MONTH, path)


def read_session_days(spark: SparkSession, path: str, until: date | None = None) -> DataFrame:
    """Session days written before, which stand for the sessions; with ``until`` only months up to this day."""
    return _until(_read(spark, path, _days_schema(spark), VISIT_MONTH), VISIT_MONTH, until).drop(VISIT_MONTH)


def update_session_days(spark: SparkSession, path: str, sessions: DataFrame, changed: DataFrame, staging: str | None = None) -> list[str | None]:
    """Bring kept session days up to date; returns the months rewritten.

    ``changed`` has the ``session_date`` of every session that is new, gone or other than
    before (of a moved one both days); the months of these days are made anew from the raw ``sessions``.
    """
    months = [r[0] for r in changed.select(F.date_format("session_date", "yyyy-MM")).distinct().collect()]
    if months:
        rows = _in_months(_with_month(sessions, "session_date", VISIT_MONTH), VISIT_MONTH, months)
        days = _with_month(session_days(rows), "session_date", VISIT_MONTH)
        _replace_months(spark, path, days, VISIT_MONTH, months, staging)
    return months
