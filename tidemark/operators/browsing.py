"""Browsing activity before the cut.

Counts, means and gaps come from one aggregation of sessions by customer; the
mean gap is (last date - first date) / (sessions - 1).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    add_columns,
    aggregate,
    day_literal,
    fenced,
    ratio,
    sum_if,
    sum_or_zero,
    within_last,
)
from tidemark.functions.counted import top_rows
from tidemark.operators.purchases import ACTIVE_DAYS, RECENT_DAYS, successful_orders_in
from tidemark.operators.session_days import counted_sessions
from tidemark.schema import DESKTOP, MOBILE


def _on(device: str) -> str:
    """Sessions on a device; 0 if there are only others, NULL if there are none."""
    return sum_if("active", f"CASE WHEN device = '{device}' THEN n ELSE 0 END")


def _mean_pages(condition: str) -> str:
    return ratio(sum_if(condition, "pages_viewed * n"), sum_if(f"{condition} AND pages_viewed IS NOT NULL", "n"))


AGGREGATES = {
    "session_date": "max(CASE WHEN active THEN day END)",
    "total_180days_sessions": sum_if("active", "n"),
    "avg_pages_viewed_180": _mean_pages("active"),
    "min_pages_viewed_180": "min(CASE WHEN active THEN pages_viewed END)",
    "mobile_sessions_count_180": _on(MOBILE),
    "desktop_sessions_count_180": _on(DESKTOP),
    "sessions_90d": sum_if("recent", "n"),
    "avg_pages_90d": _mean_pages("recent"),
    "all_days": "datediff(max(day), min(day))",
    "all_sessions": sum_or_zero("day IS NOT NULL", "n"),
}

# The same from sessions summed by day and pages (``profile_and_last_day``).
AGGREGATES_OF_GROUPS = AGGREGATES | {
    "session_date": "max(CASE WHEN active THEN near_day END)",
    "mobile_sessions_count_180": sum_if("active", "n_mobile"),
    "desktop_sessions_count_180": sum_if("active", "n_desktop"),
    "all_days": "datediff(max(last_day), min(first_day))",
    "all_sessions": "sum(n_dated)",
}


def _flagged(sessions: DataFrame, cut: date, active_days: int, recent_days: int) -> DataFrame:
    return counted_sessions(sessions).selectExpr(
        "customer_id",
        "session_date AS day",
        "device",
        "pages_viewed",
        "n",
        "last_id",
        f"{within_last('session_date', cut, active_days)} AS active",
        f"{within_last('session_date', cut, recent_days)} AS recent",
    )


def _with_interval(totals: DataFrame) -> DataFrame:
    return add_columns(totals, {"avg_session_interval": ratio("all_days", "all_sessions - 1")})


def profile(
    sessions: DataFrame, cut: date, active_days: int = ACTIVE_DAYS, recent_days: int = RECENT_DAYS
) -> DataFrame:
    """All signals from counts of sessions before the cut, one row per customer."""
    return _with_interval(aggregate(_flagged(sessions, cut, active_days, recent_days), "customer_id", AGGREGATES))


def profile_and_last_day(
    sessions: DataFrame,
    cut: date,
    active_days: int = ACTIVE_DAYS,
    recent_days: int = RECENT_DAYS,
    single: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``profile`` and ``last_day_sessions`` (or ``last_single_session``) from one scan of sessions.

    Sessions of the longer window are summed by customer, day and number of pages, all
    earlier ones of a customer as one group; day and pages being known, a few counts per
    group give every signal. Groups are dealt by customer once, for both results.
    """
    near = within_last("session_date", cut, max(active_days, recent_days))
    rows = counted_sessions(sessions).where("customer_id IS NOT NULL").selectExpr(
        "*", f"CASE WHEN {near} THEN session_date END AS near_day", f"CASE WHEN {near} THEN pages_viewed END AS near_pages"
    )
    counts = {
        "n": "sum(n)",
        "n_mobile": sum_or_zero(f"device = '{MOBILE}'", "n"),
        "n_desktop": sum_or_zero(f"device = '{DESKTOP}'", "n"),
        "n_dated": sum_or_zero("session_date IS NOT NULL", "n"),
        "first_day": "min(session_date)",
        "last_day": "max(session_date)",
        **({"last_id": "max(last_id)"} if single else {}),
    }
    groups = aggregate(rows, ["customer_id", "near_day", "near_pages"], counts)
    groups = fenced(groups.repartition("customer_id"), "customer_id").selectExpr(
        "*",
        f"{within_last('near_day', cut, active_days)} AS active",
        f"{within_last('near_day', cut, recent_days)} AS recent",
    )
    totals = aggregate(groups.withColumnsRenamed({"near_pages": "pages_viewed"}), "customer_id", AGGREGATES_OF_GROUPS)
    counted = groups.where("active").withColumnsRenamed({"near_day": "session_date", "near_pages": "pages_viewed"})
    return _with_interval(totals), _newest_single(counted, cut) if single else _newest_day(counted, cut)


def _profile_of_last(sessions: DataFrame, cut: date, days: int) -> DataFrame:
    """``profile`` over the sessions of the last ``days`` days only."""
    return profile(sessions.where(within_last("session_date", cut, days)), cut)


def last_session(sessions: DataFrame, cut: date) -> DataFrame:
    """Date of the last session in the last 180 days."""
    return _profile_of_last(sessions, cut, ACTIVE_DAYS).select("customer_id", "session_date")


def sessions_180_stats(sessions: DataFrame, cut: date) -> DataFrame:
    return _profile_of_last(sessions, cut, ACTIVE_DAYS).select(
        "customer_id",
        "total_180days_sessions",
        "avg_pages_viewed_180",
        "min_pages_viewed_180",
        "mobile_sessions_count_180",
        "desktop_sessions_count_180",
    )


def recent_sessions(sessions: DataFrame, cut: date) -> DataFrame:
    return _profile_of_last(sessions, cut, RECENT_DAYS).select(
        "customer_id", "sessions_90d", "avg_pages_90d"
    )


def session_intervals(sessions: DataFrame, cut: date) -> DataFrame:
    """Mean days between sessions, for customers with at least two."""
    rows = profile(sessions, cut).where("avg_session_interval IS NOT NULL")
    return rows.select("customer_id", "avg_session_interval")


def sessions_orders_ratio(sessions: DataFrame, facts: DataFrame, cut: date) -> DataFrame:
    """Successful orders per session in the last 180 days, where there are both."""
    orders = successful_orders_in(facts, cut, ACTIVE_DAYS, "successful_orders_180")
    per_session = ratio("successful_orders_180", "total_180days_sessions")
    return orders.join(sessions_180_stats(sessions, cut), "customer_id").selectExpr(
        "customer_id", f"{per_session} AS sessions_to_succ_orders_180days"
    )


def last_day_sessions(sessions: DataFrame, cut: date, active_days: int = ACTIVE_DAYS) -> DataFrame:
    """Sessions on the customer's last day within 180 days, as counted rows
    (customer_id, days_from_last_session, last_session_pages_viewed, n).

    Sessions are counted by (customer, day, pages) before they are ranked, so a
    day with very many sessions reaches the ranking as few rows.
    """
    active = counted_sessions(sessions).where(within_last("session_date", cut, active_days))
    keys = ["customer_id", "session_date", "pages_viewed"]
    return _newest_day(aggregate(active, keys, {"n": "sum(n)"}), cut)


def last_single_session(sessions: DataFrame, cut: date, active_days: int = ACTIVE_DAYS) -> DataFrame:
    """As ``last_day_sessions``, with only the highest session id of that day."""
    active = counted_sessions(sessions).where(within_last("session_date", cut, active_days))
    return _newest_single(active, cut)


def _newest_day(counted: DataFrame, cut: date) -> DataFrame:
    newest = Window.partitionBy("customer_id").orderBy(F.col("session_date").desc())
    ranked = counted.withColumn("_rank", F.rank().over(newest)).where(F.col("_rank") == 1)
    return _last_visit(ranked, cut, "n")


def _newest_single(counted: DataFrame, cut: date) -> DataFrame:
    newest = [F.col("session_date").desc(), F.col("last_id").desc()]
    return _last_visit(top_rows(counted, "customer_id", newest, 1), cut, "1L AS n")


def _last_visit(rows: DataFrame, cut: date, count: str) -> DataFrame:
    return rows.selectExpr(
        "customer_id",
        f"datediff({day_literal(cut)}, session_date) AS days_from_last_session",
        "pages_viewed AS last_session_pages_viewed",
        count,
    )
