"""Purchase history before the recent window, and inside it.

All signals come from one aggregation of order facts by customer. The mean
gap between rows equals (last date - first date) / (rows - 1), so no window
over a customer's orders is needed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    add_columns,
    aggregate,
    days_before,
    money,
    ratio,
    sum_if,
    within_last,
)
from tidemark.functions.counted import day_counts, gap_counts

RECENT_DAYS = 90
ACTIVE_DAYS = 180

HISTORY = ""
RECENT = "_90d"


def in_period(cut: date, period: str, recent_days: int = RECENT_DAYS) -> str:
    """Order date before the recent window (HISTORY) or inside it (RECENT)."""
    return f"order_date {'<' if period == HISTORY else '>='} {days_before(cut, recent_days)}"


def successful_lines(
    facts: DataFrame, cut: date, period: str, recent_days: int = RECENT_DAYS
) -> DataFrame:
    """Successful orders of the period, as rows counted once per line (``n_lines``)."""
    rows = facts.where(f"is_successful AND n_lines > 0 AND {in_period(cut, period, recent_days)}")
    return rows.select("order_id", "customer_id", "order_date", "n_lines")


def line_gaps(facts: DataFrame, cut: date, period: str, recent_days: int = RECENT_DAYS) -> DataFrame:
    """Days from each successful line to the customer's previous one, as counted rows."""
    lines = successful_lines(facts, cut, period, recent_days)
    days = day_counts(lines, "customer_id", "order_date", "n_lines")
    return gap_counts(days, "customer_id", "order_date")


def flags(cut: date, recent_days: int = RECENT_DAYS, active_days: int = ACTIVE_DAYS) -> dict[str, str]:
    """Conditions on order facts that ``aggregates`` uses."""
    lined = {
        f"lined{period}": f"n_lines > 0 AND {in_period(cut, period, recent_days)}"
        for period in (HISTORY, RECENT)
    }
    good = {name.replace("lined", "good"): f"is_successful AND {sql}" for name, sql in lined.items()}
    active = f"is_successful AND {within_last('order_date', cut, active_days)}"
    return lined | good | {"good_active": active}


def aggregates() -> dict[str, str]:
    """Aggregates of flagged order facts by customer, for both periods."""
    columns = {"successful_orders_180": sum_if("good_active")}
    for period in (HISTORY, RECENT):
        lined, good = f"lined{period}", f"good{period}"
        columns |= {
            f"orders_count{period}": sum_if(lined),
            f"value{period}": sum_if(lined, "cents"),
            f"total_items_per_customer{period}": sum_if(lined, "qty"),
            f"succ_orders_count{period}": sum_if(good),
            f"succ_value{period}": sum_if(good, "kept_cents"),
            f"succ_min{period}": f"min(CASE WHEN {good} THEN kept_cents END)",
            f"total_succ_items_per_customer{period}": sum_if(good, "kept_qty"),
            f"succ_lines{period}": sum_if(good, "n_lines"),
            f"first_date{period}": f"min(CASE WHEN {good} THEN order_date END)",
            f"last_date{period}": f"max(CASE WHEN {good} THEN order_date END)",
        }
    return columns


def derived() -> dict[str, str]:
    """Signals of both periods from the aggregated columns."""
    columns = {}
    for p in (HISTORY, RECENT):
        count, items = f"succ_orders_count{p}", f"total_succ_items_per_customer{p}"
        columns |= {
            f"avg_interval{p}": ratio(f"datediff(last_date{p}, first_date{p})", f"succ_lines{p} - 1"),
            f"total_orders_value{p}": money(f"value{p}"),
            f"total_succ_orders_value{p}": money(f"succ_value{p}"),
            f"avg_order_value{p}": ratio(money(f"succ_value{p}"), count),
            f"min_order_value{p}": money(f"succ_min{p}"),
            f"avg_items_per_order{p}": ratio(items, count),
            f"return_cancel_orders_count{p}": f"orders_count{p} - {count}",
            f"return_cancel_orders_values{p}": money(f"value{p} - succ_value{p}"),
            f"return_cancel_orders_items{p}": f"total_items_per_customer{p} - {items}",
        }
    return columns


def profile(
    facts: DataFrame, cut: date, recent_days: int = RECENT_DAYS, active_days: int = ACTIVE_DAYS
) -> DataFrame:
    """All purchase signals, one row per customer with an order."""
    flagged = add_columns(facts, flags(cut, recent_days, active_days))
    return add_columns(aggregate(flagged, "customer_id", aggregates()), derived())


def _present(facts, cut, period, recent_days, marker, names) -> DataFrame:
    """Columns of one period, from its orders only; ``marker`` tells who has a row."""
    placed = facts.where(in_period(cut, period, recent_days))
    rows = profile(placed, cut, recent_days).where(f"{marker}{period} IS NOT NULL")
    return rows.select("customer_id", *[f"{name}{period}" for name in names])


def order_frequency(facts, cut, period, recent_days=RECENT_DAYS) -> DataFrame:
    """Mean days between successful lines; NULL for a single line."""
    return _present(facts, cut, period, recent_days, "succ_orders_count", ["avg_interval"])


def order_values(facts, cut, period, recent_days=RECENT_DAYS) -> DataFrame:
    """Number, value and items of all orders with lines."""
    names = ["orders_count", "total_orders_value", "total_items_per_customer"]
    return _present(facts, cut, period, recent_days, "orders_count", names)


def successful_order_values(facts, cut, period, recent_days=RECENT_DAYS) -> DataFrame:
    """Kept value and items of successful orders with lines."""
    names = [
        "avg_order_value",
        "min_order_value",
        "total_succ_orders_value",
        "succ_orders_count",
        "avg_items_per_order",
        "total_succ_items_per_customer",
    ]
    return _present(facts, cut, period, recent_days, "succ_orders_count", names)


def returns_and_cancels(facts, cut, period, recent_days=RECENT_DAYS) -> DataFrame:
    """All orders less the kept part of successful ones; needs a successful order."""
    names = [
        "return_cancel_orders_count",
        "return_cancel_orders_values",
        "return_cancel_orders_items",
    ]
    return _present(facts, cut, period, recent_days, "succ_orders_count", names)


def successful_orders_in(facts: DataFrame, day: date, days: int, alias: str) -> DataFrame:
    """Number of successful orders in the last ``days`` days, with or without lines."""
    recent = facts.where(f"is_successful AND {within_last('order_date', day, days)}")
    return recent.groupBy("customer_id").agg(F.count(F.lit(1)).alias(alias))


def account_age(customers: DataFrame, cut: date) -> DataFrame:
    return customers.select(
        "customer_id", F.datediff(F.lit(cut), "registration_date").alias("account_age_days")
    )
