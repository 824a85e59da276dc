"""The last successful order, return and cancellation, and the last three orders.

Each is a top-k per customer with the position filter directly on the window,
so Spark discards all but k rows per customer and map task before it shuffles.
Line totals are carried along; nothing is joined back.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import add_columns, aggregate, day_literal, money, ratio, sum_if
from tidemark.functions.counted import top_rows
from tidemark.schema import CANCELLED, RETURNED

LAST_K = 3

# Returned as of the cut, with lines, none of them kept.
FULL_RETURN = f"status = '{RETURNED}' AND n_lines > 0 AND kept_lines = 0"
CANCEL = f"status = '{CANCELLED}'"


def _newest(day: str) -> list[Column]:
    return [F.col(day).desc_nulls_last(), F.col("order_id").desc()]


def _days_since(cut: date, day: str) -> str:
    return f"datediff({day_literal(cut)}, {day})"


def _counted_days(cut: date, day: str, per_line_days: bool) -> str:
    """Days counted once per order line, as the source signals do, or once."""
    days = _days_since(cut, day)
    return f"{days} * n_lines" if per_line_days else f"CAST({days} AS BIGINT)"


def _lost(total: str, kept: str) -> str:
    """Part of an order's total lost to a cancellation or to returned lines."""
    return f"""
        CASE status WHEN '{CANCELLED}' THEN {total} WHEN '{RETURNED}' THEN {total} - {kept} ELSE 0 END"""


def _newest_successful(facts: DataFrame, k: int) -> DataFrame:
    return top_rows(facts.where("is_successful"), "customer_id", _newest("order_date"), k)


def _newest_full_return(facts: DataFrame) -> DataFrame:
    return top_rows(facts.where(FULL_RETURN), "customer_id", _newest("status_date"), 1)


# --- one operator at a time -------------------------------------------------


def last_successful_order(facts: DataFrame, cut: date) -> DataFrame:
    """The latest successful order, with or without lines."""
    days = _days_since(cut, "order_date")
    return _newest_successful(facts, 1).selectExpr(
        "customer_id", "order_id", f"{days} AS last_successful_date"
    )


def last_successful_stats(facts: DataFrame, cut: date, per_line_days: bool = True) -> DataFrame:
    """Totals of the latest successful order, if it has lines."""
    days = _counted_days(cut, "order_date", per_line_days)
    return (
        _newest_successful(facts, 1)
        .where("n_lines > 0")
        .selectExpr(
            "customer_id",
            f"{days} AS last_suc_order_interval",
            f"{money('kept_cents')} AS last_succ_kept_order_total",
            "kept_qty AS last_succ_kept_order_items",
            "qty AS last_succ_order_items",
            f"{money('cents')} AS last_succ_order_total",
        )
    )


def full_return_orders(facts: DataFrame) -> DataFrame:
    return facts.where(FULL_RETURN).selectExpr(
        "order_id", "customer_id", "status_date", f"{money('cents')} AS full_return_total"
    )


def last_return_date(facts: DataFrame) -> DataFrame:
    return _newest_full_return(facts).selectExpr(
        "customer_id", "order_id", "status_date AS return_date"
    )


def last_return_order(facts: DataFrame, cut: date) -> DataFrame:
    return _newest_full_return(facts).selectExpr(
        "customer_id",
        "order_id",
        f"{_days_since(cut, 'status_date')} AS days_from_last_return",
        f"{money('cents')} AS full_return_total",
    )


def last_return_stats(facts: DataFrame, cut: date, per_line_days: bool = True) -> DataFrame:
    return _newest_full_return(facts).selectExpr(
        "customer_id",
        f"{_counted_days(cut, 'status_date', per_line_days)} AS days_from_last_return",
        f"{money('cents - kept_cents')} AS last_return_total",
        "qty - kept_qty AS last_returned_items",
    )


def last_cancel_order(orders: DataFrame, cut: date) -> DataFrame:
    """The latest cancelled order; needs order headers only."""
    newest = top_rows(orders.where(CANCEL), "customer_id", _newest("status_date"), 1)
    return newest.selectExpr(
        "customer_id", "order_id", f"{_days_since(cut, 'status_date')} AS days_from_last_cancel"
    )


def last_cancel_stats(facts: DataFrame, cut: date, per_line_days: bool = True) -> DataFrame:
    newest = top_rows(facts.where(CANCEL), "customer_id", _newest("status_date"), 1)
    return newest.where("n_lines > 0").selectExpr(
        "customer_id",
        f"{_counted_days(cut, 'status_date', per_line_days)} AS days_from_last_cancel",
        "qty AS last_cancel_items",
        f"{money('cents')} AS last_cancel_total",
    )


def last_orders(orders: DataFrame, k: int = LAST_K) -> DataFrame:
    """The last ``k`` orders of any status; needs order headers only."""
    return top_rows(orders, "customer_id", _newest("order_date"), k).select(
        "customer_id", "order_id", "order_date", "status", "rn"
    )


def last_successful_orders(facts: DataFrame, k: int = LAST_K) -> DataFrame:
    return last_orders(facts.where("is_successful"), k)


def last_successful_details(facts: DataFrame, k: int = LAST_K) -> DataFrame:
    """Totals of each of the last ``k`` successful orders that has lines, and
    the days since the one before among them."""
    previous = "lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id)"
    return (
        _newest_successful(facts, k)
        .where("n_lines > 0")
        .selectExpr(
            "customer_id",
            "order_id",
            f"{money('kept_cents')} AS last3_succ_kept_total",
            "kept_qty AS last3_succ_kept_items",
            f"{money('cents')} AS total_value",
            "qty AS total_items",
            f"datediff(order_date, {previous}) AS interval_days",
        )
    )


def _successful_totals(among: str) -> dict[str, str]:
    return {
        "newest_span": f"""
            datediff(max(CASE WHEN {among} THEN order_date END),
                     min(CASE WHEN {among} THEN order_date END))""",
        "newest_orders": sum_if(among),
        "last3_succ_orders_kept_items_total": sum_if(among, "kept_qty"),
        "newest_kept_cents": sum_if(among, "kept_cents"),
        "newest_cents": sum_if(among, "cents"),
        "last3_succ_orders_items": sum_if(among, "qty"),
    }


SUCCESSFUL_DERIVED = {
    "avg_last3_succ_interval": ratio("newest_span", "newest_orders - 1"),
    "last3_succ_orders_kept_total": money("newest_kept_cents"),
    "last3_succ_orders_total": money("newest_cents"),
}


def last_successful_summary(facts: DataFrame, k: int = LAST_K) -> DataFrame:
    """Mean gap and totals over the last ``k`` successful orders that have lines."""
    newest = _newest_successful(facts, k).where("n_lines > 0")
    totals = aggregate(newest, "customer_id", _successful_totals("true"))
    return add_columns(totals, SUCCESSFUL_DERIVED).select(
        "customer_id",
        *SUCCESSFUL_DERIVED,
        "last3_succ_orders_kept_items_total",
        "last3_succ_orders_items",
    )


def _any_totals(among: str) -> dict[str, str]:
    return {
        "lost_cents": sum_if(among, _lost("cents", "kept_cents")),
        "all_cents": sum_if(among, "cents"),
        "lost_qty": sum_if(among, _lost("qty", "kept_qty")),
        "all_qty": sum_if(among, "qty"),
    }


ANY_DERIVED = {
    "last3_return_cancel_order_total": money("lost_cents"),
    "last3_kept_total": money("all_cents - lost_cents"),
    "last3_cancels_returns_items": "lost_qty",
    "last3_kept_items": "all_qty - lost_qty",
}


def _newest_totals(facts: DataFrame, k: int) -> DataFrame:
    newest = top_rows(facts, "customer_id", _newest("order_date"), k).where("n_lines > 0")
    return aggregate(newest, "customer_id", _any_totals("true"))


def last_orders_losses(facts: DataFrame, k: int = LAST_K) -> DataFrame:
    """Lost and total value and items over the last ``k`` orders of any status."""
    return _newest_totals(facts, k).selectExpr(
        "customer_id",
        f"{money('lost_cents')} AS return_cancel_order_total",
        f"{money('all_cents')} AS last_3orders_total",
        "lost_qty AS return_cancel_order_items",
        "all_qty AS last_3orders_items",
    )


def last_orders_summary(facts: DataFrame, k: int = LAST_K) -> DataFrame:
    """Lost and kept value and items over the last ``k`` orders of any status."""
    return add_columns(_newest_totals(facts, k), ANY_DERIVED).select("customer_id", *ANY_DERIVED)


# --- all of them in one pass ------------------------------------------------


def profile(facts: DataFrame, cut: date, k: int = LAST_K, per_line_days: bool = True) -> DataFrame:
    """All signals of this module, one row per customer with an order.

    Each order enters one of two timelines by order date (successful or other)
    and, if it was returned in full or cancelled, a second one by status date.
    One top-k over (customer, timeline) serves every signal: the last ``k``
    orders of any status are among the last ``k`` of the two first timelines.
    """
    timelines = f"""
        inline(array(
            struct(if(is_successful, 'success', 'other') AS timeline, order_date AS event_date),
            struct(CASE WHEN {FULL_RETURN} THEN 'return' WHEN {CANCEL} THEN 'cancel' END AS timeline,
                   status_date AS event_date)))"""
    carried = ["customer_id", "order_id", "order_date", "status"]
    carried += ["n_lines", "qty", "kept_qty", "cents", "kept_cents"]
    events = facts.selectExpr(*carried, timelines).where("timeline IS NOT NULL")
    newest = top_rows(events, ["customer_id", "timeline"], _newest("event_date"), k)

    placed = F.col("timeline").isin("success", "other")
    overall = Window.partitionBy("customer_id").orderBy(placed.desc(), *_newest("event_date"))
    newest = newest.withColumn("overall", F.row_number().over(overall))

    days = _counted_days(cut, "event_date", per_line_days)
    flagged = newest.selectExpr(
        "*",
        "n_lines > 0 AND timeline = 'success' AND rn = 1 AS last_success",
        "n_lines > 0 AND timeline = 'return' AND rn = 1 AS last_return",
        "n_lines > 0 AND timeline = 'cancel' AND rn = 1 AS last_cancel",
        "n_lines > 0 AND timeline = 'success' AS newest_success",
        f"n_lines > 0 AND timeline IN ('success', 'other') AND overall <= {k} AS newest_any",
        f"{days} AS days",
    )
    totals = aggregate(
        flagged,
        "customer_id",
        {
            "last_suc_order_interval": sum_if("last_success", "days"),
            "last_success_kept_cents": sum_if("last_success", "kept_cents"),
            "last_succ_kept_order_items": sum_if("last_success", "kept_qty"),
            "last_succ_order_items": sum_if("last_success", "qty"),
            "last_success_cents": sum_if("last_success", "cents"),
            "days_from_last_return": sum_if("last_return", "days"),
            "last_return_cents": sum_if("last_return", "cents - kept_cents"),
            "last_returned_items": sum_if("last_return", "qty - kept_qty"),
            "days_from_last_cancel": sum_if("last_cancel", "days"),
            "last_cancel_items": sum_if("last_cancel", "qty"),
            "last_cancel_cents": sum_if("last_cancel", "cents"),
            **_successful_totals("newest_success"),
            **_any_totals("newest_any"),
        },
    )
    amounts = {
        "last_succ_kept_order_total": money("last_success_kept_cents"),
        "last_succ_order_total": money("last_success_cents"),
        "last_return_total": money("last_return_cents"),
        "last_cancel_total": money("last_cancel_cents"),
    }
    return add_columns(totals, amounts | SUCCESSFUL_DERIVED | ANY_DERIVED)
