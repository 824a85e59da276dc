"""Parts of the engagement label as of a later date.

``facts`` are order facts with raw statuses and without a date bound;
``last`` is the date of the label. Medians are lower medians.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    add_columns,
    aggregate,
    day_literal,
    fenced,
    money,
    ratio,
    sum_if,
    sum_or_zero,
    within_last,
)
from tidemark.functions.counted import (
    block_medians,
    day_blocks,
    day_counts,
    expand_rows,
    gap_counts,
    gap_median,
    rank_counts,
    top_rows,
)
from tidemark.operators.purchases import successful_orders_in
from tidemark.operators.session_days import counted_sessions

SHORT_DAYS = 30
MIDDLE_DAYS = 60
LONG_DAYS = 120


def successful_orders(facts: DataFrame) -> DataFrame:
    return facts.where("is_successful").select("order_id", "customer_id", "order_date", "status")


def successful_orders_last(facts: DataFrame, last: date, days: int) -> DataFrame:
    return successful_orders_in(facts, last, days, f"successful_orders_{days}")


def _middle_orders(facts: DataFrame, last: date) -> DataFrame:
    middle = within_last("order_date", last, MIDDLE_DAYS, SHORT_DAYS)
    return facts.where(f"is_successful AND n_lines > 0 AND {middle}")


def orders_30_60(facts: DataFrame, last: date) -> DataFrame:
    """Kept value of each successful order with lines, 30 to 60 days ago."""
    return _middle_orders(facts, last).selectExpr(
        "customer_id", "order_id", f"{money('kept_cents')} AS order_total"
    )


def sum_orders_30_60(facts: DataFrame, last: date) -> DataFrame:
    total = {"total_30_60": money("sum(kept_cents)")}
    return aggregate(_middle_orders(facts, last), "customer_id", total)


def _last_successful(facts: DataFrame) -> DataFrame:
    newest = [F.col("order_date").desc_nulls_last(), F.col("order_id").desc()]
    return top_rows(facts.where("is_successful"), "customer_id", newest, 1)


def last_successful_order(facts: DataFrame) -> DataFrame:
    """The latest successful order; of several on one day the highest order id."""
    return _last_successful(facts).select(
        "customer_id", "order_id", F.col("order_date").alias("last_suc_date")
    )


def last_successful_total(facts: DataFrame) -> DataFrame:
    """Kept value of the latest successful order, if it has lines."""
    rows = _last_successful(facts).where("n_lines > 0")
    return rows.selectExpr("customer_id", f"{money('kept_cents')} AS last_suc_order_total")


def days_since_successful(facts: DataFrame, last: date) -> DataFrame:
    return last_successful_order(facts).selectExpr(
        "customer_id",
        f"datediff({day_literal(last)}, last_suc_date) AS days_since_last_successful_order",
    )


def orders_excluding_last(facts: DataFrame) -> DataFrame:
    """Successful orders except all those on the customer's last such date.

    The anti-join is on customer and date, which spreads a customer's orders.
    """
    good = facts.where("is_successful").select("customer_id", "order_id", "order_date")
    newest = last_successful_order(facts).select(
        "customer_id", F.col("last_suc_date").alias("order_date")
    )
    return good.join(newest, ["customer_id", "order_date"], "left_anti").select(good.columns)


def order_days(facts: DataFrame) -> DataFrame:
    """Successful orders by (customer, day), with what the label needs of them."""
    return aggregate(
        facts.where("is_successful"),
        ["customer_id", "order_date"],
        {
            "n": "count(1)",
            "n_lined": sum_or_zero("n_lines > 0"),
            "kept_cents": "sum(kept_cents)",
            "last_cents": "max_by(CASE WHEN n_lines > 0 THEN kept_cents END, order_id)",
        },
    )


def order_profile(facts: DataFrame, last: date) -> DataFrame:
    """All order signals of the label, one row per customer with a successful order.

    Totals and the median both read the orders summed by day, dealt by customer once.
    """
    named = facts.where("customer_id IS NOT NULL")
    by_day = fenced(order_days(named).repartition("customer_id"), "customer_id")
    middle = within_last("order_date", last, MIDDLE_DAYS, SHORT_DAYS)
    counts = {
        f"successful_orders_{n}": sum_if(within_last("order_date", last, n), "n")
        for n in (SHORT_DAYS, MIDDLE_DAYS, LONG_DAYS)
    }
    totals = aggregate(
        by_day,
        "customer_id",
        counts
        | {
            "total_30_60": money(sum_if(f"n_lined > 0 AND {middle}", "kept_cents")),
            # A customer with undated orders only has its last order among them.
            "last_suc_order_total": money(
                "CASE WHEN max(order_date) IS NULL THEN max(last_cents) ELSE max_by(last_cents, order_date) END"
            ),
            "last_suc_date": "max(order_date)",
            "earlier_value": money("sum(kept_cents) - coalesce(max_by(kept_cents, order_date), 0)"),
            "earlier_orders": "sum(n_lined) - coalesce(max_by(n_lined, order_date), 0)",
        },
    )
    signals = add_columns(
        totals,
        {
            "avg_order_value": ratio("earlier_value", "earlier_orders"),
            "days_since_last_successful_order": f"datediff({day_literal(last)}, last_suc_date)",
        },
    )
    gaps = gap_counts(by_day.where("order_date IS NOT NULL"), "customer_id", "order_date")
    return signals.join(gap_median(gaps, "customer_id", "median_interval"), "customer_id", "left")


def average_excluding_last(facts: DataFrame, last: date) -> DataFrame:
    """Mean kept value of the earlier successful orders that have lines."""
    rows = order_profile(facts, last).where("avg_order_value IS NOT NULL")
    return rows.select("customer_id", "avg_order_value")


def order_gaps(facts: DataFrame) -> DataFrame:
    """Days between consecutive successful orders, as counted rows."""
    days = day_counts(facts.where("is_successful"), "customer_id", "order_date")
    return gap_counts(days, "customer_id", "order_date")


def session_gaps(sessions: DataFrame) -> DataFrame:
    """Days between consecutive sessions, as counted rows."""
    days = day_counts(counted_sessions(sessions), "customer_id", "session_date", "n")
    return gap_counts(days, "customer_id", "session_date")


def known_gaps(gaps: DataFrame) -> DataFrame:
    """Counted gaps without the NULL of each customer's first row."""
    return gaps.where("interval_days IS NOT NULL")


def ranked_intervals(gaps: DataFrame) -> DataFrame:
    """One row per known interval with its position and the customer's number of them."""
    counts = aggregate(known_gaps(gaps), ["customer_id", "interval_days"], {"n": "sum(n)"})
    rows = expand_rows(rank_counts(counts, "customer_id", "interval_days"), "n", index="copy")
    return rows.selectExpr("customer_id", "interval_days", "before + copy AS rn", "cnt")


def median_order_interval(facts: DataFrame, last: date) -> DataFrame:
    rows = order_profile(facts, last).where("median_interval IS NOT NULL")
    return rows.select("customer_id", "median_interval")


def session_profile(sessions: DataFrame, last: date) -> DataFrame:
    """All session signals of the label, one row per customer with a session.

    Sessions are summed by customer and block of days, their days as bits, in a plain
    hash aggregation; the few blocks of a customer then give the totals and the median.
    """
    recent = within_last("session_date", last, MIDDLE_DAYS)
    sums = {"pages_last_60": sum_if(recent, "pages_viewed * n"), "last_session_date": "max(session_date)"}
    blocks = day_blocks(counted_sessions(sessions), "customer_id", "session_date", "n", sums)
    totals = {"pages_last_60": "sum(pages_last_60)", "last_session_date": "max(last_session_date)"}
    signals = block_medians(blocks, "customer_id", "median_session_interval", totals)
    since = f"datediff({day_literal(last)}, last_session_date)"
    return add_columns(signals, {"days_since_last_session": since})


def pages_last_60(sessions: DataFrame, last: date) -> DataFrame:
    recent = counted_sessions(sessions).where(within_last("session_date", last, MIDDLE_DAYS))
    return aggregate(recent, "customer_id", {"pages_last_60": "sum(pages_viewed * n)"})


def last_session(sessions: DataFrame) -> DataFrame:
    return aggregate(sessions, "customer_id", {"last_session_date": "max(session_date)"})


def days_since_session(sessions: DataFrame, last: date) -> DataFrame:
    return last_session(sessions).selectExpr(
        "customer_id", f"datediff({day_literal(last)}, last_session_date) AS days_since_last_session"
    )


def median_session_interval(sessions: DataFrame, last: date) -> DataFrame:
    rows = session_profile(sessions, last).where("median_session_interval IS NOT NULL")
    return rows.select("customer_id", "median_session_interval")
