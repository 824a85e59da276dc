"""The three-class engagement label."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from tidemark.operators import asof, engagement
from tidemark.operators.facts import order_facts
from tidemark.plans.narrow import of_few
from tidemark.schema import ACTIVE, AT_RISK, CHURNED
from tidemark.shop import Shop

# Fixed thresholds of the label.
LOW_PAGES = 3
LARGE_ORDER = 5
USUAL_DAYS = engagement.LONG_DAYS


def label(
    low_pages: int = LOW_PAGES, large_order: int = LARGE_ORDER, usual_days: int = USUAL_DAYS
) -> str:
    """First matching rule; a rule with a NULL operand does not match."""
    gone = f"coalesce(successful_orders_120, 0) = 0 AND coalesce(pages_last_60, 0) < {low_pages}"
    small_last_order = f"last_suc_order_total < {large_order} * avg_order_value"
    large_recent_orders = f"coalesce(total_30_60, 0) >= {large_order} * avg_order_value"
    bought_30_60 = "coalesce(successful_orders_60, 0) > 0 AND coalesce(successful_orders_30, 0) = 0"
    return f"""
        CASE WHEN {gone} AND median_interval < {usual_days} AND {small_last_order} THEN '{CHURNED}'
             WHEN coalesce(successful_orders_30, 0) > 0 THEN '{ACTIVE}'
             WHEN {bought_30_60} AND {large_recent_orders} THEN '{ACTIVE}'
             WHEN {bought_30_60} AND coalesce(pages_last_60, 0) >= {low_pages} THEN '{ACTIVE}'
             WHEN days_since_last_successful_order <= median_interval
                  AND days_since_last_session <= median_session_interval THEN '{ACTIVE}'
             ELSE '{AT_RISK}' END"""


def engagement_target(
    shop: Shop,
    cut: date,
    last: date,
    facts: DataFrame | None = None,
    low_pages: int = LOW_PAGES,
    large_order: int = LARGE_ORDER,
    usual_days: int = USUAL_DAYS,
    few_registered: bool = False,
) -> DataFrame:
    """(customer_id, target) for customers registered before ``cut``, as of ``last``.

    ``facts``: order facts kept as a table; without, lines are aggregated here.
    The thresholds are those of ``label``. ``few_registered``: few of the customers
    with orders or sessions are registered before the cut.
    """
    customers = asof.customers_before(shop.customers, cut).select("customer_id")
    if few_registered:
        shop, facts = of_few(shop, customers, facts)
    if facts is None:
        facts = order_facts(shop.orders, shop.order_items)
    return (
        customers.join(engagement.order_profile(facts, last), "customer_id", "left")
        .join(engagement.session_profile(shop.sessions, last), "customer_id", "left")
        .selectExpr("customer_id", f"{label(low_pages, large_order, usual_days)} AS target")
    )
