"""The customer-level feature matrix as of a cut-off date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import day_literal, ratio
from tidemark.functions.counted import expand_rows
from tidemark.operators import asof, browsing, categories, purchases, recent
from tidemark.operators.facts import as_of, category_totals, order_facts, totals_of_orders
from tidemark.plans.narrow import of_few
from tidemark.schema import CATEGORIES
from tidemark.shop import Shop

_PER_PERIOD = (
    "shopping_frequency",
    "unsuccessful_orders_count",
    "succ_orders_count",
    "avg_order_value",
    "min_order_value",
    "avg_items_per_order",
    "total_succ_items_per_customer",
    "return_cancel_orders_count",
    "return_cancel_orders_values",
    "return_cancel_orders_items",
)


def feature_columns(product_categories: Sequence[str] = CATEGORIES) -> list[str]:
    """Column names of the matrix, in order."""
    return [
        "customer_id",
        "account_age_days",
        "birth_date",
        "gender",
        "city",
        "country",
        *_PER_PERIOD,
        *[f"{name}_90d" for name in _PER_PERIOD],
        "last_suc_order_interval",
        "last_succ_kept_order_total",
        "last_succ_kept_order_items",
        "last_succ_order_items",
        "last_succ_order_total",
        "days_from_last_return",
        "last_return_total",
        "last_returned_items",
        "days_from_last_cancel",
        "last_cancel_items",
        "last_cancel_total",
        "avg_last3_succ_interval",
        "last3_succ_orders_kept_items_total",
        "last3_succ_orders_kept_total",
        "last3_succ_orders_total",
        "last3_succ_orders_items",
        "last3_return_cancel_order_total",
        "last3_kept_total",
        "last3_cancels_returns_items",
        "last3_kept_items",
        *[name for c in product_categories for name in categories.kept_names(c)],
        *[name for c in product_categories for name in categories.returned_names(c)],
        "discounted_items_total",
        "total_180days_sessions",
        "avg_pages_viewed_180",
        "min_pages_viewed_180",
        "mobile_sessions_count_180",
        "desktop_sessions_count_180",
        "sessions_to_succ_orders_180days",
        "sessions_90d",
        "avg_pages_90d",
        "days_from_last_session",
        "last_session_pages_viewed",
        "avg_session_interval",
    ]


def feature_matrix(
    shop: Shop,
    cut: date,
    product_categories: Sequence[str] = CATEGORIES,
    per_line_days: bool = True,
    one_row_per_customer: bool = False,
    facts: DataFrame | None = None,
    recent_days: int = purchases.RECENT_DAYS,
    active_days: int = purchases.ACTIVE_DAYS,
    last_orders: int = recent.LAST_K,
    few_registered: bool = False,
) -> DataFrame:
    """One row per customer registered before ``cut``, 98 columns by default.

    ``per_line_days``: count the days since the last order, return and
    cancellation once per line of that order. ``one_row_per_customer``: of
    several sessions on the last day keep the highest session id; otherwise
    the customer gets a row for each. ``facts``: order facts
    kept as a table; without, lines are aggregated here. ``recent_days``,
    ``active_days``, ``last_orders``: the windows and the number of last orders;
    column names keep the usual 90, 180 and 3. ``few_registered``: few of the
    customers with orders or sessions are registered before the cut; the others' rows
    are dropped by a broadcast filter of keys where they are read.

    Customers' orders and sessions are not semi-joined to the customers first:
    the final left joins drop what belongs to nobody.
    """
    customers = asof.customers_before(shop.customers, cut)
    if few_registered:
        shop, facts = of_few(shop, customers, facts)
    sessions = asof.sessions_before(shop.sessions, cut)
    totals_by_category = category_totals(shop.order_items, shop.products)
    if facts is None:
        facts = order_facts(shop.orders, None, totals=totals_of_orders(totals_by_category))
    known = as_of(facts, cut)

    totals = purchases.profile(known, cut, recent_days, active_days)
    spending = categories.profile(
        categories.by_category(asof.orders_before(shop.orders, cut), totals_by_category, cut),
        product_categories,
    )
    newest = recent.profile(known, cut, k=last_orders, per_line_days=per_line_days)
    visits, last_visits = browsing.profile_and_last_day(
        sessions, cut, active_days, recent_days, single=one_row_per_customer
    )

    wide = customers
    for part in (totals, spending, newest, visits):
        wide = wide.join(part, "customer_id", "left")
    # Only the narrow rows of the last visits are multiplied and travel for it. They are the left side, which
    # AQE can split where one customer has very many.
    narrow = customers.select("customer_id").join(last_visits, "customer_id", "left")
    if not one_row_per_customer:
        narrow = expand_rows(narrow.withColumn("n", F.coalesce("n", F.lit(1))), "n")
    joined = narrow.join(wide, "customer_id", "left")
    computed = {
        "account_age_days": f"datediff({day_literal(cut)}, registration_date)",
        "shopping_frequency": "1 / nullif(avg_interval, 0)",
        "shopping_frequency_90d": "1 / nullif(avg_interval_90d, 0)",
        "unsuccessful_orders_count": "return_cancel_orders_count",
        "unsuccessful_orders_count_90d": "return_cancel_orders_count_90d",
        "sessions_to_succ_orders_180days": ratio("successful_orders_180", "total_180days_sessions"),
    }
    return joined.selectExpr(
        *[
            f"{computed[name]} AS {name}" if name in computed else categories.quoted(name)
            for name in feature_columns(product_categories)
        ]
    )
