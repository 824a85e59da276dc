"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark import Shop, engagement_target, feature_matrix
from tidemark.functions.counted import expand_rows
from tidemark.operators import asof, browsing, categories, engagement, purchases, recent
from tidemark.operators.facts import as_of, category_totals, order_facts
from tidemark.operators.purchases import HISTORY, RECENT
from tidemark.schema import ORDER_ITEMS
from tidemark.sources import files, sinks
from tidemark.sources.star import read_star

# 181 days apart; the driver's orders run up to the second date.
CUT = date(2001, 2, 1)
LAST = date(2001, 8, 1)

ShopQuery = Callable[[SparkSession, Shop, date, date], DataFrame]


def _doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE, as the oracle returns them."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in decimals})


# --- inputs of the operators -------------------------------------------------
#
# Signals are aggregated for all customers and only then restricted to the
# registered ones (``_mine``): a join by customer before the aggregation would
# bring all rows of one customer into one task.


def _buyers(shop, cut):
    return asof.customers_before(shop.customers, cut)


def _mine(rows, shop, cut):
    return asof.of_customers(rows, _buyers(shop, cut))


def _placed(shop, cut):
    return _mine(asof.orders_before(shop.orders, cut), shop, cut)


def _headers(shop, cut):
    return asof.order_level(asof.orders_before(shop.orders, cut), cut)


def _visits(shop, cut):
    return asof.sessions_before(shop.sessions, cut)


def _raw_facts(shop, since=None):
    return order_facts(shop.orders, shop.order_items, since)


def _facts(shop, cut, days=None):
    """Order facts as of the cut, of the last ``days`` days before it if given."""
    return as_of(_raw_facts(shop, days and cut - timedelta(days=days)), cut)


def _by_category(shop, cut):
    orders = asof.orders_before(shop.orders, cut)
    return categories.by_category(orders, category_totals(shop.order_items, shop.products), cut)


# --- sources and sinks --------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A folder for a table that a query writes and reads again; it goes when the process ends.

    Where the session names no shared folder, as in tests, a temporary one is given.
    """
    own = None if spark.conf.get("spark.checkpoint.dir", None) else tempfile.mkdtemp(prefix="tidemark-")
    path = sinks.shared_folder(spark, own)

    def remove() -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            sinks.remove_folder(spark, path)

    atexit.register(remove)
    return path


def csv_roundtrip(spark, shop, cut, last):
    path = _folder(spark)
    sinks.write_csv(shop.order_items, path)
    return _doubles(files.read_csv(spark, path, ORDER_ITEMS))


def lowercase(spark, shop, cut, last):
    shouted = shop.products.toDF(*[name.upper() for name in shop.products.columns])
    return _doubles(files.lowercase_columns(shouted))


def append_twice(spark, shop, cut, last):
    path = _folder(spark)
    for _ in range(2):
        outcome = sinks.append_table(shop.order_items, path)
        if not outcome.ok:
            raise RuntimeError(outcome.message)
    # Another table is refused, and the rows stay as they were.
    for other in (shop.products, shop.order_items.withColumn("quantity", F.col("quantity").cast("string"))):
        if sinks.append_table(other, path).ok:
            raise RuntimeError("appended a table with other columns")
    return _doubles(files.read_table(spark, path, ORDER_ITEMS))


def parameter_query(spark, shop, cut, last):
    text = """
        SELECT status, count(*) AS n_orders, count(DISTINCT customer_id) AS n_customers
        FROM orders WHERE order_date >= :cut AND order_date < :last GROUP BY status"""
    return files.run_sql(spark, shop, text, cut=cut, last=last)


def feature_sink(spark, shop, cut, last):
    matrix = feature_matrix(shop, cut)
    path = _folder(spark)
    sinks.write_csv(matrix, path)
    return files.read_csv(spark, path, matrix.schema)


def target_sink(spark, shop, cut, last):
    labels = engagement_target(shop, cut, last)
    path = _folder(spark)
    sinks.write_csv(labels, path)
    return files.read_csv(spark, path, labels.schema)


# --- operators ----------------------------------------------------------------


def _on_facts(operator, *arguments) -> ShopQuery:
    """An operator on order facts as of the cut."""
    return lambda s, shop, cut, last: _mine(operator(_facts(shop, cut), *arguments), shop, cut)


def _on_facts_at(operator, *arguments, days: int | None = None) -> ShopQuery:
    return lambda s, shop, cut, last: _mine(operator(_facts(shop, cut, days), cut, *arguments), shop, cut)


def _on_visits(operator) -> ShopQuery:
    return lambda s, shop, cut, last: _mine(operator(_visits(shop, cut), cut), shop, cut)


def _on_categories(operator) -> ShopQuery:
    return lambda s, shop, cut, last: _mine(operator(_by_category(shop, cut)), shop, cut)


def _on_raw_facts(operator) -> ShopQuery:
    return lambda s, shop, cut, last: _mine(operator(_raw_facts(shop)), shop, cut)


def _on_raw_facts_at(operator, *arguments, days: int | None = None) -> ShopQuery:
    since = lambda last: days and last - timedelta(days=days)
    return lambda s, shop, cut, last: _mine(operator(_raw_facts(shop, since(last)), last, *arguments), shop, cut)


def _orders_last(days: int) -> ShopQuery:
    return _on_raw_facts_at(engagement.successful_orders_last, days, days=days)


def _on_sessions(operator) -> ShopQuery:
    return lambda s, shop, cut, last: _mine(operator(shop.sessions), shop, cut)


def _on_sessions_at(operator) -> ShopQuery:
    return lambda s, shop, cut, last: _mine(operator(shop.sessions, last), shop, cut)


def _expanded(counted: ShopQuery, count: str = "n") -> ShopQuery:
    """Counted rows of the registered customers, one row each."""
    return lambda s, shop, cut, last: expand_rows(counted(s, shop, cut, last), count)


_ORDER_GAPS = _on_raw_facts(engagement.order_gaps)
_VISIT_GAPS = _on_sessions(engagement.session_gaps)


def _known(gaps: ShopQuery) -> ShopQuery:
    return _expanded(lambda *args: engagement.known_gaps(gaps(*args)))


def _ranked(gaps: ShopQuery) -> ShopQuery:
    return lambda *args: engagement.ranked_intervals(gaps(*args))


def _period_queries(period: str, lines: str) -> dict[str, ShopQuery]:
    days = purchases.RECENT_DAYS if period == RECENT else None
    return {
        lines: _expanded(_on_facts_at(purchases.successful_lines, period, days=days), "n_lines"),
        f"f_intervals{period}": _expanded(_on_facts_at(purchases.line_gaps, period, days=days)),
        f"f_order_frequency{period}": _on_facts_at(purchases.order_frequency, period, days=days),
        f"f_order_values{period}": _on_facts_at(purchases.order_values, period, days=days),
        f"f_succ_order_values{period}": _on_facts_at(purchases.successful_order_values, period, days=days),
        f"f_return_cancel{period}": _on_facts_at(purchases.returns_and_cancels, period, days=days),
    }


SHOP_QUERIES: dict[str, ShopQuery] = {
    # as-of views
    "f_customers_filtered": lambda s, shop, cut, last: _buyers(shop, cut),
    "f_orders_filtered": lambda s, shop, cut, last: _placed(shop, cut),
    "f_sessions_filtered": lambda s, shop, cut, last: _mine(_visits(shop, cut), shop, cut),
    "f_order_level": lambda s, shop, cut, last: _mine(_headers(shop, cut), shop, cut),
    "f_item_level": lambda s, shop, cut, last: _doubles(
        asof.item_level(_placed(shop, cut), shop.order_items, cut)
    ),
    # purchase history and last 90 days
    **_period_queries(HISTORY, "f_succ_orders_hist"),
    **_period_queries(RECENT, "f_succ_orders_90d"),
    "f_account_age": lambda s, shop, cut, last: purchases.account_age(_buyers(shop, cut), cut),
    # last events
    "f_last_successful_order": _on_facts_at(recent.last_successful_order),
    "f_last_successful_stats": _on_facts_at(recent.last_successful_stats),
    "f_full_return_orders": _on_facts(recent.full_return_orders),
    "f_last_return_date": _on_facts(recent.last_return_date),
    "f_last_return_order": _on_facts_at(recent.last_return_order),
    "f_last_return_stats": _on_facts_at(recent.last_return_stats),
    "f_last_cancel_order": lambda s, shop, cut, last: _mine(
        recent.last_cancel_order(_headers(shop, cut), cut), shop, cut
    ),
    "f_last_cancel_stats": _on_facts_at(recent.last_cancel_stats),
    # last three orders
    "f_last3_orders": lambda s, shop, cut, last: _mine(recent.last_orders(_headers(shop, cut)), shop, cut),
    "f_last3_succ_orders": _on_facts(recent.last_successful_orders),
    "f_last3_succ_help": _on_facts(recent.last_successful_details),
    "f_last3_succ_stats": _on_facts(recent.last_successful_summary),
    "f_last3_orders_help": _on_facts(recent.last_orders_losses),
    "f_last3_orders_stats": _on_facts(recent.last_orders_summary),
    # categories
    "f_category_counts": _on_categories(categories.category_counts),
    "f_category_returns": _on_categories(categories.category_returns),
    "f_discount_stats": _on_categories(categories.discount_stats),
    # sessions
    "f_last_session": _on_visits(browsing.last_session),
    "f_last_session_stats": _expanded(_on_visits(browsing.last_day_sessions)),
    "f_successful_orders_180": _on_facts_at(
        purchases.successful_orders_in, purchases.ACTIVE_DAYS, "successful_orders_180", days=purchases.ACTIVE_DAYS
    ),
    "f_sessions_180_stats": _on_visits(browsing.sessions_180_stats),
    "f_sessions_orders_ratio": lambda s, shop, cut, last: _mine(
        browsing.sessions_orders_ratio(_visits(shop, cut), _facts(shop, cut, purchases.ACTIVE_DAYS), cut), shop, cut
    ),
    "f_recent_sessions_90": _on_visits(browsing.recent_sessions),
    "f_session_intervals": _on_visits(browsing.session_intervals),
    "feature_matrix": lambda s, shop, cut, last: feature_matrix(shop, cut),
    # label
    "t_customers_filtered": lambda s, shop, cut, last: _buyers(shop, cut),
    "t_orders_filtered": lambda s, shop, cut, last: _mine(shop.orders, shop, cut),
    "t_items_filtered": lambda s, shop, cut, last: _doubles(
        asof.items_of(shop.order_items, _mine(shop.orders, shop, cut))
    ),
    "t_sessions_filtered": lambda s, shop, cut, last: _mine(shop.sessions, shop, cut),
    "t_successful_orders": _on_raw_facts(engagement.successful_orders),
    "t_successful_orders_30": _orders_last(engagement.SHORT_DAYS),
    "t_successful_orders_60": _orders_last(engagement.MIDDLE_DAYS),
    "t_successful_orders_120": _orders_last(engagement.LONG_DAYS),
    "t_orders_30_60": _on_raw_facts_at(engagement.orders_30_60, days=engagement.MIDDLE_DAYS),
    "t_sum_orders_30_60": _on_raw_facts_at(engagement.sum_orders_30_60, days=engagement.MIDDLE_DAYS),
    "t_last_successful_order": _on_raw_facts(engagement.last_successful_order),
    "t_last_order_total": _on_raw_facts(engagement.last_successful_total),
    "t_orders_excl_last": _on_raw_facts(engagement.orders_excluding_last),
    "t_avg_value_excl_last": _on_raw_facts_at(engagement.average_excluding_last),
    "t_order_intervals": _expanded(_ORDER_GAPS),
    "t_clean_intervals": _known(_ORDER_GAPS),
    "t_ranked_intervals": _ranked(_ORDER_GAPS),
    "t_median_interval": _on_raw_facts_at(engagement.median_order_interval),
    "t_session_intervals": _expanded(_VISIT_GAPS),
    "t_clean_session_intervals": _known(_VISIT_GAPS),
    "t_ranked_session_intervals": _ranked(_VISIT_GAPS),
    "t_median_session_interval": _on_sessions_at(engagement.median_session_interval),
    "t_pages_last_60": _on_sessions_at(engagement.pages_last_60),
    "t_last_session": _on_sessions(engagement.last_session),
    "t_days_since_session": _on_sessions_at(engagement.days_since_session),
    "t_days_since_successful": _on_raw_facts_at(engagement.days_since_successful),
    "target": lambda s, shop, cut, last: engagement_target(shop, cut, last),
    # sources and sinks
    "s_csv_roundtrip": csv_roundtrip,
    "s_lowercase_columns": lowercase,
    "s_append_table": append_twice,
    "s_parameter_query": parameter_query,
    "s_feature_sink": feature_sink,
    "s_target_sink": target_sink,
}


def over_star(query: ShopQuery) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(spark, read_star(spark, sf_dir), CUT, LAST)


def star_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: over_star(query) for name, query in SHOP_QUERIES.items()}
