"""Views of the raw tables as they were known on a cut-off date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import day_literal
from tidemark.schema import COMPLETED

#: Bits of a filter of keys, as a power of two.
KEY_BITS = 24


def customers_before(customers: DataFrame, cut: date) -> DataFrame:
    """Customers registered before the cut."""
    return customers.where(f"registration_date < {day_literal(cut)}")


def orders_before(orders: DataFrame, cut: date) -> DataFrame:
    return orders.where(f"order_date < {day_literal(cut)}")


def sessions_before(sessions: DataFrame, cut: date) -> DataFrame:
    return sessions.where(f"session_date < {day_literal(cut)}")


def of_customers(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders or sessions of the given customers."""
    return rows.join(customers.select("customer_id"), "customer_id", "left_semi")


def key_bits(keys: DataFrame, key: str, bits: int = KEY_BITS) -> DataFrame:
    """A filter of the values of ``key``: one bit of ``2 ** bits`` for each hash, as rows of 64.

    At most ``2 ** (bits - 6)`` rows (262,144; some 10 MB as a broadcast), however many keys there are.
    """
    place = keys.selectExpr(f"pmod(xxhash64({key}), {1 << bits}L) AS place")
    return place.groupBy(F.expr("shiftright(place, 6) AS key_word")).agg(F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT))) AS key_mask"))


def likely_of(rows: DataFrame, filter_bits: DataFrame, key: str, bits: int = KEY_BITS) -> DataFrame:
    """Rows whose key may be one of ``key_bits``; others are dropped where they are read.

    No row of a wanted key is lost and no row moves: the filter, bounded in size, is broadcast.
    Of other keys a share of (number of keys) / ``2 ** bits`` stays.
    """
    place = f"pmod(xxhash64({key}), {1 << bits}L)"
    found = F.expr(f"key_word = shiftright({place}, 6) AND (key_mask & shiftleft(1L, CAST({place} & 63 AS INT))) != 0")
    return rows.join(F.broadcast(filter_bits), found, "left_semi")


def items_of(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of the given orders, with their raw return flags."""
    return items.join(orders.select("order_id"), "order_id", "left_semi")


def outcome_unknown(cut: date) -> str:
    """The final status was set on the cut or later."""
    return f"status_date >= {day_literal(cut)}"


def returns_unknown(cut: date) -> str:
    """The return flags were set after the cut. Unlike the status they count
    as known on the cut itself."""
    return f"status_date > {day_literal(cut)}"


def status_as_of(cut: date) -> str:
    """An order whose outcome was not yet known counts as completed."""
    return f"CASE WHEN {outcome_unknown(cut)} THEN '{COMPLETED}' ELSE status END"


def status_date_as_of(cut: date) -> str:
    return f"CASE WHEN {outcome_unknown(cut)} THEN order_date ELSE status_date END"


def order_level(orders: DataFrame, cut: date) -> DataFrame:
    """Order headers with status and status date as of the cut."""
    return orders.selectExpr(
        "order_id",
        "customer_id",
        "order_date",
        f"{status_as_of(cut)} AS status",
        f"{status_date_as_of(cut)} AS status_date",
    )


def item_level(orders: DataFrame, items: DataFrame, cut: date) -> DataFrame:
    """Lines of the given raw orders with the return flag as of the cut."""
    unknown = orders.selectExpr("order_id", f"{returns_unknown(cut)} AS unknown")
    return items.join(unknown, "order_id").selectExpr(
        "order_item_id",
        "product_id",
        "quantity",
        "price_at_purchase",
        "order_id",
        "CASE WHEN unknown THEN 0 ELSE returned END AS returned",
    )
