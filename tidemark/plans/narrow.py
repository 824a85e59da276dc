"""A shop narrowed to few customers ahead of all shuffles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from tidemark.operators import asof
from tidemark.shop import Shop


def of_few(shop: Shop, customers: DataFrame, facts: DataFrame | None = None) -> tuple[Shop, DataFrame | None]:
    """The shop (and order facts) with nearly only the rows of the given customers.

    Orders and sessions are narrowed by a filter of the customers' ids, lines by one of
    the orders' ids. Filters let some other rows through and lose none that belongs.
    """
    wanted = asof.key_bits(customers, "customer_id")
    orders = asof.likely_of(shop.orders, wanted, "customer_id")
    narrowed = replace(
        shop,
        orders=orders,
        order_items=asof.likely_of(shop.order_items, asof.key_bits(orders, "order_id"), "order_id"),
        sessions=asof.likely_of(shop.sessions, wanted, "customer_id"),
    )
    return narrowed, None if facts is None else asof.likely_of(facts, wanted, "customer_id")
