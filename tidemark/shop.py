"""The five input tables, passed around together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Shop:
    """Raw shop tables; column names and types as in ``tidemark.schema``.

    ``customer_id``, ``order_id`` and ``product_id`` are unique in customers,
    orders and products. ``order_items.returned`` is 0 or 1.
    """

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    sessions: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "products": self.products,
            "orders": self.orders,
            "order_items": self.order_items,
            "sessions": self.sessions,
        }
