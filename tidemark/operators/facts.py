"""Order facts: one row per order with the totals of its lines.

Every purchase signal except those by category is computed from this relation.
Lines are aggregated by order id *before* they meet the order headers: the
aggregation starts map-side, which makes an order with very many lines as
cheap as any other, and the join is then one row to one row. The as-of masking
needs no lines either, because it treats all lines of an order alike.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import add_columns, aggregate, day_literal, fenced, line_cents, sum_or_zero
from tidemark.functions.parts import dealt, parts_for
from tidemark.operators import asof
from tidemark.schema import COMPLETED, RETURNED

HEADER = ["order_id", "customer_id", "order_date", "status", "status_date"]
# Totals over all lines, and the matching ones over kept (not returned) lines.
TOTALS = {"n_lines": "kept_lines", "qty": "kept_qty", "cents": "kept_cents"}

SUCCESSFUL = f"coalesce(status = '{COMPLETED}' OR (status = '{RETURNED}' AND kept_lines > 0), false)"


def _totals() -> dict[str, str]:
    return {
        "n_lines": "count(1)",
        "kept_lines": sum_or_zero("kept"),
        "qty": "sum(quantity)",
        "kept_qty": sum_or_zero("kept", "quantity"),
        "cents": "sum(line_cents)",
        "kept_cents": sum_or_zero("kept", "line_cents"),
    }


def line_totals(items: DataFrame) -> DataFrame:
    """Number of lines, items and cents per order id, over all and over kept lines."""
    lines = items.selectExpr(
        "order_id", "quantity", f"{line_cents()} AS line_cents", "returned = 0 AS kept"
    )
    return aggregate(lines, "order_id", _totals())


def category_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """``line_totals`` per (order, category), with the number of lines bought below the base price.

    ``known`` tells lines of known products from others. Summed map-side by order
    and category first, so that an order with very many lines is one row per category
    when rows are dealt by order. Both ``totals_of_orders`` and the categories
    read what is dealt here, whatever columns each needs.
    """
    of = products.selectExpr("product_id", "category", "base_price", "true AS known")
    lines = items.selectExpr(
        "order_id", "product_id", "quantity", "price_at_purchase", f"{line_cents()} AS line_cents", "returned = 0 AS kept"
    ).join(of, "product_id", "left")
    lines = lines.selectExpr("*", "price_at_purchase < base_price AS discounted").withColumn("known", F.coalesce("known", F.lit(False)))
    sums = _totals() | {"discounted_lines": sum_or_zero("discounted")}
    summed = aggregate(lines, ["order_id", "known", "category"], sums)
    return fenced(dealt(summed, "order_id", parts_for(items)), "order_id")


def totals_of_orders(totals: DataFrame) -> DataFrame:
    """``line_totals`` from ``category_totals``; needs no further shuffle."""
    return aggregate(totals, "order_id", {name: f"sum({name})" for pair in TOTALS.items() for name in pair})


def order_facts(
    orders: DataFrame, items: DataFrame | None, since: date | None = None, totals: DataFrame | None = None
) -> DataFrame:
    """One row per order: header, line totals and whether it was successful.

    ``since``: only orders placed on or after this day, and only their lines;
    Spark then keeps the others out of the scan's shuffle by a Bloom filter
    where the tables are large. ``totals``: the lines' totals by order where
    they are there already; ``items`` are not read then.

    Statuses and return flags are as recorded, so that one such relation, kept
    as a table, serves every cut-off date and the label. Orders without lines
    stay, with ``n_lines`` 0. An order is successful if it is completed, or
    returned with at least one line kept.
    """
    if since is not None:
        orders = orders.where(f"order_date >= {day_literal(since)}")
        items = items and items.join(orders.select("order_id"), "order_id", "left_semi")
    if totals is None:
        totals = line_totals(items)
    joined = orders.select(*HEADER).join(totals, "order_id", "left")
    sums = [f"coalesce({name}, 0) AS {name}" for pair in TOTALS.items() for name in pair]
    return add_columns(joined.selectExpr(*HEADER, *sums), {"is_successful": SUCCESSFUL})


def as_of(facts: DataFrame, cut: date) -> DataFrame:
    """Facts of the orders placed before the cut, as known on the cut.

    While the return flags of an order were unknown, all its lines count as kept.
    """
    unknown = asof.returns_unknown(cut)
    masked = asof.orders_before(facts, cut).selectExpr(
        "order_id",
        "customer_id",
        "order_date",
        f"{asof.status_as_of(cut)} AS status",
        f"{asof.status_date_as_of(cut)} AS status_date",
        *TOTALS,
        *[f"CASE WHEN {unknown} THEN {total} ELSE {kept} END AS {kept}" for total, kept in TOTALS.items()],
    )
    return add_columns(masked, {"is_successful": SUCCESSFUL})
