"""Spending, returns and discounts by product category.

Lines come summed by (order, category), are masked by their order's status and summed by
(customer, category); the pivot into columns then reads at most one row per category of a customer.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from tidemark.functions.columns import aggregate, money, sum_or_zero
from tidemark.operators import asof
from tidemark.schema import CATEGORIES, COMPLETED, RETURNED


def kept_names(category: str) -> tuple[str, str]:
    return f"{category.lower()}_items", f"{category.lower()}_spent"


def returned_names(category: str) -> tuple[str, str]:
    return f"{category.lower()}_items_returned", f"{category.lower()}_returned_total"


def check_names(categories: Sequence[str]) -> None:
    """Categories whose columns would have equal names are an error."""
    names = [name for c in categories for name in (*kept_names(c), *returned_names(c))]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"categories with equal column names: {twice}")


def quoted(name: str) -> str:
    """A column name as SQL, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def by_category(orders: DataFrame, totals: DataFrame, cut: date) -> DataFrame:
    """Totals per (customer, category) over lines of known products.

    ``orders`` are raw headers placed before the cut, ``totals`` those of
    ``facts.category_totals``. Bought lines are those of completed and returned
    orders, returned ones are of returned orders only. An order's lines are masked
    alike, so totals by (order, category) serve as well as lines.
    """
    headers = orders.selectExpr(
        "order_id",
        "customer_id",
        f"{asof.status_as_of(cut)} AS status",
        f"coalesce({asof.returns_unknown(cut)}, false) AS unknown",
    ).where(f"status IN ('{COMPLETED}', '{RETURNED}')")
    flagged = (
        totals.where("known")
        .join(headers, "order_id")
        .selectExpr(
            "customer_id",
            "category",
            "discounted_lines",
            f"CASE WHEN status = '{RETURNED}' THEN n_lines ELSE 0 END AS return_lines",
            "CASE WHEN unknown THEN qty ELSE kept_qty END AS kept_qty",
            "CASE WHEN unknown THEN cents ELSE kept_cents END AS kept_cents",
            f"CASE WHEN status = '{RETURNED}' AND NOT unknown THEN qty - kept_qty ELSE 0 END AS back_qty",
            f"CASE WHEN status = '{RETURNED}' AND NOT unknown THEN cents - kept_cents ELSE 0 END AS back_cents",
        )
    )
    names = ["return_lines", "kept_qty", "kept_cents", "back_qty", "back_cents", "discounted_lines"]
    return aggregate(flagged, ["customer_id", "category"], {name: f"sum({name})" for name in names})


def profile(totals: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """``by_category`` as one row per customer with four columns per category.

    The columns of returns are NULL for a customer without a returned order.
    Categories not in ``categories`` get no columns but their discounts count.
    The narrow rows are repartitioned before they become wide ones.
    """
    check_names(categories)
    columns = {
        "return_lines": "sum(return_lines)",
        "discounted_items_total": "sum(discounted_lines)",
    }
    output = ["customer_id", "discounted_items_total"]
    for category in categories:
        here = f"category = {text_literal(category)}"
        items, spent = kept_names(category)
        back_items, back_total = returned_names(category)
        columns |= {
            items: sum_or_zero(here, "kept_qty"),
            spent: sum_or_zero(here, "kept_cents"),
            back_items: sum_or_zero(here, "back_qty"),
            back_total: sum_or_zero(here, "back_cents"),
        }
        output += [
            quoted(items),
            f"{money(quoted(spent))} AS {quoted(spent)}",
            f"CASE WHEN return_lines > 0 THEN {quoted(back_items)} END AS {quoted(back_items)}",
            f"CASE WHEN return_lines > 0 THEN {money(quoted(back_total))} END AS {quoted(back_total)}",
        ]
    return aggregate(totals.repartition("customer_id"), "customer_id", columns).selectExpr(*output)


def category_counts(totals: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Kept items and spend per category over completed and returned orders."""
    names = [name for c in categories for name in kept_names(c)]
    return profile(totals, categories).select("customer_id", *map(quoted, names))


def category_returns(totals: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Returned items and value per category over returned orders."""
    names = [name for c in categories for name in returned_names(c)]
    returning = totals.where("return_lines > 0")
    return profile(returning, categories).select("customer_id", *map(quoted, names))


def discount_stats(totals: DataFrame) -> DataFrame:
    """Number of lines bought below the base price, kept or not."""
    return aggregate(totals, "customer_id", {"discounted_items_total": "sum(discounted_lines)"})
