"""Small shops made by hand and at random, as rows per table."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import duckdb
import pyarrow as pa

from tidemark.schema import CATEGORIES, TABLES
from tidemark.shop import Shop

CUT = date(2001, 2, 1)
LAST = date(2001, 8, 1)


def before(day: date, days: int) -> date:
    return day - timedelta(days=days)


class Rows:
    """Collects rows; ids are given out in order."""

    def __init__(self):
        self.tables = {name: [] for name in TABLES}
        for i, category in enumerate(CATEGORIES):
            self.tables["products"].append((i, category, "Nova", Decimal("10.00")))
        self.tables["products"].append((10, "Garden", "Nova", Decimal("10.00")))

    def customer(self, customer_id, registered=date(2000, 1, 1)):
        row = (customer_id, registered, date(1970, 5, 17), "Female", "Lodz", "Poland")
        self.tables["customers"].append(row)

    def order(self, customer_id, day, status="Completed", status_date=None, lines=((1, "10.00", 0),), order_id=None):
        """``lines``: (quantity, price, returned) or with a product id in front."""
        if order_id is None:
            order_id = len(self.tables["orders"]) + 1
        self.tables["orders"].append((order_id, customer_id, day, status, status_date or day))
        for line in lines:
            product, quantity, price, returned = line if len(line) == 4 else (0, *line)
            item = len(self.tables["order_items"]) + 1
            row = (item, order_id, product, quantity, Decimal(price), returned)
            self.tables["order_items"].append(row)
        return order_id

    def session(self, customer_id, day, pages=5, device="mobile"):
        number = len(self.tables["sessions"]) + 1
        self.tables["sessions"].append((number, customer_id, day, device, pages))

    def copy(self) -> Rows:
        other = Rows()
        other.tables = {name: list(rows) for name, rows in self.tables.items()}
        return other

    def to_shop(self, spark) -> Shop:
        return Shop(**{name: spark.createDataFrame(self.tables[name], schema) for name, schema in TABLES.items()})

    def to_duckdb(self, shop: Shop) -> duckdb.DuckDBPyConnection:
        """The same tables as ``r_*`` tables of an in-memory DuckDB."""
        names = {"customers": "r_customers", "products": "r_products", "orders": "r_orders"}
        names |= {"order_items": "r_items", "sessions": "r_sessions"}
        connection = duckdb.connect()
        for name, df in shop.tables().items():
            arrow: pa.Table = df.toArrow()
            connection.register("incoming", arrow)
            connection.execute(f"create table {names[name]} as select * from incoming")
            connection.unregister("incoming")
        return connection


RETURNED_DAY_BEFORE, RETURNED_ON_CUT, RETURNED_DAY_AFTER = 1, 2, 3
WINDOW_ENDS, LATEST_EMPTY, FULL_AND_PART_RETURN = 4, 5, 6
ONE_LINE, ONE_ORDER_THREE_LINES, TIE_ON_LAST_DAY, ONLY_CANCELLED = 7, 8, 9, 10
TWO_LAST_SESSIONS, SESSION_WINDOW_ENDS = 11, 12
LABEL_30, LABEL_60_PAGES_2, LABEL_60_PAGES_3, LABEL_LARGE, LABEL_CHURNED, LABEL_RHYTHM = 13, 14, 15, 16, 17, 18
NOTHING, UNKNOWN_VALUES, REGISTERED_ON_CUT, NOT_A_CUSTOMER, HOT = 19, 20, 21, 22, 23
UNDATED, ONLY_UNDATED = 24, 25


def edge_rows() -> Rows:
    rows = Rows()
    for customer_id in range(1, 26):
        if customer_id not in (REGISTERED_ON_CUT, NOT_A_CUSTOMER):
            rows.customer(customer_id)
    rows.customer(REGISTERED_ON_CUT, registered=CUT)

    both = [(2, "10.00", 1), (1, "7.50", 0)]
    gone = [(2, "10.00", 1), (1, "7.50", 1)]
    placed = before(CUT, 100)
    rows.order(RETURNED_DAY_BEFORE, placed, "Returned", before(CUT, 1), both)
    rows.order(RETURNED_ON_CUT, placed, "Returned", CUT, gone)
    rows.order(RETURNED_DAY_AFTER, placed, "Returned", before(CUT, -1), gone)

    for days in (90, 91, 1, 0):
        rows.order(WINDOW_ENDS, before(CUT, days))

    rows.order(LATEST_EMPTY, before(CUT, 120))
    rows.order(LATEST_EMPTY, before(CUT, 20), lines=[])

    rows.order(FULL_AND_PART_RETURN, before(CUT, 200), "Returned", before(CUT, 190), gone)
    rows.order(FULL_AND_PART_RETURN, before(CUT, 150), "Returned", before(CUT, 140), both)
    rows.order(FULL_AND_PART_RETURN, before(CUT, 130), "Returned", before(CUT, 120), [])

    rows.order(ONE_LINE, before(CUT, 300))
    rows.order(ONE_ORDER_THREE_LINES, before(CUT, 300), lines=[(1, "3.33", 0)] * 3)
    rows.order(TIE_ON_LAST_DAY, before(LAST, 400), lines=[(1, "20.00", 0)])
    rows.order(TIE_ON_LAST_DAY, before(LAST, 10), lines=[(1, "30.00", 0)])
    rows.order(TIE_ON_LAST_DAY, before(LAST, 10), lines=[(1, "40.00", 0)])
    rows.order(ONLY_CANCELLED, before(CUT, 200), "Cancelled", lines=[(3, "5.00", 0), (1, "1.01", 0)])
    rows.order(ONLY_CANCELLED, before(CUT, 210), "Cancelled")

    rows.session(TWO_LAST_SESSIONS, before(CUT, 5), pages=4)
    rows.session(TWO_LAST_SESSIONS, before(CUT, 5), pages=9, device="desktop")
    rows.session(TWO_LAST_SESSIONS, before(CUT, 8), pages=2)
    rows.session(SESSION_WINDOW_ENDS, before(CUT, 180), pages=1)
    rows.session(SESSION_WINDOW_ENDS, before(CUT, 181), pages=2)
    rows.session(SESSION_WINDOW_ENDS, CUT, pages=3)

    for days in (30, 400, 460):
        rows.order(LABEL_30, before(LAST, days))
    for customer_id, pages in ((LABEL_60_PAGES_2, 2), (LABEL_60_PAGES_3, 3)):
        for days in (60, 400, 460):
            rows.order(customer_id, before(LAST, days))
        rows.session(customer_id, before(LAST, 60), pages=pages)
    for days, price in ((45, "50.00"), (400, "10.00"), (460, "10.00")):
        rows.order(LABEL_LARGE, before(LAST, days), lines=[(1, price, 0)])
    for days in (121, 151, 181, 211):
        rows.order(LABEL_CHURNED, before(LAST, days))
    rows.session(LABEL_CHURNED, before(LAST, 61), pages=30)
    for days in (120, 320, 520):
        rows.order(LABEL_RHYTHM, before(LAST, days))
    for days in (70, 150, 230):
        rows.session(LABEL_RHYTHM, before(LAST, days))

    rows.order(UNKNOWN_VALUES, before(CUT, 150), None)
    rows.tables["orders"].append((9001, UNKNOWN_VALUES, before(CUT, 140), "Returned", None))
    rows.tables["order_items"].append((9001, 9001, 10, 1, Decimal("9.99"), 0))
    rows.tables["order_items"].append((9002, 9001, 999, 2, Decimal("9.99"), 1))
    rows.session(UNKNOWN_VALUES, before(CUT, 3), pages=None, device=None)
    rows.session(UNKNOWN_VALUES, before(CUT, 9), pages=7, device="tablet")
    rows.tables["order_items"].append((9003, 9999, 1, 1, Decimal("1.00"), 0))

    for customer_id in (REGISTERED_ON_CUT, NOT_A_CUSTOMER):
        rows.order(customer_id, before(CUT, 30))
        rows.session(customer_id, before(CUT, 30))

    for days in (300, 310, 320):
        rows.order(UNDATED, before(CUT, days))
        rows.session(UNDATED, before(CUT, days))
    for _ in range(4):
        for customer_id in (UNDATED, ONLY_UNDATED):
            rows.order(customer_id, None)
            rows.session(customer_id, None)

    # More rows than all others together, many of them on equal days.
    for i in range(400):
        rows.order(HOT, before(LAST, 3 * (i % 40)), lines=[(i % 10, 1 + i % 3, "12.34", 0)])
        rows.session(HOT, before(LAST, 190 + i % 3), pages=1 + i % 4)
    return rows


def random_rows(seed: int, customers: int = 40) -> Rows:
    """Edge rows and random customers, with many ties and late returns."""
    rng = random.Random(seed)
    rows = edge_rows()
    for customer_id in range(100, 100 + customers):
        if rng.random() < 0.95:
            rows.customer(customer_id, before(CUT, rng.choice([0, 1, 30, 700, 900])))
        reach = rng.choice([3, 60, 400, 900])
        for _ in range(rng.randint(0, 9)):
            day = before(LAST, rng.randint(0, reach))
            status = rng.choice(["Completed", "Completed", "Returned", "Returned", "Cancelled"])
            late = rng.choice([0, 3, 12, 30]) if status == "Returned" else 0
            lines = [
                (rng.randint(0, 11), rng.randint(1, 3), f"{rng.randint(1, 3000) / 100:.2f}",
                 int(status == "Returned" and rng.random() < 0.6))
                for _ in range(rng.choice([0, 1, 1, 2, 5]))
            ]
            rows.order(customer_id, day, status, before(day, -late), lines)
        for _ in range(rng.randint(0, 12)):
            day = before(LAST, rng.randint(0, reach))
            rows.session(customer_id, day, rng.randint(1, 30), rng.choice(["mobile", "desktop"]))
        for _ in range(rng.choice([0, 0, 1, 3])):
            rows.order(customer_id, None, rng.choice(["Completed", "Returned"]), rng.choice([None, before(CUT, 5)]))
            rows.session(customer_id, None, rng.randint(1, 30))
    return rows
