"""Table schemas and the fixed values of the shop's data model."""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(18, 2)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


CUSTOMERS = _table(
    customer_id=LongType(),
    registration_date=DateType(),
    birth_date=DateType(),
    gender=StringType(),
    city=StringType(),
    country=StringType(),
)
PRODUCTS = _table(
    product_id=LongType(),
    category=StringType(),
    brand=StringType(),
    base_price=MONEY,
)
ORDERS = _table(
    order_id=LongType(),
    customer_id=LongType(),
    order_date=DateType(),
    status=StringType(),
    status_date=DateType(),
)
ORDER_ITEMS = _table(
    order_item_id=LongType(),
    order_id=LongType(),
    product_id=LongType(),
    quantity=IntegerType(),
    price_at_purchase=MONEY,
    returned=IntegerType(),
)
SESSIONS = _table(
    session_id=LongType(),
    customer_id=LongType(),
    session_date=DateType(),
    device=StringType(),
    pages_viewed=IntegerType(),
)

TABLES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "sessions": SESSIONS,
}

# Order statuses, devices, labels and product categories.
COMPLETED = "Completed"
RETURNED = "Returned"
CANCELLED = "Cancelled"

MOBILE = "mobile"
DESKTOP = "desktop"

CHURNED = "CHURNED"
ACTIVE = "ACTIVE"
AT_RISK = "AT-RISK"

CATEGORIES = (
    "Automotive",
    "Beauty",
    "Books",
    "Electronics",
    "Fashion",
    "Food",
    "Home",
    "Pets",
    "Sports",
    "Toys",
)
