"""Shop tables derived from a TPC-H-like star schema with an events table.

Prices go through whole cents, so that every engine rounds them alike. Event
days are stretched over 720 days, each user standing for ten customers.
Customers without an order have no registration date and are left out.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parts import dealt, parts_for
from tidemark.schema import CANCELLED, CATEGORIES, COMPLETED, DESKTOP, MOBILE, MONEY, RETURNED
from tidemark.shop import Shop

LOW_PRIORITIES = ("4-NOT SPECIFIED", "5-LOW")


def read_star(spark: SparkSession, root: str) -> Shop:
    def scan(name):
        return spark.read.parquet(f"{root}/{name}.parquet")

    placed = F.col("o_orderdate").cast("date")
    open_order = F.col("o_orderstatus") == "O"
    dropped = (F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin(*LOW_PRIORITIES)
    orders = scan("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        placed.alias("order_date"),
        F.when(open_order, RETURNED).when(dropped, CANCELLED).otherwise(COMPLETED).alias("status"),
        F.when(open_order, F.date_add(placed, (F.col("o_orderkey") % 28 + 3).cast("int")))
        .otherwise(placed)
        .alias("status_date"),
    )

    first_orders = orders.groupBy("customer_id").agg(F.min("order_date").alias("registration_date"))
    age_days = ((F.col("c_custkey") % 58 + 18) * 365).cast("int")
    customers = (
        scan("customer")
        .join(first_orders, F.col("c_custkey") == F.col("customer_id"))
        .join(scan("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(scan("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "customer_id",
            "registration_date",
            F.date_sub("registration_date", age_days).alias("birth_date"),
            F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
        )
    )

    # Whole cents as DECIMAL(14, 0) times 0.01 stay within 18 digits.
    cents = F.floor(F.expr("l_extendedprice * 100 * (1 - l_discount) / l_quantity"))
    price = cents.cast("decimal(14,0)") * F.lit("0.01").cast("decimal(3,2)")
    # Dealt by order to partitions of bounded size where lines are many; the join with the orders keeps them.
    scanned = scan("lineitem")
    parts = parts_for(scanned)
    lines = (dealt(scanned, "l_orderkey", parts) if parts else scanned).select(
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.cast(MONEY).alias("price_at_purchase"),
        F.col("l_returnflag").isin("R", "A").alias("flagged"),
    )
    sent_back = (F.col("status") == RETURNED) & F.col("flagged")
    order_items = lines.join(orders.select("order_id", "status"), "order_id").select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "price_at_purchase",
        F.when(sent_back, 1).otherwise(0).alias("returned"),
    )

    # Categories in alphabetical order, by the last digit of the part key.
    by_digit = F.array(*[F.lit(category) for category in CATEGORIES])
    products = scan("part").select(
        F.col("p_partkey").alias("product_id"),
        F.get(by_digit, (F.col("p_partkey") % 10).cast("int")).alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(MONEY).alias("base_price"),
    )

    day_of_event = F.datediff(F.lit("2024-01-31").cast("date"), F.col("ts").cast("date")) - 1
    days_back = (day_of_event * 24 + F.col("event_id") % 24).cast("int")
    sessions = scan("events").select(
        F.col("event_id").alias("session_id"),
        (F.col("user_id") * 10 + F.col("event_id") % 10).alias("customer_id"),
        F.date_sub(F.lit("2001-08-01").cast("date"), days_back).alias("session_date"),
        F.when(F.col("event_type").isin("view", "click"), MOBILE).otherwise(DESKTOP).alias("device"),
        (F.floor("value").cast("int") % 30 + 1).alias("pages_viewed"),
    )
    return Shop(customers, products, orders, order_items, sessions)
