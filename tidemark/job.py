"""The two results as a job: ``spark-submit tidemark/job.py --shop ROOT --cut DATE --last DATE --out ROOT``.

Reads the five tables as Parquet (or CSV with ``--csv``) and writes
``features`` and ``target`` below the output folder, as Parquet or CSV.

``--kept FOLDER`` keeps the order facts and the session days there. What is there already is
used as it is, for any days; ``--changed-orders`` and ``--changed-days``, Parquet tables
with ``order_id`` and ``session_date``, name what changed since, and only those months are made anew;
``--rebuild`` makes all anew.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark import Shop, engagement_target, feature_matrix  # noqa: E402
from tidemark.operators.facts import order_facts  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources import facts_table, files, sinks  # noqa: E402


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--shop", required=True, help="folder of the five tables")
    parser.add_argument("--out", required=True, help="folder of the results")
    parser.add_argument("--cut", required=True, type=date.fromisoformat, help="features as of this day")
    parser.add_argument("--last", type=date.fromisoformat, help="label as of this day; without, only features")
    parser.add_argument("--csv", action="store_true", help="CSV in place of Parquet")
    parser.add_argument("--kept", "--facts", help="folder to keep order facts and session days in, for further days")
    parser.add_argument("--changed-orders", help="table of the order_id of orders changed since they were kept")
    parser.add_argument("--changed-days", help="table of the session_date of sessions changed since they were kept")
    parser.add_argument("--rebuild", action="store_true", help="make what is kept anew")
    parser.add_argument("--few", action="store_true", help="few of the customers in orders and sessions are registered")
    given = parser.parse_args(arguments)

    spark = spark or build_session("customer signals")
    shop = (files.read_shop_csv if given.csv else files.read_shop)(spark, given.shop)
    write = sinks.write_csv if given.csv else sinks.write_parquet
    matrix_shop = label_shop = shop
    early = facts = None
    if given.kept:
        orders, days = keep(spark, shop, given)
        early, facts = facts_table.read_facts(spark, orders, until=given.cut), facts_table.read_facts(spark, orders)
        matrix_shop = replace(shop, sessions=facts_table.read_session_days(spark, days, until=given.cut))
        label_shop = replace(shop, sessions=facts_table.read_session_days(spark, days))
    write(feature_matrix(matrix_shop, given.cut, facts=early, few_registered=given.few), f"{given.out}/features")
    if given.last:
        write(engagement_target(label_shop, given.cut, given.last, facts=facts, few_registered=given.few), f"{given.out}/target")


def keep(spark: SparkSession, shop: Shop, given: argparse.Namespace) -> tuple[str, str]:
    """Write or update what is kept; returns the folders of order facts and session days."""
    root = given.kept.rstrip("/")
    orders, days = f"{root}/orders", f"{root}/sessions"
    if given.rebuild or not facts_table.is_kept(spark, orders):
        facts_table.write_facts(order_facts(shop.orders, shop.order_items), orders)
    elif given.changed_orders:
        changed = spark.read.parquet(given.changed_orders)
        facts_table.update_facts(spark, orders, shop.orders, shop.order_items, changed, staging=root)
    if given.rebuild or not facts_table.is_kept(spark, days):
        facts_table.write_session_days(shop.sessions, days)
    elif given.changed_days:
        facts_table.update_session_days(spark, days, shop.sessions, spark.read.parquet(given.changed_days), staging=root)
    return orders, days


if __name__ == "__main__":
    main()
