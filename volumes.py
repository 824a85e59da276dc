"""The matrix and the label at the published volumes: ``python volumes.py [--hot SHARE]``.

Makes shop tables from copies of the driver's star tables (11 times the customers,
orders and lines of sf0.1, 135 times its sessions: 165,000 customers, 1.65 million
orders, 6.6 million lines, 13.5 million sessions), each copy with ids of its own
and sessions moved by some days, writes them below ``--folder``, and prints one JSON line:
seconds of each run, and bytes and rows that the last run shuffled. ``--hot``: this share of all
orders and sessions belongs to one customer. Needs ``spark.checkpoint.dir`` or ``--folder``.
"""

from __future__ import annotations

import argparse
import json
import os
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance.queries import CUT, LAST
from tidemark import Shop, engagement_target, feature_matrix
from tidemark.session import build_session
from tidemark.sources.files import read_shop
from tidemark.sources.sinks import remove_folder, shared_folder, write_parquet
from tidemark.sources.star import read_star

ORDER_COPIES, SESSION_COPIES = 11, 135
APART = 1_000_000_000


def _copied(df: DataFrame, copies: int, ids: list[str]) -> DataFrame:
    """Each row ``copies`` times, ids moved by a multiple of APART."""
    rows = df.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long")))).hint("rebalance")
    return rows.withColumns({name: F.col(name) + F.col("copy") * APART for name in ids})


def _of_one(df: DataFrame, key: str, share: float) -> DataFrame:
    """The given share of the rows, dealt by a hash of ``key``, belongs to customer 1."""
    hot = F.pmod(F.xxhash64(key), F.lit(1000)) < int(1000 * share)
    return df.withColumn("customer_id", F.when(hot, F.lit(1).cast("long")).otherwise(F.col("customer_id")))


def made_shop(spark: SparkSession, sf_dir: str, folder: str, hot: float = 0, order_copies: int = ORDER_COPIES, session_copies: int = SESSION_COPIES) -> Shop:
    shop = read_star(spark, sf_dir)
    orders = _copied(shop.orders, order_copies, ["order_id", "customer_id"]).drop("copy")
    moved = F.date_sub("session_date", (F.col("copy") % 100).cast("int"))
    sessions = _copied(shop.sessions, session_copies, ["session_id"]).withColumn("session_date", moved)
    sessions = sessions.withColumn("customer_id", F.col("customer_id") + F.col("copy") % order_copies * APART).drop("copy")
    tables = {
        "customers": _copied(shop.customers, order_copies, ["customer_id"]).drop("copy"),
        "products": shop.products,
        "orders": _of_one(orders, "order_id", hot),
        "order_items": _copied(shop.order_items, order_copies, ["order_item_id", "order_id"]).drop("copy"),
        "sessions": _of_one(sessions, "session_id", hot),
    }
    for name, df in tables.items():
        write_parquet(df, f"{folder}/{name}.parquet")
    return read_shop(spark, folder)


def _stages(spark: SparkSession) -> dict[int, object]:
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return {s.stageId(): s for s in (stages.apply(i) for i in range(stages.size()))}


def measured(spark: SparkSession, df_of, runs: int) -> dict:
    seconds = []
    for _ in range(runs):
        before = set(_stages(spark))
        start = time.perf_counter()
        df_of().write.format("noop").mode("overwrite").save()
        seconds.append(round(time.perf_counter() - start, 2))
        new = [s for k, s in _stages(spark).items() if k not in before]
    return {
        "seconds": seconds,
        "shuffled_mb": round(sum(s.shuffleWriteBytes() for s in new) / 1e6, 1),
        "shuffled_rows": sum(s.shuffleWriteRecords() for s in new),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--sf", default="/root/testdata/sf0.1")
    parser.add_argument("--folder", help="where the tables go; kept if given")
    parser.add_argument("--made", action="store_true", help="the folder has the tables already")
    parser.add_argument("--hot", type=float, default=0)
    parser.add_argument("--registered", type=float, default=1, help="share of the customers that the results are for")
    parser.add_argument("--runs", type=int, default=4)
    given = parser.parse_args()
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {"spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("volumes", master=f"local[{cpus}]", shuffle_partitions=4 * int(cpus), extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    folder = given.folder or shared_folder(spark)
    try:
        shop = read_shop(spark, folder) if given.made else made_shop(spark, given.sf, folder, given.hot)
        if given.registered < 1:
            chosen = F.pmod(F.xxhash64("customer_id"), F.lit(1000)) < int(1000 * given.registered)
            shop = replace(shop, customers=shop.customers.where(chosen))
        few = {"few_registered": given.registered < 1}
        rows = {name: df.count() for name, df in shop.tables().items()}
        results = {
            "feature_matrix": measured(spark, lambda: feature_matrix(shop, CUT, **few), given.runs),
            "target": measured(spark, lambda: engagement_target(shop, CUT, LAST, **few), given.runs),
        }
        print(json.dumps({"rows": rows, "hot": given.hot, "registered": given.registered, **results}))
    finally:
        if not given.folder:
            remove_folder(spark, folder)
        spark.stop()


if __name__ == "__main__":
    main()
