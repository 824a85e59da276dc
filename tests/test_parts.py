"""Lines are dealt to partitions whose number grows with their files."""

import re

import duckdb
import pytest
from compare import differences
from test_plans import plan_of

import __spark_entry__ as entry
from conformance.queries import CUT, LAST, SHOP_QUERIES
from tidemark import feature_matrix
from tidemark.functions import parts
from tidemark.sources.star import read_star

SF_DIR = "/root/testdata/sf0.001"
STAR = ["region", "nation", "customer", "part", "orders", "lineitem", "events"]


@pytest.fixture
def fine(spark, monkeypatch):
    """A partition for each fiftieth of the lines' files."""
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    monkeypatch.setattr(parts, "PART_BYTES", -(-parts.file_bytes(lines) // 50))


def test_parts_grow_with_the_files(spark, tmp_path, monkeypatch):
    rows = spark.range(50_000).selectExpr("id", "uuid() AS text").repartition(3)
    folder = tmp_path / "t 1%2"
    rows.write.parquet(str(folder))
    table = spark.read.parquet(str(folder))
    size = sum(f.stat().st_size for f in folder.glob("*.parquet"))
    assert parts.file_bytes(table.where("id > 5").select("id")) == size
    assert parts.parts_for(table) is None  # no more than the tasks that run at once
    monkeypatch.setattr(parts, "PART_BYTES", size // 40)
    once = parts.parts_for(table)
    rows.write.mode("append").parquet(str(folder))
    twice = parts.parts_for(spark.read.parquet(str(folder)))
    assert 40 <= once <= 41 and 79 <= twice <= 83
    assert parts.parts_for(spark.range(10)) is None  # read from no files


@pytest.mark.parametrize("name", ["f_category_counts", "f_category_returns", "f_discount_stats", "f_succ_orders_hist", "feature_matrix"])
def test_many_lines_go_to_many_partitions(spark, fine, name):
    plan = plan_of(SHOP_QUERIES[name](spark, read_star(spark, SF_DIR), CUT, LAST))
    dealt = re.findall(r"hashpartitioning\(l_orderkey#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)
    assert dealt and all(int(n) >= 50 for n in dealt)
    # Nothing by order is left to the few partitions of the session (4).
    assert not re.search(r"hashpartitioning\((order_id|l_orderkey|o_orderkey)#\d+L?, 4\)", plan)


def test_many_lines_give_the_same_results(spark, fine):
    connection = duckdb.connect()
    for table in STAR:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    for name in ("f_category_counts", "f_category_returns", "f_discount_stats", "f_succ_orders_hist", "s_feature_sink"):
        result = entry.queries()[name](spark, SF_DIR)
        assert differences(result, connection.execute(entry.oracle_sql()[name])) is None


def test_matrix_joins_many_lines_once(spark, fine):
    """The totals by order and category are shared, not computed again for each of their readers."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan_of(feature_matrix(read_star(spark, SF_DIR), CUT)).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum("BroadcastHashJoin" in line and "product_id" in line for line in lines) == 1
    assert sum("ReusedExchange" in line and "discounted_lines" in line for line in lines) == 2
