"""What the physical plans must and must not contain."""

import contextlib
import io

import pytest
from shops import CUT, LAST, edge_rows

from conformance.queries import SHOP_QUERIES
from tidemark import engagement_target, feature_matrix
from tidemark.schema import TABLES
from tidemark.sources import files
from tidemark.sources.sinks import write_parquet

LAZY = sorted(name for name in SHOP_QUERIES if not name.startswith("s_"))


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("shop")
    for name, df in edge_rows().to_shop(spark).tables().items():
        write_parquet(df, f"{root}/{name}.parquet")
    return files.read_shop(spark, str(root))


@pytest.fixture
def shuffled(spark):
    """No broadcasts, and the plan as first planned."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_python_or_single_partitions(spark, shop, name):
    plan = plan_of(SHOP_QUERIES[name](spark, shop, CUT, LAST))
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "Arrow", "SinglePartition"):
        assert unwanted not in plan


def test_matrix_reads_lines_once_for_totals_top_k_and_categories(spark, shop, shuffled):
    lines = plan_of(feature_matrix(shop, CUT)).splitlines()
    assert sum("FileScan parquet" in line and "quantity" in line for line in lines) == 1
    # The totals by order and category are dealt once, for the totals by order (twice) and the categories.
    dealt = [line for line in lines if "REPARTITION_BY_COL" in line and "(order_id" in line and "Reused" not in line]
    reused = [line for line in lines if "ReusedExchange" in line and "discounted_lines" in line]
    assert len(dealt) == 1 and len(reused) == 2
    # An order with very many lines is summed before it is dealt by order.
    assert any("hashpartitioning(order_id" in line and "category" in line for line in lines)


def test_top_k_is_cut_before_the_shuffle(spark, shop, shuffled):
    plan = plan_of(SHOP_QUERIES["f_last_successful_stats"](spark, shop, CUT, LAST))
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


@pytest.fixture
def defaults(spark, shuffled):
    """Settings as Spark has them, not as ``build_session`` sets them."""
    key = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    old = spark.conf.get(key)
    spark.conf.unset(key)
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("name", ["target", "t_median_session_interval", "t_median_interval"])
def test_medians_need_plain_hash_aggregations_only(spark, shop, defaults, name):
    plan = plan_of(SHOP_QUERIES[name](spark, shop, CUT, LAST))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert name == "t_median_interval" or "partial_bit_or" in plan


def test_label_reads_each_table_once(spark, shop, shuffled):
    plan = plan_of(engagement_target(shop, CUT, LAST)).splitlines()
    assert sum("FileScan" in line for line in plan) == 4
    assert sum("partial_bit_or" in line for line in plan) == 1


def test_matrix_reads_sessions_once(spark, shop, shuffled):
    for single in (False, True):
        lines = plan_of(feature_matrix(shop, CUT, one_row_per_customer=single)).splitlines()
        assert sum("FileScan" in line and "session_date" in line for line in lines) == 1
        assert sum("ReusedExchange" in line and "near_day" in line for line in lines) == 1


def test_windows_over_gaps_read_days_not_rows(spark, shop, shuffled):
    lines = plan_of(SHOP_QUERIES["t_session_intervals"](spark, shop, CUT, LAST)).splitlines()
    (at,) = [i for i, line in enumerate(lines) if "Window [lag" in line]
    below = " ".join(lines[at + 1 : at + 5])
    assert below.index("Exchange") < below.index("HashAggregate")


def scan_of(spark, df, column) -> str:
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return next(line for line in plan_of(df).splitlines() if "FileScan" in line and column in line)


def test_filters_and_columns_reach_the_scan(spark, shop):
    recent = SHOP_QUERIES["f_recent_sessions_90"](spark, shop, CUT, LAST)
    sessions = scan_of(spark, recent, "session_date")
    assert "LessThan(session_date,2001-02-01)" in sessions
    assert "GreaterThanOrEqual(session_date,2000-11-03)" in sessions
    assert "device" not in sessions.split("ReadSchema")[1]

    values = SHOP_QUERIES["f_order_values_90d"](spark, shop, CUT, LAST)
    orders = scan_of(spark, values, "order_date")
    assert "GreaterThanOrEqual(order_date,2000-11-03)" in orders


def test_short_windows_narrow_the_lines_before_they_are_summed(spark, shop, shuffled):
    for name in ("t_successful_orders_30", "f_order_values_90d", "f_sessions_orders_ratio"):
        lines = plan_of(SHOP_QUERIES[name](spark, shop, CUT, LAST)).splitlines()
        (semi,) = [i for i, line in enumerate(lines) if "LeftSemi" in line and "order_id" in line]
        sums = [i for i, line in enumerate(lines) if "HashAggregate(keys=[order_id" in line]
        assert sums and all(i < semi for i in sums)


def test_the_wide_matrix_is_not_rebalanced(spark, shop):
    plan = plan_of(feature_matrix(shop, CUT)).splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    (at,) = [i for i, line in enumerate(plan) if "REBALANCE" in line]
    below = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
    assert "birth_date" in " ".join(plan) and "birth_date" not in " ".join(plan[at:below])


def test_session_settings():
    from tidemark.session import SETTINGS, build_session  # noqa: F401

    assert float(SETTINGS["spark.sql.sources.fileCompressionFactor"]) >= 3
    assert int(SETTINGS["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 1000


def test_schema_names_all_tables():
    assert set(TABLES) == {"customers", "products", "orders", "order_items", "sessions"}


def test_few_registered_customers_are_sorted_out_before_the_first_shuffle(spark, shop):
    for result in (feature_matrix(shop, CUT, few_registered=True), engagement_target(shop, CUT, LAST, few_registered=True)):
        lines = plan_of(result).splitlines()
        depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        for column in ("session_date", "quantity", "order_date"):
            for at in (i for i, line in enumerate(lines) if "FileScan" in line and column in line):
                # The nodes from the scan upwards.
                above, level = [], depth[at]
                for i in range(at - 1, -1, -1):
                    if depth[i] < level:
                        above.append(lines[i])
                        level = depth[i]
                first = next(i for i, line in enumerate(above) if "Exchange" in line)
                assert any("BroadcastHashJoin" in line and "LeftSemi" in line and "key_mask" in line for line in above[:first])
