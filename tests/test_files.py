"""Sources and sinks."""

import csv
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from shops import CUT, LAST, edge_rows

from tidemark import engagement_target, feature_matrix, job
from tidemark.operators.facts import as_of, order_facts
from tidemark.operators.session_days import session_days
from tidemark.schema import ORDERS, SESSIONS, TABLES
from tidemark.sources import facts_table, files, sinks


def multiset(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def shop(spark):
    return edge_rows().to_shop(spark)


def test_csv_columns_are_matched_by_lower_case_name(spark, shop, tmp_path):
    path = str(tmp_path / "orders")
    shuffled = shop.orders.select("status", "order_date", "order_id", "status_date", "customer_id")
    sinks.write_csv(shuffled.toDF(*[name.upper() for name in shuffled.columns]), path)
    read = files.read_csv(spark, path, ORDERS)
    assert read.dtypes == shop.orders.dtypes
    assert multiset(read) == multiset(shop.orders)


def test_csv_with_inferred_types(spark, shop, tmp_path):
    path = str(tmp_path / "sessions")
    sinks.write_csv(shop.sessions.toDF(*[name.title() for name in shop.sessions.columns]), path)
    read = files.read_csv(spark, path)
    assert read.columns == SESSIONS.names
    assert dict(read.dtypes)["session_date"] == "date"


def test_missing_csv_column_is_an_error(spark, shop, tmp_path):
    path = str(tmp_path / "orders")
    sinks.write_csv(shop.orders.drop("status"), path)
    with pytest.raises(Exception, match="status"):
        files.read_csv(spark, path, ORDERS)


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_whole_shop_round_trip(spark, shop, tmp_path, kind):
    for name, df in shop.tables().items():
        path = str(tmp_path / f"{name}.{kind}")
        sinks.write_csv(df, path) if kind == "csv" else sinks.write_parquet(df, path)
    read = files.read_shop_csv if kind == "csv" else files.read_shop
    again = read(spark, str(tmp_path))
    for name, df in again.tables().items():
        assert df.schema == TABLES[name]
        assert multiset(df) == multiset(shop.tables()[name])
    assert multiset(engagement_target(again, CUT, LAST)) == multiset(engagement_target(shop, CUT, LAST))


def test_append_adds_rows_and_reports(spark, shop, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.append_table(shop.orders, path).ok
    assert sinks.append_table(shop.orders, path).ok
    assert spark.read.parquet(path).count() == 2 * shop.orders.count()


def test_append_reports_an_error_without_raising(spark, shop, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    outcome = sinks.append_table(shop.orders, f"{blocked}/table")
    assert not outcome.ok and "Error" in outcome.message


def test_matrix_as_csv(spark, shop, tmp_path):
    matrix = feature_matrix(shop, CUT)
    path = str(tmp_path / "matrix")
    sinks.write_csv(matrix, path)
    assert multiset(files.read_csv(spark, path, matrix.schema)) == multiset(matrix)


def test_sql_text_with_parameters(spark, shop):
    text = "SELECT count(*) AS n FROM orders WHERE order_date < :cut"
    expected = shop.orders.where(f"order_date < DATE'{CUT}'").count()
    assert files.run_sql(spark, shop, text, cut=CUT).first().n == expected


def test_shared_folder_follows_the_session_or_the_caller(tmp_path):
    configured = SimpleNamespace(conf={"spark.checkpoint.dir": str(tmp_path)})
    first, second = sinks.shared_folder(configured), sinks.shared_folder(configured)
    assert first.startswith(str(tmp_path)) and first != second
    assert sinks.shared_folder(configured, "s3a://other/").startswith("s3a://other/tidemark-")


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_no_folder_is_made_up(master):
    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.shared_folder(session)


@pytest.mark.parametrize("change", [lambda df: df.drop("returned"), lambda df: df.withColumn("returned", F.col("returned").cast("string"))])
def test_parquet_without_a_column_or_of_another_type_is_an_error(spark, shop, tmp_path, change):
    for name, df in shop.tables().items():
        sinks.write_parquet(change(df) if name == "order_items" else df, str(tmp_path / f"{name}.parquet"))
    with pytest.raises(ValueError, match="returned"):
        files.read_shop(spark, str(tmp_path))


def test_append_refuses_other_columns_and_leaves_the_table(spark, shop, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.append_table(shop.products, path).ok
    before = multiset(spark.read.parquet(path))
    for other in (
        shop.products.select("product_id"),
        shop.products.withColumn("other", F.lit(1)),
        shop.products.withColumn("product_id", F.col("product_id").cast("string")),
        shop.orders,
    ):
        outcome = sinks.append_table(other, path)
        assert not outcome.ok and "column" in outcome.message or "not bigint" in outcome.message
    assert multiset(spark.read.parquet(path)) == before
    assert sinks.append_table(shop.products.select(*reversed(shop.products.columns)), path).ok
    assert spark.read.parquet(path).count() == 2 * sum(before.values())
    assert not sinks.append_table(shop.products, str(tmp_path / "new"), ORDERS).ok


def test_append_reports_an_error_without_text(monkeypatch, shop, tmp_path):
    def fail(*_):
        raise RuntimeError

    monkeypatch.setattr(sinks, "stored_schema", fail)
    assert sinks.append_table(shop.orders, str(tmp_path / "x")) == sinks.Outcome(False, f"Error at {tmp_path / 'x'}: RuntimeError")


def test_load_into_a_named_table(spark, shop, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS loaded LOCATION '{tmp_path / 'warehouse'}'")
    try:
        path = str(tmp_path / "products")
        sinks.write_csv(shop.products.toDF(*[c.upper() for c in shop.products.columns]), path)
        for _ in range(2):
            assert sinks.load_table(spark, "loaded.products", path, TABLES["products"]).ok
        assert spark.table("loaded.products").schema == TABLES["products"]
        assert spark.table("loaded.products").count() == 2 * shop.products.count()
        other = str(tmp_path / "orders")
        sinks.write_csv(shop.orders, other)
        assert not sinks.load_table(spark, "loaded.products", other).ok
        assert not sinks.load_table(spark, "loaded.products", str(tmp_path / "nowhere")).ok
        assert spark.table("loaded.products").count() == 2 * shop.products.count()
    finally:
        spark.sql("DROP DATABASE loaded CASCADE")


ODD = [("a \"b\", c", "x"), ("back\\slash\\", " spaces "), ('""', ","), (None, "z"), ("line\nbreak", "y"), ("'", 'end"')]


def test_csv_values_round_trip_and_other_readers_agree(spark, tmp_path):
    ours = str(tmp_path / "ours")
    sinks.write_csv(spark.createDataFrame(ODD, "a string, b string").coalesce(1), ours)
    assert multiset(files.read_csv(spark, ours, multi_line=True)) == Counter(ODD)
    (part,) = [p for p in (tmp_path / "ours").iterdir() if p.suffix == ".csv"]
    with part.open(newline="") as f:
        assert list(csv.reader(f))[1:] == [[a or "", b] for a, b in ODD]
    theirs = tmp_path / "theirs.csv"
    with theirs.open("w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([["A", "B"], *[[a or "", b] for a, b in ODD]])
    read = files.read_csv(spark, str(theirs), multi_line=True)
    assert Counter((a or "", b or "") for a, b in read.collect()) == Counter((a or "", b) for a, b in ODD)


def test_files_with_other_headers_in_a_folder_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("brand,category\nx,y\n")
    (tmp_path / "b.csv").write_text("category,brand\ny,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), spark.createDataFrame([], "brand string, category string").schema).collect()


def test_sql_leaves_the_sessions_views(spark, shop):
    spark.range(3).createOrReplaceTempView("orders")
    rows = files.run_sql(spark, shop, "SELECT count(*) AS n FROM orders JOIN customers USING (customer_id)")
    assert spark.table("orders").count() == 3 and rows.first().n > 3
    spark.catalog.dropTempView("orders")
    assert not {"orders", "customers", "products"} & {t.name for t in spark.catalog.listTables() if t.isTemporary}


def test_names_that_differ_by_case_only_are_an_error(spark):
    with pytest.raises(ValueError, match="case"):
        files.lowercase_columns(spark.range(1).selectExpr("id AS a", "id AS A"))


def test_facts_table_is_read_by_month_and_checked(spark, shop, tmp_path):
    facts = order_facts(shop.orders, shop.order_items)
    path = str(tmp_path / "facts")
    facts_table.write_facts(facts, path)
    assert multiset(facts_table.read_facts(spark, path)) == multiset(facts)
    early = facts_table.read_facts(spark, path, until=CUT)
    assert multiset(as_of(early, CUT)) == multiset(as_of(facts, CUT))
    assert early.count() < facts.count()
    sinks.write_parquet(spark.read.parquet(path).drop("kept_cents"), str(tmp_path / "other"))
    with pytest.raises(ValueError, match="kept_cents"):
        facts_table.read_facts(spark, str(tmp_path / "other"))


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_job_writes_both_results(spark, shop, tmp_path, kind):
    for name, df in shop.tables().items():
        (sinks.write_csv if kind == "csv" else sinks.write_parquet)(df, str(tmp_path / "shop" / f"{name}.{kind}"))
    out = str(tmp_path / "out")
    given = ["--shop", str(tmp_path / "shop"), "--out", out, "--cut", CUT.isoformat(), "--last", LAST.isoformat()]
    job.main([*given, *(["--csv"] if kind == "csv" else ["--facts", str(tmp_path / "facts")])], spark)
    matrix, target = feature_matrix(shop, CUT), engagement_target(shop, CUT, LAST)
    read = (lambda path, df: files.read_csv(spark, path, df.schema)) if kind == "csv" else (lambda path, df: spark.read.parquet(path))
    assert multiset(read(f"{out}/features", matrix)) == multiset(matrix)
    assert multiset(read(f"{out}/target", target)) == multiset(target)


def changed_shop(shop, step):
    """The shop some time later: late statuses and returns, new lines, new, moved and vanished orders and sessions."""
    orders, items, sessions = shop.orders, shop.order_items, shop.sessions
    late = F.pmod("order_id", F.lit(7)) == step
    orders = orders.withColumn("status", F.when(late, "Returned").otherwise(F.col("status"))).withColumn(
        "status_date", F.when(late, F.date_add("status_date", 3)).otherwise(F.col("status_date"))
    )
    items = items.withColumn("returned", F.when(late, 1).otherwise(F.col("returned")))
    new_lines = items.where(F.pmod("order_id", F.lit(11)) == step).withColumn("order_item_id", F.col("order_item_id") + 100_000 * (step + 1))
    moved = F.col("order_id") == 2 + step
    orders = orders.withColumn("order_date", F.when(moved, F.date_sub("order_date", 70)).otherwise(F.col("order_date")))
    gone = F.pmod("order_id", F.lit(13)) == 5 + step
    new_orders = orders.where(F.pmod("order_id", F.lit(17)) == step).withColumn("order_id", F.col("order_id") + 1_000_000 * (step + 1))
    later = shop.__class__(
        shop.customers, shop.products, orders.where(~gone).unionByName(new_orders), items.unionByName(new_lines),
        sessions.where(F.pmod("session_id", F.lit(9)) != step),
    )
    ids = [r.order_id for r in orders.where(late | moved | gone | (F.pmod("order_id", F.lit(11)) == step)).select("order_id").collect()]
    ids += [r.order_id for r in new_orders.select("order_id").collect()]
    return later, ids, sessions.where(F.pmod("session_id", F.lit(9)) == step).select("session_date")


def stored(spark, rows):
    """Rows without their history of joins and conditions."""
    return spark.createDataFrame(rows.collect(), rows.schema)


def test_facts_after_three_deltas_are_facts_from_scratch(spark, shop, tmp_path):
    path, days = str(tmp_path / "facts"), str(tmp_path / "days")
    facts_table.write_facts(order_facts(shop.orders, shop.order_items), path)
    facts_table.write_session_days(shop.sessions, days)
    files_before = {p for p in (tmp_path / "facts").rglob("*.parquet")}
    now = shop
    for step in range(3):
        now, ids, dates = changed_shop(now, step)
        now = now.__class__(**{name: stored(spark, df) for name, df in now.tables().items()})
        changed = spark.createDataFrame([(i,) for i in ids], "order_id long")
        for _ in range(2):  # once more changes nothing
            months = facts_table.update_facts(spark, path, now.orders, now.order_items, changed, staging=str(tmp_path))
            facts_table.update_session_days(spark, days, now.sessions, dates, staging=str(tmp_path))
            assert multiset(facts_table.read_facts(spark, path)) == multiset(order_facts(now.orders, now.order_items))
            assert multiset(facts_table.read_session_days(spark, days)) == multiset(session_days(now.sessions))
        assert months
    assert facts_table.update_facts(spark, path, now.orders, now.order_items, spark.createDataFrame([], "order_id long")) == []
    assert {p.parent.name for p in files_before} and sorted(p.name for p in tmp_path.iterdir()) == ["days", "facts"]


def test_months_without_changes_are_not_written(spark, shop, tmp_path):
    path = str(tmp_path / "facts")
    facts_table.write_facts(order_facts(shop.orders, shop.order_items), path)
    before = {str(p) for p in (tmp_path / "facts").rglob("*.parquet")}
    (one,) = shop.orders.where("order_date IS NOT NULL").orderBy("order_id").limit(1).collect()
    changed = spark.createDataFrame([(one.order_id,)], "order_id long")
    assert facts_table.update_facts(spark, path, shop.orders, shop.order_items, changed, staging=str(tmp_path)) == [f"{one.order_date:%Y-%m}"]
    after = {str(p) for p in (tmp_path / "facts").rglob("*.parquet")}
    assert all(f"{one.order_date:%Y-%m}" in p for p in before ^ after) and before != after


def test_kept_tables_are_checked_by_type(spark, shop, tmp_path):
    facts = order_facts(shop.orders, shop.order_items)
    facts_table.write_facts(facts.withColumn("kept_cents", F.col("kept_cents").cast("string")), str(tmp_path / "a"))
    with pytest.raises(ValueError, match="kept_cents is string, not bigint"):
        facts_table.read_facts(spark, str(tmp_path / "a"))
    sinks.write_parquet(facts, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="missing column order_month"):
        facts_table.read_facts(spark, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="no table"):
        facts_table.read_facts(spark, str(tmp_path / "c"))
    assert not facts_table.is_kept(spark, str(tmp_path / "c")) and facts_table.is_kept(spark, str(tmp_path / "a"))


def test_only_months_up_to_the_cut_are_scanned(spark, shop, tmp_path):
    facts_table.write_facts(order_facts(shop.orders, shop.order_items), str(tmp_path / "facts"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = facts_table.read_facts(spark, str(tmp_path / "facts"), until=CUT)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(order_month" in plan and "<= 2001-02" in plan


def test_job_uses_what_is_kept(spark, shop, tmp_path, monkeypatch):
    for name, df in shop.tables().items():
        sinks.write_parquet(df, str(tmp_path / "shop" / f"{name}.parquet"))
    given = ["--shop", str(tmp_path / "shop"), "--kept", str(tmp_path / "kept"), "--last", LAST.isoformat()]
    job.main([*given, "--out", str(tmp_path / "one"), "--cut", CUT.isoformat()], spark)
    before = sorted(str(p) for p in (tmp_path / "kept").rglob("*.parquet"))
    earlier = date(2000, 12, 1)
    job.main([*given, "--out", str(tmp_path / "two"), "--cut", earlier.isoformat(), "--few"], spark)
    assert before == sorted(str(p) for p in (tmp_path / "kept").rglob("*.parquet"))
    assert multiset(spark.read.parquet(str(tmp_path / "two/features"))) == multiset(feature_matrix(shop, earlier))
    assert multiset(spark.read.parquet(str(tmp_path / "two/target"))) == multiset(engagement_target(shop, earlier, LAST))

    later, ids, dates = changed_shop(shop, 1)
    for name, df in later.tables().items():
        sinks.write_parquet(stored(spark, df), str(tmp_path / "shop" / f"{name}.parquet"))
    sinks.write_parquet(spark.createDataFrame([(i,) for i in ids], "order_id long"), str(tmp_path / "ids"))
    sinks.write_parquet(dates, str(tmp_path / "dates"))
    changes = ["--changed-orders", str(tmp_path / "ids"), "--changed-days", str(tmp_path / "dates")]
    job.main([*given, *changes, "--out", str(tmp_path / "three"), "--cut", CUT.isoformat()], spark)
    assert multiset(spark.read.parquet(str(tmp_path / "three/features"))) == multiset(feature_matrix(later, CUT))
    assert multiset(spark.read.parquet(str(tmp_path / "three/target"))) == multiset(engagement_target(later, CUT, LAST))


def test_sql_of_two_threads_over_two_shops(spark, shop):
    other = shop.__class__(**{**shop.tables(), "orders": shop.orders.limit(5)})
    text = "WITH few AS (SELECT customer_id FROM orders) SELECT count(*) AS n FROM few -- all of them"
    expected = {0: shop.orders.count(), 1: 5}
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda k: (k % 2, files.run_sql(spark, (shop, other)[k % 2], text).first().n), range(24)))
    assert all(n == expected[k] for k, n in found)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("shop_")]


def test_sql_with_order_semicolon_and_an_error(spark, shop):
    rows = files.run_sql(spark, shop, "SELECT order_id FROM orders ORDER BY order_id DESC LIMIT 3;").collect()
    assert [r.order_id for r in rows] == sorted((r.order_id for r in shop.orders.collect()), reverse=True)[:3]
    with pytest.raises(Exception, match="nowhere"):
        files.run_sql(spark, shop, "SELECT * FROM nowhere")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("shop_")]


@pytest.mark.parametrize("write", [sinks.write_csv, sinks.write_parquet])
def test_a_failing_query_leaves_the_old_result(spark, shop, tmp_path, write):
    path = str(tmp_path / "result")
    write(shop.products, path)
    before = {p.name for p in (tmp_path / "result").iterdir()}
    failing = shop.products.withColumn("brand", F.when(F.col("product_id") == 7, F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        write(failing, path)
    assert {p.name for p in (tmp_path / "result").iterdir()} == before
    assert [p.name for p in tmp_path.iterdir()] == ["result"]
    write(shop.products.limit(2), path)
    assert [p.name for p in tmp_path.iterdir()] == ["result"]
    read = files.read_csv(spark, path) if write is sinks.write_csv else spark.read.parquet(path)
    assert read.count() == 2


def test_a_result_made_from_the_one_before(spark, tmp_path):
    path = str(tmp_path / "numbers")
    sinks.write_parquet(spark.range(10), path)
    sinks.write_parquet(spark.read.parquet(path).where("id > 4"), path)
    assert spark.read.parquet(path).count() == 5


def test_load_into_a_table_with_names_in_other_case(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shouted LOCATION '{tmp_path / 'warehouse'}'")
    try:
        spark.createDataFrame([(1, "a")], "ID long, Name string").write.saveAsTable("shouted.people")
        (tmp_path / "more.csv").write_text("Name,ID\nb,2\n")
        outcome = sinks.load_table(spark, "shouted.people", str(tmp_path / "more.csv"))
        assert outcome.ok, outcome.message
        assert sorted(map(tuple, spark.table("shouted.people").collect())) == [(1, "a"), (2, "b")]
        assert spark.table("shouted.people").columns == ["ID", "Name"]
        (tmp_path / "other.csv").write_text("Name,Age\nb,2\n")
        assert not sinks.load_table(spark, "shouted.people", str(tmp_path / "other.csv")).ok
    finally:
        spark.sql("DROP DATABASE shouted CASCADE")
