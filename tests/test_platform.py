"""Sources, files, quality, history, refresh, lineage, streams and the registry."""

import os
from datetime import date

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from __spark_entry__ import oracle_sql, queries
from catalog import platform, registry
from tradewind import contracts
from tradewind.operators import health, history, quality, scenarios
from tradewind.operators.commerce import price_matrix
from tradewind.plans import layers, refresh
from tradewind.sources import files, payloads, tables
from tradewind.sources.bindings import Canonical
from tradewind.streaming import events, run

SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_contracts():
    assert len(contracts.tables()) == 22 and len(contracts.REFERENCES) == 39
    nullable = {(t, f.name) for t in contracts.tables() for f in contracts.schema(t).fields if f.nullable}
    assert len(nullable) == 8


def test_table_maintenance(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "c"), (3, "c")], "k int, v string")
    assert rows(tables.insert_if_absent(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    change = spark.createDataFrame([(2, None)], "k int, v string")
    assert rows(tables.update_from(old, change, ["k"]), "k", "v") == [(1, "a"), (2, None)]
    stamped = old.withColumn("updated_at", F.lit("2026-01-01").cast("timestamp"))
    after = tables.stamp_changes(stamped, new.distinct().unionByName(old.where("k = 1")), ["k"], F.lit("2026-02-02").cast("timestamp"))
    assert [(r.k, r.updated_at.month) for r in after.orderBy("k").collect()] == [(1, 1), (2, 2), (3, 2)]
    drift = tables.schema_drift(old, T.StructType([T.StructField("k", T.StringType()), T.StructField("w", T.StringType())]), "t")
    assert rows(drift, "column_name", "drift") == [("k", "type_changed"), ("v", "unexpected"), ("w", "missing")]
    assert [r.column_name for r in tables.describe_table(old, "t").orderBy("position").collect()] == ["k", "v"]


def test_malformed_and_duplicate_files(spark, tmp_path):
    for name, text in {"a": "id,qty\n1,5\n2,x\n", "b": "id,qty\n1,5\n2,x\n", "c": "id,qty\n3,7\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("qty", T.IntegerType())])
    found = files.read_files(spark, str(tmp_path), schema)
    good, bad = files.split_malformed(found)
    assert good.count() == 3 and bad.count() == 2
    manifest = files.file_manifest(found)
    assert sorted((os.path.basename(r.file_path), r.rows, r.malformed_rows) for r in manifest.collect()) == [("a.csv", 2, 1), ("b.csv", 2, 1), ("c.csv", 1, 0)]
    assert [os.path.basename(r.file_path) for r in files.duplicate_files(manifest).collect()] == ["b.csv"]


def test_documents(spark):
    docs = spark.createDataFrame([(1, '{"a": {"b": 1}, "new": 2}'), (2, "{broken")], "id int, body string")
    schema = T.StructType([T.StructField("a", T.StructType([T.StructField("b", T.IntegerType())]))])
    flat = payloads.flatten(payloads.parse_documents(docs, "body", schema))
    assert rows(flat, "id", "a_b", "_corrupt_record") == [(1, 1, None), (2, None, "{broken")]


def test_cdc_is_repeatable(spark):
    stored = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, 5, "c")], "k int, seq int, v string")
    batch = spark.createDataFrame([(1, 6, "x", "U"), (1, 7, "y", "U"), (2, 9, None, "D"), (3, 4, "late", "U"), (4, 1, "n", "I")], "k int, seq int, v string, op string")
    once = history.apply_cdc(stored, batch, ["k"], "seq")
    assert rows(once, "k", "seq", "v") == [(1, 7, "y"), (3, 5, "c"), (4, 1, "n")]
    assert rows(history.apply_cdc(once, batch.where("op <> 'D'"), ["k"], "seq"), "k", "seq", "v") == rows(once, "k", "seq", "v")


def test_versions(spark):
    changes = spark.createDataFrame(
        [(1, date(2026, 1, 1), 1, "A"), (1, date(2026, 1, 1), 2, "B"), (1, date(2026, 2, 1), 3, "B"), (1, date(2026, 3, 1), 4, "C")],
        "customer_id int, day date, seq int, segment string",
    )
    versions = history.scd2_build(changes, "customer_id", "day", "seq", ["segment"])
    assert rows(versions, "segment", "valid_from", "valid_to", "is_current") == [
        ("B", date(2026, 1, 1), date(2026, 3, 1), False), ("C", date(2026, 3, 1), None, True)]
    facts = spark.createDataFrame(
        [(i, 1, d) for i, d in enumerate([date(2025, 12, 31), date(2026, 1, 1), date(2026, 2, 28), date(2026, 3, 1), date(2027, 5, 5)])],
        "id int, customer_id int, day date",
    )
    joined = history.point_in_time_join(facts, versions, "customer_id", "day", ["segment"])
    assert rows(joined, "id", "segment") == [(0, None), (1, "B"), (2, "B"), (3, "C"), (4, "C")]


def test_versions_of_the_given_tables(spark):
    versions = history.scd2_build(Canonical(spark, SMALL).sales_orders, "customer_id", "order_date", "order_id", ["channel_id"])
    assert versions.where("valid_to <= valid_from").count() == 0
    per = versions.groupBy("customer_id").agg(F.count_if("is_current").alias("n"))
    assert per.where("n <> 1").count() == 0
    assert versions.select("version_key").distinct().count() == versions.count()


def test_refresh_publishes_whole_runs(spark, tmp_path):
    c = Canonical(spark, SMALL)
    sources = ["customers", "customer_segments", "products", "product_categories"]
    counts = {r.table_name: r.row_count for r in refresh.full_refresh(c, str(tmp_path), "r1", F.lit("2001-08-02").cast("date"), sources).collect()}
    assert len(counts) == 17 and counts["dim_customer"] == 150
    assert refresh.published(spark, str(tmp_path)).mart_daily_sales.count() == counts["mart_daily_sales"]
    # what a dead run left is not seen
    tables.replace_table(spark.range(1), str(tmp_path / "runs" / "r2" / "analytics" / "mart_daily_sales"))
    assert refresh.published(spark, str(tmp_path)).mart_daily_sales.count() == counts["mart_daily_sales"]
    house = refresh.published(spark, str(tmp_path))
    whole = house.fact_sales_order_lines.agg(F.sum("net_amount")).first()[0]
    for mart in ("mart_daily_sales", "mart_sales_by_channel", "mart_top_products"):
        assert getattr(house, mart).agg(F.sum("net_revenue")).first()[0] == whole


def test_replay_of_a_run(spark, tmp_path):
    root = str(tmp_path)
    for run_id, n in (("a", 3), ("b", 2), ("a", 4)):
        layers.land_raw(spark.range(n), root, "oms", run_id, "2026-01-01")
    assert layers.read_raw(spark, root, "oms").count() == 6
    assert layers.read_raw(spark, root, "oms", "a").count() == 4


def test_lineage(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "d"), ("a", "d")], "source string, target string")
    paths = health.lineage_closure(edges)
    assert rows(health.trace(paths, "d"), "source", "hops") == [("a", 1), ("b", 2), ("c", 1), ("x", 1)]


def test_isolated_batches(spark):
    df = spark.createDataFrame([(1, True), (1, False), (2, True)], "batch int, ok boolean")
    kept, log = scenarios.isolate_batches(df, "batch", F.col("ok"))
    assert rows(kept, "batch") == [(2,)] and rows(log, "batch", "status") == [(1, "SKIPPED"), (2, "APPLIED")]
    with pytest.raises(ValueError):
        scenarios.shift_replicate(df, 2, [], -1)


def test_unique_and_reference(spark):
    child = spark.createDataFrame([(1, 1), (1, 9), (2, None)], "order_id int, customer_id int")
    parent = spark.createDataFrame([(1,)], "customer_id int")
    assert quality.check_unique("t", child, ["order_id"]).first().failed_rows == 1
    assert quality.check_reference("t", "customer_id", child, parent, "customer_id").first().failed_rows == 1


def test_late_events_over_two_runs(spark, tmp_path):
    inbox, path = str(tmp_path / "in"), str(tmp_path / "run")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("event_time", T.TimestampType())])
    out = None
    for batch in ([(1, "2026-01-10"), (2, "2026-01-01")], [(3, "2026-01-05"), (4, "2026-01-09 12:00:00")]):
        df = spark.createDataFrame(batch, "id int, t string").select("id", F.col("t").cast("timestamp").alias("event_time"))
        df.write.mode("append").parquet(inbox)
        out = events.route_late(run.read_stream(spark, inbox, schema), path, F.expr("INTERVAL 1 DAY"))
    assert rows(out, "id", "is_late") == [(1, False), (2, False), (3, True), (4, False)]


def test_registry():
    names, checks = queries(), oracle_sql()
    assert set(checks) <= set(names) and len(names) >= 118
    assert set(registry.QUERIES) - set(checks) == {"s04_apply_scenario"}


@pytest.mark.parametrize("name", ["m03_mart_sales_by_channel", "m05_mart_inventory_alerts", "f08_settle_payments", "k03_tumbling_metrics", "q04_referential"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events documents".split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = queries()[name](spark, SMALL)
    result = con.execute(oracle_sql()[name])
    order = sorted(df.columns)
    columns = [d[0] for d in result.description]
    want = sorted((tuple(r[columns.index(c)] for c in order) for r in result.fetchall()), key=repr)
    assert sorted(columns) == order and sorted((tuple(r) for r in df.select(*order).collect()), key=repr) == want


def test_large_baskets_meet_in_blocks(spark, monkeypatch):
    from collections import Counter
    from itertools import combinations

    from tradewind.operators import products

    monkeypatch.setattr(products, "BASKET_BLOCK", 7)
    baskets = {1: range(60), 2: range(40, 90), 3: [5, 50], 4: [77]}
    df = spark.createDataFrame([(o, f"i{i:02}") for o, items in baskets.items() for i in [*items, list(items)[0]]], "order_id int, sku string")
    got = {(r.item_a, r.item_b): r.together for r in products.market_basket(df, "sku", "0.5").collect()}
    want = Counter(p for items in baskets.values() for p in combinations(sorted({f"i{i:02}" for i in items}), 2))
    assert got == {p: n for p, n in want.items() if n >= 2}


def test_replaced_tables_are_written_small(spark, tmp_path):
    tables.replace_table(spark.range(100), f"{tmp_path}/t")
    written = [pq.ParquetFile(f).metadata for f in tmp_path.glob("t/*.parquet")]
    assert sum(m.num_rows for m in written) == 100
    assert {m.row_group(g).column(0).compression for m in written for g in range(m.num_row_groups)} == {"ZSTD"}


def test_codes_of_an_order_are_looked_up_per_order(spark, monkeypatch):
    """No lookup moves a line with the codes of its order; unknown codes give NULL."""
    master = lambda code, key, values: spark.createDataFrame(values, f"{code} string, {key} long")
    asked = []
    resolve = scenarios.resolve_codes
    monkeypatch.setattr(scenarios, "resolve_codes", lambda df, masters: asked.append(set(df.columns)) or resolve(df, masters))
    c = type("C", (), {
        "sales_orders": spark.createDataFrame([(1, 5, 2, 1), (31, 5, 9, 5)], "order_id long, customer_id long, branch_id long, channel_id long"),
        "sales_order_lines": spark.createDataFrame(
            [("a", 1, 7, 3, 2), ("b", 1, 8, 3, None), ("c", 31, 7, 4, 2), ("d", 2, 7, 3, 2)],
            "order_line_id string, order_id long, product_id long, warehouse_id long, promotion_id long",
        ),
        "customers": master("customer_code", "customer_id", [("CUS-5", 5)]), "branches": master("branch_code", "branch_id", [("BR-2", 2)]),
        "sales_channels": master("channel_code", "channel_id", [("STORE", 1)]), "products": master("sku", "product_id", [("P-7", 7)]),
        "warehouses": master("warehouse_code", "warehouse_id", [("WH-3", 3), ("WH-4", 4)]),
        "carriers": master("carrier_code", "carrier_id", [("CAR-1", 2), ("CAR-5", 6)]), "promotions": master("promotion_code", "promotion_id", [("PRO-1", 2)]),
    })
    names = ("order_line_id", "customer_id", "branch_id", "channel_id", "product_id", "warehouse_id", "carrier_id", "promotion_id")
    assert rows(platform._all_codes(c), *names) == [
        ("a", 5, 2, 1, 7, 3, 2, 2), ("b", 5, 2, 1, None, 3, 2, None), ("c", None, None, None, None, 4, 6, 2)]
    assert asked and not any({"order_line_id", "customer_code"} <= columns for columns in asked)


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path):
    """Sorted ids take a byte or two in a file and some sixty in a broadcast; pairs made by an explode are not taken for their input."""
    own = spark.newSession()
    own.conf.unset("spark.sql.sources.fileCompressionFactor")
    own.range(200_000).selectExpr(
        "id AS p_partkey", "'a' AS p_name", "'b' AS p_brand", "'LARGE' AS p_type", "1 AS p_size", "900.0D AS p_retailprice"
    ).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    c = Canonical(own, str(tmp_path))
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", sum(f.stat().st_size for f in (tmp_path / "part.parquet").glob("*.parquet")))
    joined = c.products.select("product_id").join(c.products.select("product_id", "standard_cost"), "product_id")
    pairs = own.range(1000).select(F.col("id").alias("product_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("channel_id"))
    for df in (joined, c.price_lists, price_matrix(pairs, c.products, c.sales_channels)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin [product_id" in plan and "BroadcastHashJoin [product_id" not in plan
    own.conf.set("spark.sql.sources.fileCompressionFactor", "3.0")
    Canonical(own, str(tmp_path))
    assert own.conf.get("spark.sql.sources.fileCompressionFactor") == "3.0"


def test_a_failed_refresh_says_why(spark, tmp_path):
    c = Canonical(spark, "/nowhere")
    c.__dict__["companies"] = spark.range(1).select(F.assert_true(F.lit(False), F.lit("broken source")).isNull().alias("company_id"))
    with pytest.raises(refresh.RefreshFailed, match="companies.*broken source"):
        refresh._write_all({"companies": lambda: c.companies}, str(tmp_path / "source"), [])
