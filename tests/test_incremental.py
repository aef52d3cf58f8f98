"""Extracts with a stored mark, marts refreshed by partition, and the log of refreshes."""

import os
from datetime import date, datetime
from functools import cached_property

import pytest
from pyspark.sql import functions as F, types as T

from tradewind.operators import history
from tradewind.plans import refresh
from tradewind.plans.warehouse import MODELS, Warehouse
from tradewind.sources import pages, payloads
from tradewind.sources.bindings import Canonical
from tradewind.sources.incremental import ExtractStore, LostRace

SMALL = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, day date, value string")


def stored(store):
    return sorted(((r.id, r.day, r.value, r.version) for r in store.read().collect()), key=repr)


JAN = [date(2026, 1, d) for d in range(1, 32)]


def test_three_runs_give_the_table_once(spark, tmp_path):
    store = ExtractStore(spark, str(tmp_path), "day", ["id"])
    source = [(1, JAN[0], "a"), (2, JAN[4], "b")]
    assert store.extract(table(spark, source)).mark == "2026-01-05"
    # a late row inside the overlap, one that changed, one without a day
    source += [(3, JAN[3], "late"), (4, JAN[9], "c"), (5, None, "no day")]
    source[0] = (1, JAN[8], "changed")
    second = store.extract(table(spark, source), "3 DAYS")
    assert (second.version, second.mark, second.rows) == (2, "2026-01-10", 4)
    assert store.extract(table(spark, source), "3 DAYS") is None and len(store.commits()) == 2
    third = store.extract(table(spark, [*source, (6, JAN[9], "same day"), (7, JAN[0], "too late")]), "3 DAYS")
    assert (third.rows, third.mark) == (1, "2026-01-10")
    assert stored(store) == sorted([
        (1, JAN[0], "a", 1), (2, JAN[4], "b", 1), (1, JAN[8], "changed", 2), (3, JAN[3], "late", 2), (4, JAN[9], "c", 2), (5, None, "no day", 2), (6, JAN[9], "same day", 3),
    ], key=repr)


def test_a_run_that_dies_before_the_commit_leaves_no_trace(spark, tmp_path):
    store = ExtractStore(spark, str(tmp_path), "day", ["id"])
    store.extract(table(spark, [(1, JAN[0], "a")]))

    def die():
        raise InterruptedError

    grown = table(spark, [(1, JAN[0], "a"), (2, JAN[1], "b")])
    with pytest.raises(InterruptedError):
        store.extract(grown, before_commit=die)
    assert [c.version for c in store.commits()] == [1] and stored(store) == [(1, JAN[0], "a", 1)]
    assert store.remove_uncommitted() == 1 and store.remove_uncommitted() == 0
    assert store.extract(grown).rows == 1 and len(stored(store)) == 2


def test_of_two_runs_from_one_mark_one_is_refused(spark, tmp_path):
    store, other = (ExtractStore(spark, str(tmp_path), "day", ["id"]) for _ in range(2))
    store.extract(table(spark, [(1, JAN[0], "a")]))
    grown = table(spark, [(1, JAN[0], "a"), (2, JAN[1], "b")])
    with pytest.raises(LostRace):
        store.extract(grown, before_commit=lambda: other.extract(grown))
    assert stored(store) == [(1, JAN[0], "a", 1), (2, JAN[1], "b", 2)]
    assert store.extract(grown) is None


def test_marks_of_other_types(spark, tmp_path):
    for name, ddl, one, two, overlap in (
        ("n", "k bigint, at bigint", (1, 5), (2, 7), 1), ("t", "k bigint, at timestamp", (1, datetime(2026, 1, 1, 1, 2, 3, 4567)), (2, datetime(2026, 1, 2)), "1 HOURS"),
        ("s", "k bigint, at string", (1, "a"), (2, "b'c"), 0),
    ):
        store = ExtractStore(spark, str(tmp_path / name), "at", ["k"])
        assert store.extract(spark.createDataFrame([one], ddl), overlap).rows == 1
        assert store.extract(spark.createDataFrame([one, two], ddl), overlap).rows == 1
        assert store.extract(spark.createDataFrame([one, two], ddl), overlap) is None
    empty = ExtractStore(spark, str(tmp_path / "e"), "day", ["id"])
    assert empty.extract(table(spark, [])) is None and empty.commits() == []
    with pytest.raises(FileNotFoundError):
        empty.read()
    assert empty.extract(table(spark, [(1, None, "x")])).mark is None
    assert empty.extract(table(spark, [(1, None, "x"), (2, JAN[0], "y")])).mark == "2026-01-01"


def files_of(path):
    return {
        f"{folder[len(path):]}/{name}": os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "mart")
    facts = spark.createDataFrame([(k, date(2026, 1 + k % 6, 1 + k % 28), k) for k in range(600)], "id int, day date, amount int")
    month = lambda df: df.withColumn("month", F.date_format("day", "yyyy-MM"))
    build = lambda df: df.groupBy("day").agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
    month(build(facts.where("id % 50 <> 2"))).write.partitionBy("month").parquet(path)
    before = files_of(path)
    late = facts.where("id % 50 = 2 AND month(day) IN (3, 5)")
    now = facts.where("id % 50 <> 2").unionByName(late)
    touched = history.refresh_partitions(path, now, late, month, "month", build)
    assert sorted(touched) == ["2026-03", "2026-05"]
    after = files_of(path)
    untouched = {f for f in before if not any(m in f for m in touched)}
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert not {f for f in before if f not in untouched} & set(after)
    read = sorted((r.day, r.amount, r.n) for r in spark.read.parquet(path).collect())
    assert read == sorted((r.day, r.amount, r.n) for r in build(now).collect())
    # a month whose facts are all gone leaves, and a new one comes
    new = spark.createDataFrame([(1000, date(2027, 1, 1), 5)], facts.schema)
    later = now.where("month(day) <> 6").unionByName(new)
    history.refresh_partitions(path, later, now.where("month(day) = 6").unionByName(new), month, "month", build)
    assert sorted((r.day, r.amount, r.n) for r in spark.read.parquet(path).collect()) == sorted((r.day, r.amount, r.n) for r in build(later).collect())
    assert history.refresh_partitions(path, later, later.limit(0), month, "month", build) == []


class Broken(Warehouse):
    @cached_property
    def dim_customer(self):
        return super().dim_customer.where(F.assert_true(F.lit(False), "broken model").isNull())


def test_every_write_leaves_a_row_in_the_run_log(spark, tmp_path):
    c, root = Canonical(spark, SMALL), str(tmp_path)
    as_of = F.lit("2001-08-02").cast("date")
    refresh.full_refresh(c, root, "r1", as_of, ["customers", "sales_orders"], at=datetime(2026, 1, 1))
    log = {r.pipeline_name: r for r in refresh.run_history(spark, root).collect()}
    assert set(log) == {"customers", "sales_orders", *MODELS, refresh.PIPELINE}
    assert log["sales_orders"].row_count == c.sales_orders.count() and log["sales_orders"].null_keys == 0
    assert log["sales_orders"].newest == c.sales_orders.agg(F.max("order_date")).first()[0]
    with pytest.raises(refresh.RefreshFailed):
        refresh.full_refresh(c, root, "r2", as_of, ["customers"], Broken, at=datetime(2026, 1, 2))
    second = {r.pipeline_name: r for r in refresh.run_history(spark, root).where("run_id = 'r2'").collect()}
    assert second["dim_customer"].status == "FAILED" and "broken model" in second["dim_customer"].error
    assert second["dim_product"].status == "SUCCESS" and "mart_daily_sales" not in second and second[refresh.PIPELINE].status == "FAILED"
    # readers stay with the first run; the latest run of each pipeline is known
    assert refresh.published(spark, root).folder.endswith("r1/analytics")
    latest = {r.pipeline_name: (r.run_id, r.status) for r in refresh.latest_runs(spark, root).collect()}
    assert latest["dim_customer"] == ("r2", "FAILED") and latest["mart_daily_sales"] == ("r1", "SUCCESS") and latest[refresh.PIPELINE][1] == "FAILED"


def test_tables_are_copied_after_those_that_they_refer_to():
    waves = refresh.source_waves(["payments", "invoices", "sales_orders", "customers", "carriers"])
    at = {name: k for k, wave in enumerate(waves) for name in wave}
    assert at["customers"] < at["sales_orders"] < at["invoices"] < at["payments"] and at["carriers"] == 0


def pages_of(spark):
    rows = [(k, 1, k // 10) for k in range(95)] + [(k, 1, k // 10 + 1) for k in range(0, 95, 7)] + [(k, 2, k // 10 + 1) for k in range(0, 95, 5)]
    return spark.createDataFrame(rows, "event_id bigint, version int, page bigint")


PAGE_ROWS = "event_id bigint, version int"


def test_pages_are_read_once_and_torn_ones_later(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = pages_of(spark)
    pages.write_pages(rows.where("page < 8"), path, "page")
    held = pages.tear_page(path, 4)
    ingest = lambda: pages.ingest_pages(spark, path, out, PAGE_ROWS, ["event_id"], ["version"], pagesPerTask="2")
    latest, cursor = ingest()
    assert cursor.first().cursor == 4 and {r.event_id for r in latest.collect()} == {r.event_id for r in rows.where("page < 4").collect()}
    latest, cursor = ingest()
    assert cursor.first().cursor == 4  # still torn
    pages.mend_page(path, 4, held)
    pages.write_pages(rows.where("page = 9"), path, "page")
    latest, cursor = ingest()
    assert cursor.first().cursor == 8  # page 8 is missing, page 9 waits
    pages.write_pages(rows.where("page = 8 OR page > 9"), path, "page")
    latest, cursor = ingest()
    assert cursor.first().cursor == 11
    assert sorted((r.event_id, r.version) for r in latest.collect()) == [(k, 2 if k % 5 == 0 else 1) for k in range(95)]
    # each page was read once
    assert spark.read.parquet(f"{out}/rows").count() == rows.count()


def test_pages_with_strange_lines(spark, tmp_path):
    folder = tmp_path / "in" / "page=0"
    folder.mkdir(parents=True)
    (folder / "part-0.txt").write_text('{"event_id": 1, "version": 1}\n\nno json\n{"event_id": 2}\n{"end": 3}\n')
    latest, cursor = pages.ingest_pages(spark, str(tmp_path / "in"), str(tmp_path / "out"), PAGE_ROWS, ["event_id"], ["version"])
    assert sorted(((r.event_id, r.version) for r in latest.collect()), key=repr) == [(1, 1), (2, None), (None, None)] and cursor.first().cursor == 1
    assert not pages.is_whole(str(tmp_path / "in"), 1)


def test_documents_lose_nothing(spark):
    texts = ['{"k": 5, "new": [1], "x": {"y": null}}', '{"k": "many"}', "{bro", "[1]", None, '{"k": null}', '{"k": 3.0, "k.2": 1}', "{}", '{"k": "7", "s": 4}', '{"s": {"t": 1}}']
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.StringType())])
    got = {r.id: tuple(r)[1:] for r in payloads.open_documents(docs, "body", schema).collect()}
    assert got == {
        0: (5, None, '{"new":[1],"x":{"y":null}}', None, None), 1: (None, None, None, '{"k":"many"}', None), 2: (None, None, None, None, "{bro"),
        3: (None, None, None, None, "[1]"), 4: (None, None, None, None, None), 5: (None, None, None, None, None), 6: (3, None, '{"k.2":1}', None, None),
        7: (None, None, None, None, None), 8: (7, "4", None, '{"k":"7","s":4}', None), 9: (None, '{"t":1}', None, '{"s":{"t":1}}', None),
    }
    drift = payloads.document_drift(docs.withColumn("source", F.lit("a")), "body", schema, ["source"])
    assert sorted((r.field, r.kind, r.observed_type, r.documents) for r in drift.collect()) == [
        ("k", "type_changed", "STRING", 2), ("k.2", "new_field", "BIGINT", 1), ("new", "new_field", "ARRAY<BIGINT>", 1),
        ("s", "type_changed", "BIGINT", 1), ("s", "type_changed", "OBJECT<t: BIGINT>", 1), ("x", "new_field", "OBJECT<y: VOID>", 1),
    ]


def test_item_sets_and_rules(spark):
    from collections import Counter
    from itertools import combinations

    from tradewind.operators import products

    baskets = {o: {f"i{(o * s) % 11:02}" for s in (1, 2, 3, 5)} | {"hot"} for o in range(120)}
    lines = spark.createDataFrame([(o, i) for o, items in baskets.items() for i in sorted(items) for _ in range(2)] + [(500, None)], "order_id int, sku string")
    levels, _ = products.item_sets(lines, "sku", "0.08", 4)
    got = {tuple(r["items"]): r.together for level in levels for r in level.collect()}
    want = Counter(c for items in baskets.values() for n in range(1, 5) for c in combinations(sorted(items), n))
    assert got == {c: n for c, n in want.items() if n >= 10} and {len(c) for c in got} == {1, 2, 3, 4}
    rules = {(r["items"], r.consequent): float(r.confidence) for r in products.basket_rules(lines, "sku", "0.08", 3).collect()}
    some = next(c for c in got if len(c) == 3)
    assert rules[f"{some[0]},{some[1]}", some[2]] == round(got[some] / got[some[:2]] + 1e-12, 4)
    assert products.item_sets(lines.limit(0), "sku", "0.1")[0][0].isEmpty()
