"""Source tables stored by day of change and in buckets, and scans told the bounds of ids."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import test_changes
from handmade import add_order, make_tables
from orderloom import Settings
from orderloom.operators import ledger, tat
from orderloom.operators.changes import changed_orders, changed_orders_by_branch
from orderloom.operators.restrict import restricted
from orderloom.plans.wide import build_wide, item_totals
from orderloom.sources import bucketed, clustered
from orderloom.sources.shared import bounds, keep_bounded, within
from orderloom.sources.tables import recent
from orderloom.streaming import feed
from test_changes import EXPECTED, INTENDED, SINCE

tables = test_changes.tables
INTENT = Settings(compat=False)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def rows(frame) -> list:
    return sorted(frame.collect(), key=str)


def files(frame) -> set:
    return {r[0] for r in frame.select(F.input_file_name()).distinct().collect()}


@pytest.fixture(scope="module")
def by_day(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clustered"))
    clustered.store(tables, root)
    return clustered.from_clustered(spark, root)


def test_clustered_tables_are_the_same(tables, by_day):
    for name in tables:
        assert by_day[name].columns == tables[name].columns
        assert rows(by_day[name]) == rows(tables[name])


def test_changes_of_clustered_tables(tables, by_day):
    for settings in (INTENT, Settings()):
        assert rows(changed_orders(by_day, SINCE, settings)) == rows(changed_orders(tables, SINCE, settings))
    assert {r[0] for r in changed_orders(by_day, SINCE, INTENT).collect()} == INTENDED
    assert rows(changed_orders_by_branch(by_day, SINCE)) == rows(changed_orders_by_branch(tables, SINCE))
    assert rows(feed.events(by_day, SINCE)) == rows(feed.events(tables, SINCE))


def test_only_late_days_are_read(by_day):
    """Days before the moment are left out by their partition, also where only one stamp is late."""
    whole, late = by_day["invoices"], recent(by_day, "invoices", SINCE)
    assert "changed_day" not in late.columns
    assert re.search(r"PartitionFilters: \[[^\]]*changed_day[^\]]*>= 2023-06-01", plan(late))
    assert files(late) < files(whole) and late.count() < whole.count() == len(EXPECTED)
    # Tables without time stamps, and mappings that know no days, are read whole.
    assert recent(by_day, "customers", SINCE).count() == by_day["customers"].count()
    assert recent({"x": whole}, "x", SINCE) is whole


@pytest.mark.parametrize("unit", ["week", "month", "year"])
def test_coarser_partitions(spark, tables, tmp_path, unit):
    names = ["invoices", "sale_orders"]
    clustered.store(tables, str(tmp_path), names, unit)
    stored = clustered.from_clustered(spark, str(tmp_path))
    for name in names:
        assert rows(stored[name]) == rows(tables[name])
        late = F.greatest("created_at", "updated_at") > F.lit("2023-06-03 10:00:00")
        some = recent(stored, name, datetime(2023, 6, 3, 10))
        assert rows(some.filter(late)) == rows(tables[name].filter(late))
        # The others are too old; all orders are of one month.
        assert some.count() == (len(EXPECTED) if unit == "year" or name == "sale_orders" else 1)
    with pytest.raises(ValueError, match="hour"):
        clustered.store(tables, str(tmp_path), names, "hour")


def test_rows_without_stamps_and_times_of_day(spark, tmp_path):
    made = {}
    for n, (created, updated) in enumerate(
        [(None, None), (None, "2023-06-01 00:00:01"), ("2023-06-01 23:59:59", None),
         ("2023-05-31 23:59:59", None), ("2023-07-01 00:00:00", "2023-01-01 00:00:00")]
    ):
        add_order(made, n)
        made["sale_orders"][-1] |= {"created_at": created, "updated_at": updated}
    clustered.store(make_tables(spark, made), str(tmp_path), ["sale_orders", "payments"])
    stored = clustered.from_clustered(spark, str(tmp_path))
    assert stored["sale_orders"].count() == 5 and stored["payments"].count() == 0
    moment = datetime(2023, 6, 1, 12)
    assert {r["id"] for r in recent(stored, "sale_orders", moment).collect()} == {1, 2, 4}
    assert recent(stored, "payments", moment).count() == 0
    # Stored again, the table is replaced.
    clustered.store(make_tables(spark, {}), str(tmp_path), ["sale_orders"])
    assert clustered.from_clustered(spark, str(tmp_path))["sale_orders"].count() == 0


def test_bounds_of_what_is_kept(spark):
    ids = spark.range(10, 20).withColumn("other", -F.col("id"))
    kept, ends = keep_bounded(ids, "ids", "id", "other")
    assert rows(kept) == rows(ids) and ends == {"id": (10, 19), "other": (-19, -10)}
    assert bounds(kept, "id") == (10, 19)
    none, ends = keep_bounded(ids.filter("id < 0"), "none", "id")
    assert none.count() == 0 and ends == {"id": (None, None)} and bounds(none, "id") == (None, None)
    assert spark.range(100).filter(within("id", (10, 19))).count() == 10
    assert spark.range(100).filter(within("id", (None, None))).count() == 0


def test_scans_are_told_the_bounds(spark, tables, by_day):
    ids = spark.createDataFrame([(3,), (5,)], "sale_order_id long")
    reduced, plain = restricted(by_day, ids), restricted(tables, ids)
    for name in ("sale_orders", "sale_order_items", "shipments", "sale_order_state_logs"):
        key = "id" if name == "sale_orders" else "sale_order_id"
        assert {r[key] for r in reduced[name].collect()} <= {3, 5}
    terms = plan(reduced["sale_order_payment_terms"])
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(sale_order_id,3\), LessThanOrEqual\(sale_order_id,5\)", terms)
    for name in ("invoices", "payments", "credit_debit_mappings", "ledger_transactions", "shipment_state_logs"):
        assert rows(reduced[name]) == rows(plain[name])
    none = restricted(by_day, ids.limit(0))
    assert [none[n].count() for n in ("sale_orders", "payments", "shipment_state_logs")] == [0, 0, 0]


def test_bloom_filter_of_ids(spark, tables, by_day):
    """Too many ids for a broadcast: Spark filters the scan by a Bloom filter before the shuffle."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ids = spark.createDataFrame([(3,), (5,)], "sale_order_id long")
        reduced = restricted(by_day, ids)
        assert "might_contain" in plan(reduced["invoices"])
        assert {r["id"] for r in reduced["invoices"].collect()} == {3, 5}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def in_buckets(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bucketed") / "db")
    bucketed.store(tables, spark, "bucket_tests", folder, 4)
    yield bucketed.from_bucketed(spark, "bucket_tests")
    spark.sql("drop database bucket_tests cascade")


def test_bucketed_tables_are_the_same(tables, in_buckets):
    for name in tables:
        assert rows(in_buckets[name]) == rows(tables[name])


def test_no_shuffle_on_bucketed_keys(spark, tables, in_buckets):
    """Items with totals, turnaround times and the invoice side of the ledger need no shuffle."""

    def totals(t):
        items = t["sale_order_items"].select(F.col("id").alias("sale_order_item_id"), "sale_order_id")
        return items.join(item_totals(t), "sale_order_item_id", "left")

    def shuffles(frame):
        return re.findall(r"Exchange hashpartitioning\((\w+?)#", plan(frame))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        settings = Settings(tat_cutoff=datetime(2020, 1, 1))
        assert len(shuffles(totals(tables))) == 2 and shuffles(totals(in_buckets)) == []
        assert shuffles(tat.order_tat(in_buckets, settings)) == []
        assert set(shuffles(tat.shipment_tat(in_buckets, settings))) == {"sale_order_id"}
        assert not {"debit_id", "invoice_id"} & set(shuffles(ledger.payment_lines(in_buckets)))
        for query in (totals, lambda t: tat.order_tat(t, settings), ledger.payment_lines):
            assert rows(query(in_buckets)) == rows(query(tables))
        columns = ["sale_order_item_id", "invoice_item_id", "final_ii_quantity", "payment_score"]
        assert rows(build_wide(in_buckets, columns=columns)) == rows(build_wide(tables, columns=columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_bucket_is_whole(spark, tmp_path):
    """A third of the rows in one key, and NULL keys: nothing is lost."""
    made = {}
    for n in range(300):
        made.setdefault("invoice_items", []).append(
            {"id": n, "sale_order_item_id": 7 if n % 3 == 0 else (None if n % 3 == 1 else n), "quantity": 1}
        )
    plain = make_tables(spark, made)
    bucketed.store(plain, spark, "hot_bucket_tests", str(tmp_path / "db"), 4, ["invoice_items"])
    try:
        stored = bucketed.from_bucketed(spark, "hot_bucket_tests")
        assert rows(item_totals(stored)) == rows(item_totals(plain))
        assert {(r["sale_order_item_id"], r["item_lines"]) for r in item_totals(stored).collect()} >= {(7, 100), (None, 100)}
    finally:
        spark.sql("drop database hot_bucket_tests cascade")
