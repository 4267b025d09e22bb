"""Data where one order, item, invoice, shipment and customer hold a third of the rows."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

from handmade import BOOK, EDITION, CUSTOMER, STANDARD, add, add_invoice, add_item, add_line, add_order, add_payment, make_tables
from orderloom import Settings
from orderloom.operators import ledger
from orderloom.operators.changes import changed_orders
from orderloom.plans import wide
from orderloom.plans.wide import build_detail

NOW = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    rows = {}

    def mostly(hot, other):
        return hot if rng.random() < 0.4 else other

    for n in range(90):
        add_order(
            rows, n, state=rng.choice(["COMPLETED", "CANCELLED", "PARTIAL_COMPLETED"]),
            branch_id=mostly(1, rng.choice([2, 3, None])), contactable_type=CUSTOMER,
            contactable_id=mostly(5, rng.choice([6, 7, None])),
        )
        add(rows, "shipments", id=n, sale_order_id=n, created_at="2023-01-02 00:00:00")
        add_invoice(rows, n, total=rng.randrange(3) * 100)
    for n in range(300):
        add_item(
            rows, n, mostly(4, rng.randrange(90)), quantity=rng.randrange(20),
            kind=rng.choice([EDITION, BOOK]), saleable_id=mostly(8, rng.randrange(9)),
            itemParentable_type=STANDARD, itemParentable_id=mostly(None, rng.randrange(9)),
        )
        add(rows, "shipment_items", id=n, shipment_id=mostly(3, rng.randrange(90)))
    for n in range(600):
        add_line(
            rows, n, mostly(10, rng.randrange(300)), mostly(20, rng.randrange(100)),
            rng.randrange(5), shipment_item_id=mostly(None, mostly(9, rng.randrange(300))),
        )
    for n in range(60):
        add_payment(rows, n, mostly(20, rng.randrange(90)), n, f"2023-02-{1 + n % 28:02d}")
    for n in range(300):
        add(
            rows, "shipment_state_logs", shipment_id=mostly(3, rng.randrange(90)),
            state=rng.choice(["PACKED", "DELIVERED"]), created_at=f"2023-03-{1 + n % 28:02d} 00:00:00",
        )
    for n in range(90):
        add(rows, "sale_order_payment_terms", sale_order_id=mostly(4, n), payment_term="T")
        add(rows, "sale_order_payment_term_after_deliveries", sale_order_id=n, no_of_days=n % 9)
    for n in range(9):
        add(rows, "edition_product_types", id=n, ref_code=f"R{n}")
        add(rows, "customized_books", id=n, name=f"B{n}")
        add(rows, "standard_meta_data", id=n, abbr=f"S{n}")
        add(rows, "customers", id=n, billing_name=f"C{n}")
        add(rows, "branches", id=n, name=f"N{n}")
    return make_tables(spark, rows)


def content(frame):
    return sorted(map(str, frame.collect()))


def plain(monkeypatch):
    """The joins as they are without any hot key."""
    for module, names in ((wide, ("hot_keys", "heavy_keys")), (ledger, ("hot_keys",))):
        for name in names:
            none = (lambda df, *columns: {c: {} for c in columns}) if name == "hot_keys" else lambda *a: {}
            monkeypatch.setattr(module, name, none)


def test_wide(spark, tables, monkeypatch):
    settings = Settings(fetched_at=NOW, compat=False)
    sliced = content(build_detail(tables, settings=settings))
    assert len(sliced) > 2000
    plain(monkeypatch)
    assert sliced == content(build_detail(tables, settings=settings))


def test_some_orders(spark, tables, monkeypatch):
    ids = changed_orders(tables, None).filter("sale_order_id < 30")
    settings = Settings(fetched_at=NOW)
    columns = ["sale_order_item_id", "invoice_item_id", "final_ii_quantity", "payment_score"]
    some = content(build_detail(tables, ids, settings, columns))
    plain(monkeypatch)
    every = build_detail(tables, settings=settings, columns=["sale_order_id", *columns])
    assert some == content(every.filter("sale_order_id < 30").drop("sale_order_id"))


def test_equal_terms_of_one_order_are_spread(spark):
    """A thousand equal rows of a hot order end in several slices, and none is lost."""
    many = spark.sql("select 4L as sale_order_id, 'T' as payment_term from range(1000)")
    orders = spark.sql("select id as sale_order_id from range(10)")
    out = wide._repeated(orders, many, "n", True)
    assert out.count() == 1009 and out.filter("sale_order_id = 4 and n = 1000").count() == 1000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_nth" in plan and "_slice" in plan


def test_an_order_is_heavy_by_its_invoice_items(spark):
    """An order with one item among many, but most of the invoice items, is found."""
    rows = {}
    for n in range(40):
        add_order(rows, n)
        add_item(rows, n, n)
    for n in range(400):
        add_line(rows, n, 7 if n % 4 else n % 40, 1, 1)
    assert set(wide.heavy_orders(make_tables(spark, rows))) == {7}


def test_orders_that_cannot_be_heavy_are_not_summed(spark, monkeypatch):
    rows = {}
    for n in range(100):
        add_order(rows, n)
        add_item(rows, n, n)
        add_line(rows, n, n, 1, 1)
        add_line(rows, 1000 + n, None, 1, 1)
    monkeypatch.setattr(wide, "heavy_keys", lambda *a: pytest.fail("weights were summed"))
    assert wide.heavy_orders(make_tables(spark, rows)) == {}


def test_terms_without_hot_orders_are_joined_plainly(spark):
    many = spark.sql("select id % 500 as sale_order_id, 'T' as payment_term from range(1000)")
    orders = spark.sql("select id as sale_order_id from range(600)")
    out = wide._repeated(orders, many, "n", False, {"sale_order_id": {None: 2}})
    assert out.count() == 1100 and out.columns == ["sale_order_id", "n", "payment_term"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_nth" not in plan and "Aggregate" not in plan


def test_payment_lists_alone_read_the_payments_once(spark, tables, monkeypatch):
    """Lists without totals are those with totals; crowded invoices are put together by day."""
    columns = ["sale_order_item_id", "invoice_item_id", "payment_dates", "all_payments", "installment_dates"]
    steps = []
    monkeypatch.setattr(
        ledger, "payment_lines", lambda *a, f=ledger.payment_lines: steps.append("lines") or f(*a)
    )
    monkeypatch.setattr(
        ledger, "daily_payments", lambda *a, f=ledger.daily_payments: steps.append("daily") or f(*a)
    )
    alone = build_detail(tables, columns=columns)
    assert steps == ["lines"]
    both = build_detail(tables, columns=[*columns, "cash_amount"]).drop("cash_amount")
    assert steps == ["lines", "lines", "daily"]
    assert content(alone) == content(both)
    plain(monkeypatch)
    assert content(alone) == content(build_detail(tables, columns=columns))
