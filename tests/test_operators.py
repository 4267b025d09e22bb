"""Turnaround times, ledger, terms, figures and functions on small data, against plain joins."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from handmade import add, add_item, add_order, add_payment, make_tables
from orderloom import Settings
from orderloom.functions.lists import listed
from orderloom.functions.matching import class_name, like
from orderloom.operators import kpis, ledger, tat, terms
from orderloom.operators.replace import replace_rows
from orderloom.operators.restrict import restricted

EARLY = Settings(tat_cutoff=datetime(2022, 10, 1))
SINCE = datetime(2023, 1, 10)


def times(rng, n):
    start = datetime(2023, 1, 1)
    return [start + timedelta(hours=rng.randrange(480)) for _ in range(n)]


@pytest.fixture(scope="module")
def random_logs(spark):
    """Orders and shipments with none, one or many log rows per state, some without time."""
    rng = random.Random(7)
    rows = {}
    for order in range(60):
        state = rng.choice(["COMPLETED", "FORCED_COMPLETED", "CANCELLED"])
        add(
            rows, "sale_orders", id=order, state=state,
            created_at=rng.choice(["2022-01-01 00:00:00", "2023-01-01 00:00:00"]),
        )
        for log_state in ("CREATED", "PROCESSED", "SEND_FOR_DIGITAL", "COMPLETED", "OTHER"):
            for at in times(rng, rng.choice([0, 1, 1, 3])):
                at = None if rng.random() < 0.1 else at
                add(rows, "sale_order_state_logs", sale_order_id=order, state=log_state, created_at=at)
        for shipment in range(order * 10, order * 10 + rng.randrange(4)):
            add(
                rows, "shipments", id=shipment, sale_order_id=order,
                created_at=rng.choice(["2022-01-01 00:00:00", "2023-01-05 00:00:00", "2023-01-12 00:00:00"]),
            )
            for log_state in ("PACKED", "DELIVERED", "IN_TRANSIT"):
                for at in times(rng, rng.choice([0, 1, 1, 4])):
                    at = None if rng.random() < 0.1 else at
                    add(rows, "shipment_state_logs", shipment_id=shipment, state=log_state, created_at=at)
    return make_tables(spark, rows)


def test_shipment_tat_equals_pairs(spark, random_logs):
    for name in ("shipments", "shipment_state_logs"):
        random_logs[name].createOrReplaceTempView(name)
    pairs = spark.sql(f"""
        select s.sale_order_id,
               min(datediff(d.created_at, p.created_at)) as days,
               min(cast(cast(d.created_at - p.created_at as interval second) as bigint)) as seconds,
               count_if(s.created_at > '{SINCE}' or p.created_at > '{SINCE}' or d.created_at > '{SINCE}') as new
        from shipments s
        left join shipment_state_logs p on p.shipment_id = s.id and p.state = 'PACKED'
        left join shipment_state_logs d on d.shipment_id = s.id and d.state = 'DELIVERED'
        where s.created_at > '2022-10-01' group by 1 having days is not null""")
    expected = sorted(map(tuple, pairs.collect()))
    got = tat.shipment_tat(random_logs, EARLY, changes=(SINCE, "created_at")).collect()
    assert len(expected) > 10
    assert sorted(map(tuple, got)) == expected
    plain = tat.shipment_tat(random_logs, EARLY).collect()
    assert sorted(map(tuple, plain)) == [r[:3] for r in expected]


def test_order_tat_equals_pairs(spark, random_logs):
    for name in ("sale_orders", "sale_order_state_logs"):
        random_logs[name].createOrReplaceTempView(name)
    joins = "".join(
        f" left join sale_order_state_logs {n} on {n}.sale_order_id = o.id and {n}.state in ({s})"
        for n, s in (
            ("a", "'CREATED'"), ("b", "'PROCESSED','SEND_FOR_DIGITAL'"),
            ("c", "'PROCESSED','SEND_FOR_DIGITAL'"), ("d", "'COMPLETED'"),
        )
    )
    new = " or ".join(f"{n}.created_at > '{SINCE}'" for n in "abcd")
    pairs = spark.sql(f"""
        select o.id, min(datediff(b.created_at, a.created_at)) as days,
               min(cast(cast(b.created_at - a.created_at as interval second) as bigint)),
               min(datediff(d.created_at, c.created_at)),
               min(cast(cast(d.created_at - c.created_at as interval second) as bigint)),
               count_if({new})
        from sale_orders o {joins}
        where o.state in ('COMPLETED', 'FORCED_COMPLETED') and o.created_at > '2022-10-01'
        group by 1 having days is not null""")
    key = lambda r: (r[0],)
    expected = sorted(map(tuple, pairs.collect()), key=key)
    got = tat.order_tat(random_logs, EARLY, changes=(SINCE, "created_at")).collect()
    assert len(expected) > 10
    assert sorted(map(tuple, got), key=key) == expected


def test_tat_of_some_orders(spark, random_logs):
    ids = spark.range(0, 60, 3).withColumnRenamed("id", "sale_order_id")
    fewer = restricted(random_logs, ids, EARLY)
    for found in (tat.shipment_tat, tat.order_tat):
        every = {r[0]: r for r in found(random_logs, EARLY).collect()}
        some = {r[0]: r for r in found(fewer, EARLY).collect()}
        assert some == {k: r for k, r in every.items() if k % 3 == 0}


def test_tat_examples(spark):
    rows = {}
    for n in (1, 2, 3):
        add(rows, "shipments", id=n, sale_order_id=min(n, 2), created_at="2023-01-01 00:00:00")
    for shipment, state, day in (
        (1, "PACKED", 1), (1, "PACKED", 3), (1, "DELIVERED", 5), (2, "PACKED", 1), (3, "DELIVERED", 2),
    ):
        add(rows, "shipment_state_logs", shipment_id=shipment, state=state, created_at=f"2023-01-0{day} 00:00:00")
    add(rows, "shipments", id=4, sale_order_id=4)
    tables = make_tables(spark, rows)
    # Pairs stay within one shipment, so order 2 has no time.
    assert [tuple(r) for r in tat.shipment_tat(tables, EARLY).collect()] == [(1, 2, 2 * 86400)]
    spans = [tuple(r) for r in tat.shipment_span(tables).collect()]
    assert spans[0] == (4, None) and spans[-1] == (1, 4) and len(spans) == 4
    assert {r["shipment_id"] for r in tat.first_delivery(tables, EARLY).collect()} == {1, 3}


def test_ledger(spark):
    rows = {}
    add_payment(rows, 1, 1, 10, "2023-01-01", credited_at="2023-01-01 00:00:00")
    add_payment(rows, 2, 1, 20, "2023-01-01", mode="CHEQUE")
    add_payment(rows, 3, 2, 30, "2023-01-02", mode="OTHER")
    add_payment(rows, 4, 3, 40, "2023-01-02", state="PENDING")
    # One payment split over two invoices, and a cancelled entry.
    add(rows, "credit_debit_mappings", debit_id=1003, credit_id=2002, amount=5)
    add(rows, "ledger_transactions", id=1009, ledgerable_type="X\\Invoice", ledgerable_id=1, state="VOID")
    add(rows, "credit_debit_mappings", debit_id=1009, credit_id=2001, amount=99)
    tables = make_tables(spark, rows)
    found = {r["invoice_id"]: r for r in ledger.payments_by_invoice(tables).collect()}
    assert set(found) == {1, 2}
    one, two = found[1], found[2]
    assert (one["advance_amount"], one["cash_amount"], one["cheque_amount"]) == (10, 10, 20)
    assert (two["advance_amount"], two["cash_amount"], two["cheque_amount"]) == (None, 0, 5)
    assert [(str(p["paid_on"]), p["amount"]) for p in one["payments"]] == [("2023-01-01", 30)]
    assert len(two["payments"]) == 2
    assert {tuple(r) for r in ledger.advances(tables).collect()} == {(1, 10)}


def test_ledger_with_hot_keys(spark, monkeypatch):
    """One invoice and one payment entry hold most mappings; slicing changes nothing."""
    rng = random.Random(3)
    rows = {}
    for n in range(1, 40):
        add_payment(rows, n, n, n, "2023-01-01", mode=rng.choice(["CASH", "CHEQUE", "ONLINE"]))
    for n in range(400):
        debit, credit = (1001, 2000 + n % 39 + 1) if n % 2 else (1000 + n % 39 + 1, 2001)
        add(rows, "credit_debit_mappings", debit_id=debit, credit_id=credit, amount=n)
    tables = make_tables(spark, rows)
    sliced = ledger.payments_by_invoice(tables, Settings()).collect()
    monkeypatch.setattr(ledger, "hot_keys", lambda df, *columns: {c: {} for c in columns})
    plain = ledger.payments_by_invoice(tables, Settings()).collect()
    assert sorted(map(str, plain)) == sorted(map(str, sliced))


def test_installments(spark):
    rows = {}
    plans = "sale_order_payment_term_installments"
    add(rows, plans, id=1, sale_order_id=1, installment_date="2023-01-01", amount=1)
    add(rows, plans, id=2, sale_order_id=1, installment_date="2023-02-01", amount=2)
    add(rows, plans, id=3, sale_order_id=2, amount=2)
    add(rows, plans, sale_order_id=3, amount=2)
    tables = make_tables(spark, rows)
    due = {r[0]: (str(r[1]), r[2]) for r in terms.installment_due(tables).collect()}
    assert due == {1: ("2023-02-01", 2), 2: ("None", 1)}
    lists = {r[0]: len(r[1]) for r in terms.installment_lists(tables).collect()}
    assert lists == {1: 2, 2: 1}


def test_lists_have_an_entry_per_row(spark):
    rows = {}
    paid = [(10, "2023-01-02"), (5, "2023-01-02"), (5, "2023-01-02"), (7, "2023-01-01"), (8, None)]
    for n, (amount, on) in enumerate(paid, 1):
        add_payment(rows, n, 1, amount, on)
    add_payment(rows, 20, 2, 3, None)
    add_payment(rows, 21, 3, None, "2023-01-05")
    plans = "sale_order_payment_term_installments"
    for n, (on, amount) in enumerate([("2023-03-01", 4), (None, 1), ("2023-02-01", None), ("2023-03-01", 4)]):
        add(rows, plans, id=n, sale_order_id=1, installment_date=on, amount=amount)
    add(rows, plans, id=9, sale_order_id=2)
    tables = make_tables(spark, rows)
    found = {r[0]: (r[1], r[2]) for r in ledger.payment_lists(ledger.payment_lines(tables)).collect()}
    dates = ",2023-01-01,2023-01-02,2023-01-02,2023-01-02"
    assert found == {1: (dates, "8.00,7.00,5.00,5.00,10.00"), 2: (None, "3.00")}
    found = {r[0]: (r[1], r[2]) for r in terms.installment_texts(tables).collect()}
    assert found == {1: (",2023-02-01,2023-03-01,2023-03-01", "1.00,,4.00,4.00"), 2: (None, None)}


def test_lists_in_one_step_are_those_by_day(spark):
    """Equal rows, equal days, missing parts and missing keys; shuffled once."""
    rng = random.Random(3)
    rows = [
        (rng.choice([1, 2, 3, None]), rng.choice([None, *days]), rng.choice([None, 1, 5, 10]))
        for days in [[datetime(2023, 1, d).date() for d in (1, 2, 11)]] * 60
    ] + [(8, None, None), (8, None, None), (9, None, 4)]
    df = spark.createDataFrame(rows, "k long, day date, amount int").repartition(3)
    names, also = ("days", "amounts"), {"last": F.max("day"), "rows": F.sum("n")}
    apart = listed(df, "k", "day", "amount", names, also)
    together = listed(df, "k", "day", "amount", names, also, together=True)
    assert sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))
    assert {(r["k"], r["rows"]) for r in together.collect()} >= {(8, 2), (9, 1)}
    plan = together._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "listagg" not in plan


def test_installment_plans_are_dues_and_texts(spark):
    rows = {}
    plans = "sale_order_payment_term_installments"
    for n, (order, on, amount) in enumerate(
        [(1, "2023-03-01", 4), (1, None, 1), (1, "2023-02-01", None), (2, None, None), (None, "2023-02-01", 3)]
    ):
        add(rows, plans, id=n, sale_order_id=order, installment_date=on, amount=amount)
    add(rows, plans, sale_order_id=3, amount=1)
    tables = make_tables(spark, rows)
    columns = ["sale_order_id", "installment_due", "installments", "installment_dates", "installment_amounts"]
    expected = terms.installment_due(tables).join(terms.installment_texts(tables), "sale_order_id")
    found = terms.installment_plans(tables).select(*columns)
    assert sorted(found.collect()) == sorted(expected.select(*columns).collect())
    assert {r["sale_order_id"]: r["installments"] for r in found.collect()} == {1: 3, 2: 1}


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("_ON_DELIVERY",), ("CASH ON DELIVERY",), ("ON_DELIVERY",), ("a\\b\\C",), (None,)], "x string"
    )
    got = df.select(like(F.col("x"), "%_ON_DELIVERY"), class_name(F.col("x"))).collect()
    assert [r[0] for r in got] == [True, True, False, False, None]
    assert [r[1] for r in got][3:] == ["C", None]


def test_replace(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "sale_order_id long, v string")

    def replaced(ids, new):
        frame = spark.createDataFrame([(i,) for i in ids], "sale_order_id long")
        rows = spark.createDataFrame(new, old.schema)
        return {tuple(r) for r in replace_rows(old, frame, rows).collect()}

    everything = {(1, "a"), (1, "b"), (2, "c"), (3, "d")}
    assert replaced([], []) == everything
    assert replaced([1], [(1, "z")]) == {(1, "z"), (2, "c"), (3, "d")}
    assert replaced([3], []) == everything - {(3, "d")}
    assert replaced([9], [(9, "n")]) == everything | {(9, "n")}


def test_figures(spark):
    schema = """sale_order_id long, order_state string, invoice_total_with_tax decimal(18,2),
        total_unit_price_without_tax decimal(38,4), is_dc int,
        sale_order_item_discount_percentage decimal(18,2), invoice_prefix string,
        ii_quantity decimal(18,2)"""
    wide = spark.sql("""
        select * from values
            (1L, 'COMPLETED', 100, 10, 1, 10, 'CC', 1), (1L, 'COMPLETED', 200, 20, 0, 99, 'IN', 2),
            (2L, 'COMPLETED', 50, 5, 1, 20, null, 1), (3L, 'CANCELLED', 9000, 900, 1, 90, 'CC', 50),
            (4L, null, 9000, 900, 1, 90, 'CC', 50), (5L, 'COMPLETED', 0, 0, 1, 90, null, 0)
    """).toDF(*[c.split()[0] for c in schema.replace("18,2", "").replace("38,4", "").split(",")])
    assert tuple(kpis.average_ticket_size(wide).first()) == pytest.approx((250 / 3, 35 / 3))
    assert kpis.average_discount(wide).first()[0] == 15
    assert kpis.cc_share(wide).first()[0] == 25
    kpis.report_view(wide)
    shown = spark.sql("""select sum(case when invoice_prefix = "CC" then total_ii_quanity end) * 100
        / sum(total_ii_quanity), max(final_invoice_total_with_tax)
        from regular_orders where order_state <> "CANCELLED" """)
    assert tuple(shown.first()) == (25, 200)
    assert kpis.cc_share(wide.filter("ii_quantity = 0")).first()[0] is None
    assert kpis.average_discount(wide.limit(0)).first()[0] is None


def test_eligible(spark):
    from orderloom.operators.eligible import eligible_items, eligible_orders

    rows = {}
    add_order(rows, 1)
    add_order(rows, 2, state="CREATED")
    add_item(rows, 1, 1)
    add_item(rows, 2, 1, kind="X\\Service")
    tables = make_tables(spark, rows)
    assert [r["id"] for r in eligible_orders(tables).collect()] == [1]
    assert [r["id"] for r in eligible_items(tables).collect()] == [1]
