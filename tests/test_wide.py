"""One order per case; the wide table is built once and looked at from all sides."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from handmade import (
    BOOK, CUSTOMER, EDITION, NOTEBOOK, STANDARD, add, add_invoice, add_item, add_line, add_order,
    add_payment, make_tables,
)
from orderloom import Settings
from orderloom.plans.wide import DETAIL_COLUMNS, build_detail, build_wide
from orderloom.schemas import wide_columns, wide_schema

NOW = datetime(2024, 1, 1, 12)


def invoiced(rows, n, total=100, **order):
    """Order, item, invoice item and invoice, all numbered n."""
    add_order(rows, n, **order)
    add_item(rows, n, n)
    add_invoice(rows, n, total)
    add_line(rows, n, n, n, 10)


def due_after(rows, n, days):
    """Payment is due some days after the invoice date, 2023-02-01."""
    add(rows, "sale_order_payment_term_after_deliveries", sale_order_id=n, no_of_days=days)


@pytest.fixture(scope="module")
def rows():
    rows = {}
    # Scores: 1 on time, 2 half of it late, 3 very late, 4 cancelled, 5 unpaid, 6 no due date,
    # 7 zero total, 8 instalments, 9 undated payment, 10 instalments without a date.
    for n in (1, 2, 3, 5, 6, 9):
        invoiced(rows, n)
    invoiced(rows, 4, state="CANCELLED")
    invoiced(rows, 7, total=0)
    for n in (1, 2, 3, 5, 7, 9):
        due_after(rows, n, 9)  # due 2023-02-10
    add_payment(rows, 1, 1, 100, "2023-02-10")
    add_payment(rows, 2, 2, 50, "2023-02-20")
    add_payment(rows, 102, 2, 50, "2023-01-15")
    add_payment(rows, 3, 3, 100, "2023-12-07")  # 300 days late
    add_payment(rows, 6, 6, 100, "2023-02-10")
    add_payment(rows, 7, 7, 100, "2023-02-10")
    add_payment(rows, 9, 9, 50, "2023-02-10")
    add_payment(rows, 109, 9, 50, None)
    for n in (8, 10):
        invoiced(rows, n)
        add_payment(rows, n, n, 100, "2023-03-15")
    plans = "sale_order_payment_term_installments"
    add(rows, plans, id=1, sale_order_id=8, installment_date="2023-03-01", amount=60)
    add(rows, plans, id=2, sale_order_id=8, installment_date="2023-04-01", amount=40)
    add(rows, plans, id=3, sale_order_id=10, amount=100)
    # A plan of a cancelled order does not count.
    add(rows, plans, id=4, sale_order_id=4, installment_date="2023-03-01", amount=1)

    # 20 partly invoiced, on two invoices.
    add_order(rows, 20)
    add_item(rows, 20, 20, quantity=10)
    add_invoice(rows, 20)
    add_invoice(rows, 21)
    add_line(rows, 20, 20, 20, 3)
    add_line(rows, 21, 20, 21, 4)
    # 22 not invoiced.
    add_order(rows, 22)
    add_item(rows, 22, 22)
    # 23 two payment terms: rows and item totals double.
    add_order(rows, 23)
    add_item(rows, 23, 23, quantity=10)
    add_invoice(rows, 23)
    add_line(rows, 23, 23, 23, 5)
    for term in ("ADVANCE", "CASH_ON_DELIVERY"):
        add(rows, "sale_order_payment_terms", sale_order_id=23, payment_term=term)
    # 24 on delivery but not delivered; 25 delivered.
    for n in (24, 25):
        invoiced(rows, n)
        due_after(rows, n, 5)
        rows["invoice_items"][-1]["shipment_item_id"] = n
        add(rows, "shipment_items", id=n, shipment_id=n)
        add(rows, "shipments", id=n, sale_order_id=n, created_at="2023-01-05 00:00:00")
    add(rows, "sale_order_payment_terms", sale_order_id=24, payment_term="CASH_ON_DELIVERY")
    logs = "shipment_state_logs"
    for at in ("2023-03-03 10:30:00", "2023-03-01 10:30:00"):
        add(rows, logs, shipment_id=25, state="DELIVERED", created_at=at)
    add(rows, logs, shipment_id=25, state="PACKED", created_at="2023-02-28 23:00:00")
    # 26 an invoice item whose invoice is missing.
    add_order(rows, 26)
    add_item(rows, 26, 26)
    add_line(rows, 26, 26, 999, 2)
    # Not in the table: other states, other products.
    add_order(rows, 27, state="CREATED")
    add_item(rows, 27, 27)
    add_order(rows, 28)
    add_item(rows, 28, 28, kind="App\\Models\\Service")

    # Products: book 500 and edition product 500 share the id.
    add(rows, "edition_product_types", id=500, edition_id=5, ref_code="R5")
    add(rows, "editions", id=5, title_id=6, name="E5")
    add(rows, "titles", id=6, name="T6", master_title_type_id=7, master_title_sub_type_id=8)
    add(rows, "master_title_types", id=7, name="Type7")
    add(rows, "master_title_sub_types", id=8, name="Sub8")
    add(rows, "standard_meta_data", id=9, abbr="S9")
    add(rows, "standard_meta_data", id=10, abbr="S10")
    add(rows, "customized_books", id=500, name="B500", standard_meta_data_id=10)
    add_order(rows, 30)
    for item, kind, parent in (
        (30, EDITION, STANDARD), (31, BOOK, STANDARD), (32, EDITION, NOTEBOOK),
        (33, BOOK, None), (34, EDITION, None),
    ):
        add_item(
            rows, item, 30, kind=kind, saleable_id=500,
            itemParentable_type=parent, itemParentable_id=9,
        )

    # Organisation: branch 1 has a manager with two contact rows, branch 2 one without title.
    for n, salutation in ((1, "Dr"), (2, None)):
        add(rows, "branches", id=n, name=f"Branch {n}", sales_group_id=n)
        add(rows, "sales_groups", id=n, name=f"Group {n}", rsm=n)
        add(rows, "employees", id=n, contact_id=n)
        add(
            rows, "contact_individual_details", contact_id=n, salutation=salutation,
            first_name="Ada", last_name="B",
        )
    add(
        rows, "contact_individual_details", contact_id=1, salutation="Dr", first_name="Ada",
        last_name="C",
    )
    add_order(rows, 40, branch_id=1)
    add_order(rows, 41, branch_id=2)
    add_order(rows, 42, contactable_type=CUSTOMER, contactable_id=1)
    add_order(rows, 43, contactable_type="App\\Models\\Vendor", contactable_id=1)
    add(rows, "customers", id=1, billing_name="Shop", role_id=1)
    add(rows, "c_roles", id=1, name="Retail")
    for n in (40, 41, 42, 43):
        add_item(rows, n, n)
    add_invoice(rows, 40)
    add_line(rows, 40, 40, 40, 5)

    # Addresses.
    for n, text in enumerate(
        [
            r'"{\"city\": \"Pune\", \"pincode\": 411001, \"state\": \"MH\"}"',
            "'{\"city\": \"Pune\", \"pincode\": \"411001\", \"state\": \"MH\"}'",
            "\"{'city': 'None Such', 'pincode': None, 'state': 'MH'}\"",
            None,
            "no address",
            "'{\"city\": \"Pune\"}'",
        ],
        start=50,
    ):
        add_order(rows, n, billing_address=text)
        add_item(rows, n, n)
    return rows


@pytest.fixture(scope="module")
def tables(spark, rows):
    return make_tables(spark, rows)


@pytest.fixture(scope="module")
def detail(tables):
    found = {}
    for row in build_detail(tables, settings=Settings(fetched_at=NOW)).collect():
        found.setdefault(row["sale_order_id"], []).append(row)
    return found


def test_columns(tables):
    wide = build_wide(tables, settings=Settings(fetched_at=NOW))
    assert len(wide_columns()) == 68
    assert [(f.name, f.dataType) for f in wide.schema] == [
        (f.name, f.dataType) for f in wide_schema()
    ]


@pytest.mark.parametrize(
    "order, score",
    [
        (1, 100.0), (2, 97.5), (3, -50.0), (4, -100.0), (5, None), (6, None), (7, None),
        (8, 100.0), (9, None), (10, None),
    ],
)
def test_score(detail, order, score):
    assert [r["payment_score"] for r in detail[order]] == [score]


def test_installments(detail):
    row = detail[8][0]
    assert row["is_installment"] == 1
    assert row["installment_dates"] == "2023-03-01,2023-04-01"
    assert row["installment_amounts"] == "60.00,40.00"
    assert (detail[10][0]["is_installment"], detail[10][0]["installment_dates"]) == (1, None)
    assert (detail[4][0]["is_installment"], detail[4][0]["installment_dates"]) == (0, None)


def test_payment_lists(detail):
    assert detail[2][0]["payment_dates"] == "2023-01-15,2023-02-20"
    assert detail[2][0]["all_payments"] == "50.00,50.00"
    assert detail[5][0]["all_payments"] is None


def test_partly_invoiced(detail):
    rows = sorted(detail[20], key=lambda r: r["invoice_item_id"])
    assert [r["ii_quantity"] for r in rows] == [3, 4]
    for row in rows:
        assert row["final_ii_quantity"] == 7
        assert row["is_invoiced"] == 1
        assert row["is_partially_invoiced"] == 1
        assert row["non_invoiced_quantity"] == 3
        assert row["is_both_invoiced"] == 0
        assert row["total_unit_price_without_tax"] == row["ii_quantity"] * 10


def test_two_invoices_as_intended(tables):
    wide = build_wide(
        tables, settings=Settings(compat=False), columns=["sale_order_id", "is_both_invoiced"]
    )
    assert {r[0] for r in wide.filter("is_both_invoiced = 1").collect()} == {20}


def test_not_invoiced(detail):
    row = detail[22][0]
    assert (row["ii_quantity"], row["final_ii_quantity"]) == (0, 0)
    assert (row["is_invoiced"], row["is_partially_invoiced"]) == (0, 0)
    assert row["non_invoiced_quantity"] == 10
    assert row["invoice_item_id"] is None and row["invoice_id"] is None
    assert row["invoice_total_with_tax"] == 0


def test_missing_invoice(detail):
    row = detail[26][0]
    assert row["invoice_id"] is None and row["invoice_item_id"] == 26
    assert row["final_ii_quantity"] == 2 and row["is_invoiced"] == 1


def test_repeated_terms(detail):
    assert len(detail[23]) == 2
    assert {r["payment_term"] for r in detail[23]} == {"ADVANCE", "CASH_ON_DELIVERY"}
    assert all(r["final_ii_quantity"] == 10 for r in detail[23])
    assert all(r["is_partially_invoiced"] == 0 for r in detail[23])


def test_repeated_contacts(detail):
    assert sorted(r["rsm"] for r in detail[40]) == ["Dr Ada B", "Dr Ada C"]
    assert all(r["final_ii_quantity"] == 10 for r in detail[40])
    assert [r["rsm"] for r in detail[41]] == [None]
    assert detail[41][0]["branch_name"] == "Branch 2"
    assert detail[41][0]["sales_group_name"] == "Group 2"


def test_delivery(detail):
    waiting, delivered = detail[24][0], detail[25][0]
    assert waiting["delivery_date"] == datetime(2023, 2, 1)
    assert waiting["payment_commitment_date"] is None
    assert delivered["delivery_date"] == datetime(2023, 3, 1, 10, 30)
    assert delivered["payment_commitment_date"] == datetime(2023, 3, 6, 10, 30)
    assert delivered["packed_2_delivered_tat_day"] == 1
    assert delivered["packed_2_delivered_tat_seconds"] == 11.5 * 3600
    assert detail[1][0]["payment_commitment_date"] == datetime(2023, 2, 10)


def test_filters(detail):
    assert 27 not in detail and 28 not in detail


def test_products(detail):
    items = {r["sale_order_item_id"]: r for r in detail[30]}
    assert {i: r["title_name"] for i, r in items.items()} == {
        30: "T6", 31: "B500", 32: "T6", 33: "B500", 34: "T6",
    }
    # A standard parent gives nothing for a book, and books keep the edition they collide with.
    assert {i: r["meta_data"] for i, r in items.items()} == {
        30: "S9", 31: None, 32: "Notebook", 33: "S10", 34: None,
    }
    assert {r["edition_name"] for r in items.values()} == {"E5"}
    assert {r["master_title_type"] for r in items.values()} == {"Type7"}
    assert items[31]["saleable_type"] == "CustomizedBook" and items[31]["is_customized"] == 1
    assert items[30]["itemParentable_type"] == "StandardMetaData"
    assert items[33]["itemParentable_type"] is None


def test_customers(detail):
    assert (detail[42][0]["customer_name"], detail[42][0]["customer_category"]) == ("Shop", "Retail")
    assert detail[43][0]["customer_name"] is None
    assert detail[43][0]["contactable_type"] == "App\\Models\\Vendor"


@pytest.mark.parametrize(
    "order, address, rejected",
    [
        (50, ("Pune", "411001", "MH"), False),
        (51, ("Pune", "411001", "MH"), False),
        (52, ("None Such", None, "MH"), False),
        (53, (None, None, None), False),
        (54, (None, None, None), True),
        (55, ("Pune", None, None), False),
    ],
)
def test_addresses(detail, order, address, rejected):
    row = detail[order][0]
    assert (row["address_city"], row["address_pincode"], row["address_state"]) == address
    assert row["address_rejected"] == rejected


def test_fetch_date(detail):
    assert {r["fetch_date"] for rs in detail.values() for r in rs} == {NOW}


def test_some_orders(spark, tables, detail):
    for ids in ([], [2, 20, 23, 25, 40]):
        frame = spark.createDataFrame([(i,) for i in ids], "sale_order_id long")
        built = build_detail(tables, frame, Settings(fetched_at=NOW)).collect()
        expected = [r for i in ids for r in detail[i]]
        assert sorted(map(str, built)) == sorted(map(str, expected))


def test_some_columns(tables, detail):
    whole = [r for rows in detail.values() for r in rows]
    for columns in (
        ["sale_order_id", "ii_quantity"], ["is_partially_invoiced", "meta_data", "rsm"],
        ["installment_dates", "payment_commitment_date"],
    ):
        some = build_detail(tables, settings=Settings(fetched_at=NOW), columns=columns).collect()
        expected = sorted(tuple(str(r[c]) for c in columns) for r in whole)
        assert sorted(tuple(map(str, r)) for r in some) == expected


def test_unknown_column(tables):
    with pytest.raises(ValueError):
        build_wide(tables, columns=["nonsense"])


def test_case(spark):
    rows = {}
    add_order(rows, 1, state="Completed")
    add_item(rows, 1, 1, kind="App\\Models\\editionproducttype")
    tables = make_tables(spark, rows)
    columns = ["sale_order_id"]
    assert build_wide(tables, columns=columns).count() == 0
    assert build_wide(tables, settings=Settings(ignore_case=True), columns=columns).count() == 1


def test_amounts(spark):
    rows = {}
    invoiced(rows, 1)
    add_payment(rows, 1, 1, 10, "2023-02-10", mode="CASH", credited_at="2023-01-31 00:00:00")
    add_payment(rows, 2, 1, 20, "2023-02-10", mode="CHEQUE")
    add_payment(rows, 3, 1, 30, "2023-02-11", mode="ONLINE", state="PARTIAL_SETTLED")
    add_payment(rows, 4, 1, 40, "2023-02-11", mode="CASH", state="PENDING")
    columns = ["advance_amount", "cash_amount", "cheque_amount", "online_amount"]
    (row,) = build_wide(make_tables(spark, rows), columns=columns).collect()
    # Every payment has an invoice entry of its own here, so nothing is counted twice.
    assert tuple(row) == tuple(map(Decimal, ("10.00", "10.00", "20.00", "30.00")))


def test_detail_columns_exist(detail):
    assert set(DETAIL_COLUMNS) <= set(detail[1][0].asDict())
