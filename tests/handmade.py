"""Source tables from hand-written rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import types as T

from orderloom.schemas import SOURCE_TABLES, struct
from orderloom.sources.tables import Tables, from_frames

EDITION = "App\\Models\\EditionProductType"
BOOK = "App\\Models\\CustomizedBook"
CUSTOMER = "App\\Models\\Customer"
INVOICE = "App\\Models\\Invoice"
PAYMENT = "App\\Models\\Payment"
STANDARD = "App\\Models\\StandardMetaData"
NOTEBOOK = "App\\Models\\NotebookTitleDetail"


def _fit(value, kind):
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)) and isinstance(value, str):
        return datetime.fromisoformat(value)
    if isinstance(kind, T.DateType) and isinstance(value, str):
        return date.fromisoformat(value)
    return value


def make_tables(spark, rows: dict[str, list[dict]]) -> Tables:
    """Tables with the given rows; columns and tables not mentioned are NULL or empty."""
    frames = {}
    for name, ddl in SOURCE_TABLES.items():
        schema = struct(ddl)
        data = []
        for row in rows.get(name, []):
            unknown = set(row) - set(schema.names)
            assert not unknown, (name, unknown)
            data.append(tuple(_fit(row.get(f.name), f.dataType) for f in schema))
        frames[name] = spark.createDataFrame(data, schema).coalesce(1)
    return from_frames(frames)


def add(rows: dict[str, list[dict]], table: str, **row) -> None:
    rows.setdefault(table, []).append(row)


def add_order(rows, id, state="COMPLETED", created="2023-01-01 00:00:00", **more) -> None:
    add(
        rows, "sale_orders", id=id, state=state, created_at=created, updated_at=created, **more
    )


def add_item(rows, id, order, quantity=10, price=10, kind=EDITION, **more) -> None:
    add(
        rows, "sale_order_items", id=id, sale_order_id=order, quantity=quantity,
        unit_price_without_tax=price, saleable_type=kind, **more,
    )


def add_invoice(rows, id, total=100, date="2023-02-01 00:00:00", **more) -> None:
    add(rows, "invoices", id=id, net_total=total, date=date, **more)


def add_line(rows, id, item, invoice, quantity, **more) -> None:
    add(
        rows, "invoice_items", id=id, sale_order_item_id=item, invoice_id=invoice,
        quantity=quantity, **more,
    )


def add_payment(
    rows, id, invoice, amount, on, mode="CASH", state="SETTLED",
    invoiced_at="2023-02-01 00:00:00", credited_at="2023-02-02 00:00:00", **more,
) -> None:
    """A payment with its mapping and both ledger entries; ids follow from `id`."""
    add(
        rows, "ledger_transactions", id=1000 + id, ledgerable_type=INVOICE, ledgerable_id=invoice,
        state="ACTIVE", transaction_datetime=invoiced_at,
    )
    add(
        rows, "ledger_transactions", id=2000 + id, ledgerable_type=PAYMENT, ledgerable_id=id,
        state="ACTIVE", transaction_datetime=credited_at,
    )
    add(rows, "credit_debit_mappings", debit_id=1000 + id, credit_id=2000 + id, amount=amount)
    add(rows, "payments", id=id, cr_dr_state=state, mode=mode, transaction_date=on, **more)
