"""The source tables reduced to some orders."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.constants import INVOICE, PAYMENT
from orderloom.operators.eligible import eligible_items
from orderloom.operators.ledger import entries
from orderloom.settings import Settings
from orderloom.sources.shared import Bounds, bounds, keep_bounded, within
from orderloom.sources.tables import Tables

# Reduced tables that are read again, by searches for hot keys or to reduce other tables, and the
# ids that others are looked up by.
_KEPT = {
    "sale_orders": ("id",),
    "sale_order_items": ("id",),
    "invoice_items": ("invoice_id", "shipment_item_id"),
    "shipment_items": ("shipment_id",),
    "shipments": ("id",),
    "credit_debit_mappings": ("credit_id",),
    "ledger_transactions": ("ledgerable_id",),
}
_OF_ORDERS = (
    "sale_order_state_logs", "sale_order_payment_terms",
    "sale_order_payment_term_after_deliveries", "sale_order_payment_term_installments",
    "shipments",
)


def restricted(
    tables: Mapping[str, DataFrame], ids: DataFrame, settings: Settings = Settings()
) -> Tables:
    """Every source table with just the rows that belong to the orders in `ids`.

    Orders lead to items, these to invoice items, these to invoices and shipments, and invoices
    through the ledger to payments. Each large table is read once (the ledger once for invoices
    and once for payments), by a semi join with the ids found so far, and before anything else
    shuffles it. Items that are not eligible are left out; product, staff and customer tables
    stay whole.

    Each scan is also told the bounds of the ids that are looked for, so sources that are stored in
    order of ids or by ranges of them skip the rest. Being selective, they also let Spark build Bloom
    filters of the ids when these are too many for a broadcast.
    """
    found: dict[str, DataFrame] = {}
    # Least and largest id of each column that other tables are looked up by.
    ends: dict[str, dict[str, Bounds]] = {}
    # Searches ask for tables side by side; each is reduced once. A table needs others, never in a circle.
    locks: dict[str, Lock] = defaultdict(Lock)

    def only(frame: DataFrame, column: str, *sources: tuple[str, str]) -> DataFrame:
        """The rows whose `column` is a value of one of the given columns of reduced tables."""
        parts = [load(source).select(F.col(value).alias(column)) for source, value in sources]
        lows, highs = zip(*[ends[source][value] for source, value in sources])
        low = min((x for x in lows if x is not None), default=None)
        high = max((x for x in highs if x is not None), default=None)
        inside = within(column, (low, high))
        wanted = reduce(DataFrame.union, parts).filter(inside).distinct()
        return frame.filter(inside).join(wanted, column, "left_semi").select(*frame.columns)

    def load(name: str) -> DataFrame:
        with locks[name]:
            if name not in found:
                if name == "ids":
                    found[name] = ids
                    ends[name] = {"sale_order_id": bounds(ids, "sale_order_id")}
                elif name in _KEPT or name == "debits":
                    found[name], ends[name] = keep_bounded(reduced(name), name, *_KEPT.get(name, ("id",)))
                else:
                    found[name] = reduced(name)
            return found[name]

    def reduced(name: str) -> DataFrame:
        if name == "sale_orders":
            return only(tables[name], "id", ("ids", "sale_order_id"))
        if name == "sale_order_items":
            return only(eligible_items(tables, settings), "sale_order_id", ("ids", "sale_order_id"))
        if name in _OF_ORDERS:
            return only(tables[name], "sale_order_id", ("ids", "sale_order_id"))
        if name == "invoice_items":
            return only(tables[name], "sale_order_item_id", ("sale_order_items", "id"))
        if name == "invoices":
            return only(tables[name], "id", ("invoice_items", "invoice_id"))
        if name == "shipment_items":
            return only(tables[name], "id", ("invoice_items", "shipment_item_id"))
        if name == "shipment_state_logs":
            return only(tables[name], "shipment_id", ("shipments", "id"), ("shipment_items", "shipment_id"))
        if name == "debits":
            return only(entries(tables, INVOICE, settings), "ledgerable_id", ("invoice_items", "invoice_id"))
        if name == "credit_debit_mappings":
            return only(tables[name], "debit_id", ("debits", "id"))
        if name == "ledger_transactions":
            credits = only(entries(tables, PAYMENT, settings), "id", ("credit_debit_mappings", "credit_id"))
            return load("debits").unionByName(credits)
        if name == "payments":
            return only(tables[name], "id", ("ledger_transactions", "ledgerable_id"))
        return tables[name]

    return Tables(load)
