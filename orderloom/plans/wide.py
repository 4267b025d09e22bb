"""The wide table: one row per order item and invoice item.

Rows multiply where an order has several payment terms or its sales manager several contact
rows; analysts' sums include these repeats, so they are kept.

Every join on `id` relies on `id` being the table's primary key. That gives three freedoms
the optimizer does not have: joins whose columns nobody asked for can be left out, totals per
item can be aggregated before the joins and scaled by the known number of repeats, and each
join has one side with few rows per key, which is what `attach` and `expand` need.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.constants import (
    CANCELLED, CUSTOMER, CUSTOMIZED_BOOK, EDITION_PRODUCT, NOTEBOOK_LABEL,
    NOTEBOOK_TITLE_DETAIL, STANDARD_META_DATA,
)
from orderloom.functions.address import ADDRESS_FIELDS, decode_address, is_rejected
from orderloom.functions.matching import class_name, ends_with, equals
from orderloom.functions.scoring import payment_score
from orderloom.operators import dimensions, tat, terms
from orderloom.operators.eligible import eligible_items, eligible_orders
from orderloom.operators.hotkeys import Searches, attach, expand, heavy_keys, hot_keys, none_heavy
from orderloom.operators.ledger import payment_keys, payments_by_invoice
from orderloom.operators.restrict import restricted
from orderloom.schemas import wide_schema
from orderloom.settings import Settings

Tables = Mapping[str, DataFrame]

_TERMS, _DAYS = "sale_order_payment_terms", "sale_order_payment_term_after_deliveries"

# Output columns that need a group of joins. A group none of whose columns is asked for is
# left out; joins that can multiply rows are always made.
_GROUPS = {
    "products": {
        "title_name", "edition_name", "ref_code", "master_title_type",
        "master_title_sub_type", "meta_data",
    },
    "meta": {"meta_data"},
    "customers": {"customer_name", "customer_category"},
    "payments": {
        "payment_score", "advance_amount", "cash_amount", "cheque_amount", "online_amount",
        "all_payments", "payment_dates",
    },
    "payment_lists": {"all_payments", "payment_dates"},
    "payment_totals": {
        "payment_score", "advance_amount", "cash_amount", "cheque_amount", "online_amount",
    },
    "score": {"payment_score"},
    "delivery": {"payment_score", "delivery_date", "payment_commitment_date"},
    "installments": {
        "payment_score", "is_installment", "installment_dates", "installment_amounts",
    },
    "plans": {"installment_dates", "installment_amounts"},
    "shipment_tat": {"packed_2_delivered_tat_day", "packed_2_delivered_tat_seconds"},
    "order_tat": {
        "create_2_processing_tat_day", "create_2_processing_tat_seconds",
        "processing_2_complete_tat_day", "processing_2_complete_tat_seconds",
    },
    "totals": {
        "final_ii_quantity", "is_invoiced", "is_partially_invoiced", "non_invoiced_quantity",
    },
    "invoice_counts": {"is_both_invoiced"},
}

# Columns of the detail frame that the wide table does not have.
DETAIL_COLUMNS = [
    "payment_term", "is_shipment", "payment_after_no_of_days", "delivery_date",
    "payment_commitment_date", "is_installment", "installment_dates", "installment_amounts",
    "all_payments", "payment_dates", "billing_address", "address_rejected",
    "packed_2_delivered_tat_seconds", "create_2_processing_tat_seconds",
    "processing_2_complete_tat_seconds",
]


def _repeated(
    orders: DataFrame, many: DataFrame, count: str, counted: bool, hot: dict | None = None
) -> DataFrame:
    """Left join a table with any number of rows per order, adding that number if needed."""
    if counted:
        counts = many.groupBy("sale_order_id").agg(F.count(F.lit(1)).alias(count))
        orders = orders.join(counts, "sale_order_id", "left")
    else:
        orders = orders.withColumn(count, F.lit(None).cast("bigint"))
    hot = hot_keys(many, "sale_order_id") if hot is None else hot
    if not any(key is not None for key in hot["sale_order_id"]):
        return orders.join(many, "sale_order_id", "left")
    # Equal rows get a number, so that a hot order's rows can be told apart and spread.
    columns = [c for c in many.columns if c != "sale_order_id"]
    numbered = many.groupBy(*many.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))
    ).drop("_n")
    spread = [*columns, "_nth"]
    return expand(orders, numbered, "sale_order_id", hot["sale_order_id"], spread).drop("_nth")


def order_headers(
    tables: Tables, settings: Settings = Settings(), needs=None, found: Searches | None = None
) -> DataFrame:
    """Order attributes; `repeats` is the number of rows the order has here."""
    needs = needs or (lambda group: True)
    if found is None:
        with Searches() as found:
            search(tables, settings, needs, found, "orders", "terms", "days", "lines")
            return order_headers(tables, settings, needs, found)
    orders = eligible_orders(tables, settings).select(
        F.col("id").alias("sale_order_id"),
        F.col("sale_order_date").cast("timestamp_ntz").alias("sale_order_date"),
        F.col("net_total").alias("sale_order_net_total"),
        "sales_channel",
        F.col("state").alias("order_state"),
        "is_shipment",
        "contactable_type",
        "contactable_id",
        "branch_id",
        "billing_address",
    )
    hot = found["orders"]
    # The decoded address is a column of its own first, so that it is parsed once.
    orders = orders.withColumn("address", decode_address(F.col("billing_address")))
    orders = orders.withColumns(
        {
            **{f"address_{name}": F.col("address")[name] for name in ADDRESS_FIELDS},
            "address_rejected": is_rejected(F.col("billing_address"), F.col("address")),
        }
    ).drop("address")
    row = ["sale_order_id"]
    if needs("customers"):
        is_customer = ends_with(F.col("contactable_type"), CUSTOMER, settings.ignore_case)
        orders = attach(
            orders, dimensions.customers(tables), "contactable_id", hot["contactable_id"], row
        )
        for name in ("customer_name", "customer_category"):
            orders = orders.withColumn(name, F.when(is_customer, F.col(name)))
    orders = attach(
        orders, dimensions.sales_organisation(tables), "branch_id", hot["branch_id"], row
    )

    # From here on everything is joined by order, on one shuffle of the orders.
    if needs("installments"):
        plans = needs("plans")
        due = terms.installment_plans(tables) if plans else terms.installment_due(tables)
        open_plan = F.col("installments").isNotNull() & ~equals(
            F.col("order_state"), CANCELLED, settings.ignore_case
        )
        orders = orders.join(due, "sale_order_id", "left").withColumn(
            "is_installment", F.when(open_plan, 1).otherwise(0)
        )
    if needs("shipment_tat"):
        orders = orders.join(tat.shipment_tat(tables, settings), "sale_order_id", "left")
    if needs("order_tat"):
        orders = orders.join(tat.order_tat(tables, settings), "sale_order_id", "left")
    if needs("invoice_counts") and not settings.compat:
        orders = orders.join(order_invoices(tables, settings, found["lines"]), "sale_order_id", "left")

    payment_terms = tables[_TERMS].select("sale_order_id", "payment_term")
    after_days = tables[_DAYS].select(
        "sale_order_id", F.col("no_of_days").alias("payment_after_no_of_days")
    )
    counted = needs("totals")
    orders = _repeated(orders, payment_terms, "n_terms", counted, found["terms"])
    orders = _repeated(orders, after_days, "n_days", counted, found["days"])
    repeats = F.lit(1)
    for count in ("n_terms", "n_days", "contacts"):
        repeats = repeats * F.coalesce(F.col(count), F.lit(1))
    return orders.withColumn("repeats", repeats).drop("n_terms", "n_days", "contacts")


def search(tables: Tables, settings: Settings, needs, found: Searches, *names: str) -> None:
    """Start the searches for hot keys of the joins that the wanted columns need, or of some of them.

    Each takes one pass over its table, for all keys together.
    """

    def lines() -> dict:
        keys = ["sale_order_item_id", "invoice_id", *(["shipment_item_id"] if needs("delivery") else [])]
        return hot_keys(tables["invoice_items"], *keys)

    def orders() -> dict:
        keys = ["branch_id", *(["contactable_id"] if needs("customers") else [])]
        return hot_keys(eligible_orders(tables, settings), *keys)

    def items() -> dict:
        keys = ["saleable_id", *(["itemParentable_id"] if needs("meta") else [])]
        return hot_keys(eligible_items(tables, settings), *keys) if needs("products") else {}

    searches: dict[str, tuple] = {
        # The longest first.
        "heavy": (heavy_orders, tables, settings),
        "lines": (lines,),
        "orders": (orders,),
        "items": (items,),
        "payments": (lambda: payment_keys(tables, settings) if needs("payments") else {},),
        "shipped": (lambda: hot_keys(tables["shipment_items"], "shipment_id") if needs("delivery") else {},),
        "terms": (lambda: hot_keys(tables[_TERMS], "sale_order_id"),),
        "days": (lambda: hot_keys(tables[_DAYS], "sale_order_id"),),
    }
    for name in names or searches:
        found.start(name, *searches[name])


def invoice_lines(
    tables: Tables, settings: Settings = Settings(), needs=None, found: Searches | None = None
) -> DataFrame:
    """Invoice items with their invoice, its payments and the first delivery."""
    needs = needs or (lambda group: True)
    if found is None:
        with Searches() as found:
            search(tables, settings, needs, found, "lines", "shipped", "payments")
            return invoice_lines(tables, settings, needs, found)
    hot = found["lines"]
    lines = tables["invoice_items"].select(
        "sale_order_item_id",
        F.col("id").alias("invoice_item_id"),
        "invoice_id",
        "shipment_item_id",
        F.col("quantity").alias("invoiced_quantity"),
        F.col("is_bill").alias("invoice_item_is_bill"),
        F.col("is_dc").alias("invoice_item_is_dc"),
    )
    row = ["invoice_item_id"]
    invoices = tables["invoices"].select(
        F.col("id").alias("invoice_id"),
        F.col("id").alias("found_invoice_id"),
        F.col("prefix").alias("invoice_prefix"),
        F.col("is_bill").alias("invoice_is_bill"),
        F.col("cr_dr_state").alias("invoice_cr_dr_state"),
        F.col("state").alias("invoice_state"),
        F.col("round_off").alias("invoice_round_off"),
        F.col("date").cast("timestamp_ntz").alias("invoice_date"),
        F.col("net_total").alias("invoice_net_total"),
    )
    if needs("payments"):
        payments = payments_by_invoice(
            tables, settings, found["payments"], needs("payment_lists"), needs("payment_totals")
        )
        if not needs("score"):
            payments = payments.drop("payments")
        invoices = invoices.join(payments, "invoice_id", "left")

    if needs("delivery"):
        shipped = tables["shipment_items"].select(
            F.col("id").alias("shipment_item_id"), "shipment_id"
        )
        shipped = attach(
            shipped, tat.first_delivery(tables, settings), "shipment_id",
            found["shipped"]["shipment_id"], ["shipment_item_id"],
        ).drop("shipment_id")
        lines = attach(lines, shipped, "shipment_item_id", hot["shipment_item_id"], row)
    lines = attach(lines, invoices, "invoice_id", hot["invoice_id"], row)
    return lines.drop("invoice_id", "shipment_item_id").withColumnRenamed(
        "found_invoice_id", "invoice_id"
    )


def item_totals(tables: Tables) -> DataFrame:
    """Invoiced quantity and number of invoice items per order item."""
    quantity = F.coalesce(F.col("quantity"), F.lit(0))
    return tables["invoice_items"].groupBy("sale_order_item_id").agg(
        F.sum(quantity).alias("item_quantity"), F.count(F.lit(1)).alias("item_lines")
    )


def heavy_orders(tables: Tables, settings: Settings = Settings()) -> dict:
    """Orders with many rows once their items are expanded by invoice items.

    Counted, not expanded: the number of invoice items per item, summed by order. They are summed
    only if some order can be heavy, by its number of items and the most invoice items one of them has.
    """
    items = eligible_items(tables, settings).select(
        F.col("id").alias("sale_order_item_id"), "sale_order_id"
    )
    lines = item_totals(tables).select("sale_order_item_id", "item_lines")
    most = lines.filter("sale_order_item_id is not null").agg(F.max("item_lines")).first()[0] or 1
    if none_heavy(items, "sale_order_id", most):
        return {}
    weights = (
        items.join(lines, "sale_order_item_id", "left")
        .groupBy("sale_order_id")
        .agg(F.sum(F.coalesce(F.col("item_lines"), F.lit(1))).alias("weight"))
    )
    return heavy_keys(weights, "sale_order_id", "weight")


def order_invoices(tables: Tables, settings: Settings, hot: dict) -> DataFrame:
    """First and last invoice per order, over eligible items: they differ if there are several.

    Taken per item first, then per order; both steps combine before they shuffle, so neither a hot
    item nor a hot order meets in one task, and no pairs of orders and invoices are made.
    """
    lines = tables["invoice_items"].select(
        F.col("id").alias("invoice_item_id"), "sale_order_item_id", "invoice_id"
    )
    known = tables["invoices"].select(F.col("id").alias("invoice_id"))
    lines = attach(lines, known, "invoice_id", hot["invoice_id"], ["invoice_item_id"], "inner")
    ends = [F.min("invoice_id").alias("first_invoice"), F.max("invoice_id").alias("last_invoice")]
    items = eligible_items(tables, settings).select(
        F.col("id").alias("sale_order_item_id"), "sale_order_id"
    )
    per_item = items.join(lines.groupBy("sale_order_item_id").agg(*ends), "sale_order_item_id")
    return per_item.groupBy("sale_order_id").agg(
        F.min("first_invoice").alias("first_invoice"), F.max("last_invoice").alias("last_invoice")
    )


def order_items(
    tables: Tables, settings: Settings = Settings(), needs=None, found: Searches | None = None
) -> DataFrame:
    """Eligible items with their product attributes."""
    needs = needs or (lambda group: True)
    if found is None:
        with Searches() as found:
            search(tables, settings, needs, found, "items")
            return order_items(tables, settings, needs, found)
    anyhow = settings.ignore_case
    is_customized = ends_with(F.col("saleable_type"), CUSTOMIZED_BOOK, anyhow)
    items = eligible_items(tables, settings).select(
        F.col("id").alias("sale_order_item_id"),
        "sale_order_id",
        "itemParentable_type", "itemParentable_id", "saleable_type", "saleable_id",
        F.col("discount_percentage").alias("sale_order_item_discount_percentage"),
        F.col("mrp").alias("sale_order_item_mrp"),
        "unit_price_with_tax", "unit_price_without_tax",
        "cgst_tax_rate", "sgst_tax_rate", "igst_tax_rate",
        "cgst_tax_amount", "sgst_tax_amount", "igst_tax_amount",
        "is_dc", "quantity",
        F.when(is_customized, 1).otherwise(0).alias("is_customized"),
    )
    row = ["sale_order_item_id"]
    if needs("products"):
        hot = found["items"]
        for products in (dimensions.edition_products(tables), dimensions.customized_books(tables)):
            items = attach(items, products, "saleable_id", hot["saleable_id"], row)
        # Books only apply to customised items; edition products apply to any item whose
        # product id matches.
        is_book = (F.col("is_customized") == 1) & F.coalesce(F.col("is_book"), F.lit(False))
        items = items.withColumn(
            "title_name", F.when(is_book, F.col("book_title")).otherwise(F.col("catalog_title"))
        )
        if needs("meta"):
            items = attach(
                items, dimensions.standard_meta(tables), "itemParentable_id",
                hot["itemParentable_id"], row,
            )
            parent = F.col("itemParentable_type")
            is_edition = ends_with(F.col("saleable_type"), EDITION_PRODUCT, anyhow)
            items = items.withColumn(
                "meta_data",
                F.when(
                    ends_with(parent, STANDARD_META_DATA, anyhow),
                    F.when(is_edition, F.col("standard_abbr")),
                )
                .when(ends_with(parent, NOTEBOOK_TITLE_DETAIL, anyhow), F.lit(NOTEBOOK_LABEL))
                .when(is_book, F.col("book_abbr")),
            ).drop("standard_abbr")
        items = items.drop("is_book", "book_title", "book_abbr", "catalog_title")
    return items


def build_detail(
    tables: Tables,
    ids: DataFrame | None = None,
    settings: Settings = Settings(),
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """The wide table with the intermediate columns it is computed from.

    `ids` (one column `sale_order_id`, distinct) limits it to some orders: the source tables
    are first reduced to these, see `restricted`. `columns` limits the result to some columns
    and leaves out the joins only the others need.
    """
    wide = wide_schema()
    wanted = list(columns) if columns is not None else wide.names + DETAIL_COLUMNS
    unknown = [c for c in wanted if c not in wide.names and c not in DETAIL_COLUMNS]
    if unknown:
        raise ValueError(f"unknown wide columns {unknown}")

    def needs(group: str) -> bool:
        return not _GROUPS[group].isdisjoint(wanted)

    if ids is not None:
        tables = restricted(tables, ids, settings)
    with Searches() as found:
        search(tables, settings, needs, found)
        return _joined(tables, settings, needs, found, wanted)


def _joined(tables: Tables, settings: Settings, needs, found: Searches, wanted: list[str]) -> DataFrame:
    """The joins of `build_detail`, cut where the searches found hot keys."""
    wide = wide_schema()
    rows = order_items(tables, settings, needs, found)
    totals = item_totals(tables).drop("item_lines") if needs("totals") else None
    lines = invoice_lines(tables, settings, needs, found)
    row = ["sale_order_item_id", "invoice_item_id"]
    hot = found["lines"]["sale_order_item_id"]
    rows = expand(rows, lines, "sale_order_item_id", hot, row[1:], totals)
    # The order attributes come last, so that they and the repeats they bring are only
    # shuffled at order grain.
    headers = order_headers(tables, settings, needs, found)
    rows = attach(rows, headers, "sale_order_id", found["heavy"], row, "inner")
    types = {f.name: f.dataType.simpleString() for f in wide}
    typed = [f"cast({c} as {types[c]}) as {c}" if c in types else c for c in wanted]
    return _finish(rows, settings, needs).selectExpr(*typed)


def _finish(rows: DataFrame, settings: Settings, needs) -> DataFrame:
    """Row-level expressions on the joined rows."""
    quantity = F.coalesce(F.col("invoiced_quantity"), F.lit(0))
    new: dict[str, Column] = {
        "ii_quantity": quantity,
        "invoice_total_with_tax": F.coalesce(F.col("invoice_net_total"), F.lit(0)),
        "total_unit_price_without_tax": quantity * F.col("unit_price_without_tax"),
        "itemParentable_type": class_name(F.col("itemParentable_type")),
        "saleable_type": class_name(F.col("saleable_type")),
        "fetch_date": (
            F.lit(settings.fetched_at.isoformat(sep=" ")).cast("timestamp_ntz")
            if settings.fetched_at
            else F.localtimestamp()
        ),
    }
    if needs("totals"):
        total = F.coalesce(F.col("item_quantity"), F.lit(0)) * F.col("repeats")
        new["final_ii_quantity"] = total
        new["is_invoiced"] = F.when(total > 0, 1).otherwise(0)
        new["is_partially_invoiced"] = F.when(
            (total > 0) & (F.col("quantity") > total), 1
        ).otherwise(0)
        new["non_invoiced_quantity"] = F.col("quantity") - total
    if needs("invoice_counts"):
        new["is_both_invoiced"] = (
            F.lit(0)
            if settings.compat
            else F.when(F.col("first_invoice") < F.col("last_invoice"), 1).otherwise(0)
        )
    if needs("delivery"):
        new["delivery_date"] = F.coalesce(F.col("delivered_at"), F.col("invoice_date"))
        commitment = terms.commitment_date(
            F.col("payment_term"), F.col("payment_after_no_of_days"),
            F.col("delivered_at"), F.col("invoice_date"), settings.ignore_case,
        )
        new["payment_commitment_date"] = commitment
    if needs("score"):
        due = F.when(F.col("is_installment") == 1, F.col("installment_due")).otherwise(
            F.to_date(commitment)
        )
        new["payment_score"] = payment_score(
            F.col("order_state"), F.coalesce(F.col("invoice_net_total"), F.lit(0)), due,
            F.col("payments"), settings.ignore_case,
        )
    if needs("plans"):
        for name in ("installment_dates", "installment_amounts"):
            new[name] = F.when(F.col("is_installment") == 1, F.col(name))
    return rows.withColumns(new)


def build_wide(
    tables: Tables,
    ids: DataFrame | None = None,
    settings: Settings = Settings(),
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """The wide table, or some of its columns; see `build_detail`."""
    names = wide_schema().names
    wanted = list(columns) if columns is not None else names
    return build_detail(tables, ids, settings, wanted)
