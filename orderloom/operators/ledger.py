"""Payments of invoices, through the ledger: invoice entry -> mapping -> payment entry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.constants import (
    CASH, CHEQUE, INVOICE, LEDGER_ACTIVE, ONLINE, PAYMENT, SETTLED_STATES,
)
from orderloom.functions.lists import listed as listed_rows
from orderloom.functions.matching import ends_with, equals, one_of
from orderloom.operators.hotkeys import Searches, attach, hot_keys
from orderloom.settings import Settings


def entries(tables: Mapping[str, DataFrame], kind: str, settings: Settings) -> DataFrame:
    """Active ledger entries of one kind of document."""
    anyhow = settings.ignore_case
    return tables["ledger_transactions"].filter(
        equals(F.col("state"), LEDGER_ACTIVE, anyhow)
        & ends_with(F.col("ledgerable_type"), kind, anyhow)
    )


def all_entries(tables: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """Active ledger entries of invoices and payments."""
    anyhow = settings.ignore_case
    kind = F.col("ledgerable_type")
    return tables["ledger_transactions"].filter(
        equals(F.col("state"), LEDGER_ACTIVE, anyhow)
        & (ends_with(kind, INVOICE, anyhow) | ends_with(kind, PAYMENT, anyhow))
    )


def payment_keys(tables: Mapping[str, DataFrame], settings: Settings = Settings()) -> dict:
    """Hot keys of the payment entries and of the mappings."""
    credits = entries(tables, PAYMENT, settings).select(F.col("ledgerable_id").alias("payment_id"))
    with Searches() as found:
        found.start("credits", hot_keys, credits, "payment_id")
        found.start("mappings", hot_keys, tables["credit_debit_mappings"], "debit_id", "credit_id")
        return found["credits"] | found["mappings"]


def payment_lines(
    tables: Mapping[str, DataFrame],
    settings: Settings = Settings(),
    hot: dict | None = None,
) -> DataFrame:
    """One row per settled payment mapped to an invoice.

    Advances and payment modes both read this one chain of joins. `hot` are the `payment_keys`,
    if they are known.
    """
    hot = payment_keys(tables, settings) if hot is None else hot
    debits = entries(tables, INVOICE, settings).select(
        F.col("id").alias("debit_id"),
        F.col("ledgerable_id").alias("invoice_id"),
        F.col("transaction_datetime").alias("invoiced_at"),
    )
    credits = entries(tables, PAYMENT, settings).select(
        F.col("id").alias("credit_id"),
        F.col("ledgerable_id").alias("payment_id"),
        F.col("transaction_datetime").alias("credited_at"),
    )
    payments = (
        tables["payments"]
        .filter(one_of(F.col("cr_dr_state"), SETTLED_STATES, settings.ignore_case))
        .select(F.col("id").alias("payment_id"), "mode", F.col("transaction_date").alias("paid_on"))
    )
    mappings = tables["credit_debit_mappings"].select("debit_id", "credit_id", "amount")
    credits = attach(credits, payments, "payment_id", hot["payment_id"], ["credit_id"], "inner")
    row = ["debit_id", "credit_id", "amount"]
    lines = attach(mappings, debits, "debit_id", hot["debit_id"], row, "inner")
    lines = attach(lines, credits, "credit_id", hot["credit_id"], row, "inner")
    return lines.select(
        "invoice_id",
        "paid_on",
        "amount",
        "mode",
        (F.col("invoiced_at") > F.col("credited_at")).alias("is_advance"),
    )


def daily_payments(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Payment lines summed per invoice and day; a missing day is a group of its own."""

    def paid_by(mode: str):
        matches = equals(F.col("mode"), mode, settings.ignore_case)
        return F.sum(F.when(matches, F.col("amount")).otherwise(F.lit(0)))

    return lines.groupBy("invoice_id", "paid_on").agg(
        F.sum("amount").alias("amount"),
        F.count("amount").alias("payments"),
        F.sum(F.when(F.col("is_advance"), F.col("amount"))).alias("advance_amount"),
        paid_by(CASH).alias("cash_amount"),
        paid_by(CHEQUE).alias("cheque_amount"),
        paid_by(ONLINE).alias("online_amount"),
    )


def payments_by_invoice(
    tables: Mapping[str, DataFrame],
    settings: Settings = Settings(),
    hot: dict | None = None,
    lists: bool = False,
    totals: bool = True,
) -> DataFrame:
    """Per invoice: advances, totals by mode, and the payments as a list by day.

    A day's payments are summed before the list is built, so the list is no longer than
    there are days, however many payments an invoice has. With `lists` also `payment_lists`;
    without `totals` nothing else, which spares the payment lines a second computation.
    """
    hot = payment_keys(tables, settings) if hot is None else hot
    lines = payment_lines(tables, settings, hot)
    if lists and not totals:
        crowded = any(key is not None for key in hot["debit_id"])
        return payment_lists(lines.filter("invoice_id is not null"), together=not crowded)
    daily = daily_payments(lines, settings)
    listed = F.when(F.col("amount").isNotNull(), F.struct("paid_on", "amount"))
    found = daily.groupBy("invoice_id").agg(
        F.sum("advance_amount").alias("advance_amount"),
        F.sum("cash_amount").alias("cash_amount"),
        F.sum("cheque_amount").alias("cheque_amount"),
        F.sum("online_amount").alias("online_amount"),
        F.array_sort(F.collect_list(listed)).alias("payments"),
    )
    return found.join(payment_lists(lines), "invoice_id", "left") if lists else found


def payment_lists(lines: DataFrame, together: bool = False) -> DataFrame:
    """Per invoice the days and amounts of its payments as texts, one entry per payment.

    `together` shuffles the payments once, for invoices of which none has very many.
    """
    return listed_rows(
        lines.filter("amount is not null"), "invoice_id", "paid_on", "amount",
        ("payment_dates", "all_payments"), together=together,
    )


def mode_totals(tables: Mapping[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """Amounts per invoice and payment mode; 0 for a mode that was not used."""
    return payments_by_invoice(tables, settings).select(
        "invoice_id", "cash_amount", "cheque_amount", "online_amount"
    )


def advances(tables: Mapping[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """Amounts credited before the invoice was booked, for invoices that have any."""
    return (
        payment_lines(tables, settings)
        .filter("is_advance")
        .groupBy("invoice_id")
        .agg(F.sum("amount").alias("advance_amount"))
    )
