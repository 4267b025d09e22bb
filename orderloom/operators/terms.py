"""Payment terms: commitment dates and instalment plans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.constants import ON_DELIVERY_PATTERN
from orderloom.functions.lists import listed
from orderloom.functions.matching import like
from orderloom.functions.times import plus_days

INSTALLMENTS = "sale_order_payment_term_installments"


def commitment_date(
    term: Column, days: Column, delivered_at: Column, invoiced_at: Column, ignore_case: bool = False
) -> Column:
    """When payment is due.

    On-delivery terms are due when delivered, and have no date before that. Others are
    due some days after delivery or, failing that, after the invoice date.
    """
    on_delivery = like(term, ON_DELIVERY_PATTERN, ignore_case)
    start = F.coalesce(delivered_at, invoiced_at)
    return F.when(on_delivery, delivered_at).otherwise(plus_days(start, days))


def installment_due(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Last instalment date per order with instalments. Cancelled orders are left to the caller.

    An order whose instalment dates are all missing still has a row.
    """
    return installments(tables).groupBy("sale_order_id").agg(
        F.max("installment_date").alias("installment_due"),
        F.count(F.lit(1)).alias("installments"),
    )


def installments(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per instalment of an order."""
    plans = tables[INSTALLMENTS].filter(F.col("id").isNotNull())
    return plans.select("sale_order_id", "installment_date", "amount")


def installment_texts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Days and amounts of an order's instalments as texts, one entry per instalment."""
    return listed(
        installments(tables), "sale_order_id", "installment_date", "amount",
        ("installment_dates", "installment_amounts"),
    )


def installment_plans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`installment_due` and `installment_texts` in one, on one shuffle of the instalments by order.

    Instalments without an order are left out.
    """
    return listed(
        installments(tables).filter("sale_order_id is not null"), "sale_order_id", "installment_date", "amount",
        ("installment_dates", "installment_amounts"),
        {"installment_due": F.max("installment_date"), "installments": F.sum("n")}, together=True,
    )


def installment_lists(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Instalments per order as a list by day; amounts of one day are summed."""
    daily = installments(tables).groupBy("sale_order_id", "installment_date").agg(
        F.sum("amount").alias("amount")
    )
    listed = F.struct("installment_date", "amount")
    return daily.groupBy("sale_order_id").agg(
        F.array_sort(F.collect_list(listed)).alias("installment_plan")
    )
