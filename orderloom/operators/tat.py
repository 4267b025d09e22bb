"""Turnaround times from the state logs.

The shortest time over all pairs of log rows (a, b) of one entity is
min(b) - max(a), so the logs are aggregated once and never joined with themselves.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.constants import (
    DELIVERED, FINISHED_STATES, LOG_COMPLETED, LOG_CREATED, LOG_PROCESSING, PACKED,
)
from orderloom.functions.matching import equals, one_of
from orderloom.functions.times import changed_after, days_between, moment, seconds_between
from orderloom.settings import Settings


def first_delivery(tables: Mapping[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """Time of the first delivery of each shipment that was delivered."""
    logs = tables["shipment_state_logs"]
    return (
        logs.filter(equals(F.col("state"), DELIVERED, settings.ignore_case))
        .groupBy("shipment_id")
        .agg(F.min("created_at").alias("delivered_at"))
    )


def _counts(name: str, matches: Column, since: datetime, stamp: str) -> list[Column]:
    """Rows of one log state, and those of them that did not change."""
    new = F.coalesce(changed_after(F.col(stamp), since), F.lit(False))
    return [
        F.count(F.when(matches, 1)).alias(f"n_{name}"),
        F.count(F.when(matches & ~new, 1)).alias(f"u_{name}"),
    ]


def _product(prefix: str, names: list[str]) -> Column:
    """Size of the outer-joined combinations: a state without rows counts as one empty row.

    Products of four counts do not fit a BIGINT for large groups. As doubles they are
    exact up to 2**53, and beyond that a product of smaller counts is still smaller.
    """
    product = F.lit(1.0)
    for name in names:
        n = F.coalesce(F.col(f"n_{name}"), F.lit(0))
        product = product * F.when(n == 0, F.lit(1)).otherwise(F.col(f"{prefix}_{name}"))
    return product


def shipment_tat(
    tables: Mapping[str, DataFrame],
    settings: Settings = Settings(),
    changes: tuple[datetime, str] | None = None,
) -> DataFrame:
    """Shortest time from packed to delivered among the shipments of an order.

    With `changes=(since, timestamp column)` also counts the changed combinations of
    shipment, packed row and delivered row.
    """
    is_packed = equals(F.col("state"), PACKED, settings.ignore_case)
    is_delivered = equals(F.col("state"), DELIVERED, settings.ignore_case)
    shipments = tables["shipments"].filter(F.col("created_at") > moment(settings.tat_cutoff))
    logs = tables["shipment_state_logs"].filter(is_packed | is_delivered)
    spans = [
        F.max(F.when(is_packed, F.col("created_at"))).alias("packed_at"),
        F.min(F.when(is_delivered, F.col("created_at"))).alias("delivered_at"),
    ]
    measures = [
        F.min(days_between(F.col("delivered_at"), F.col("packed_at"))).alias(
            "packed_2_delivered_tat_day"
        ),
        F.min(seconds_between(F.col("delivered_at"), F.col("packed_at"))).alias(
            "packed_2_delivered_tat_seconds"
        ),
    ]
    if changes is None:
        keys = shipments.select(F.col("id").alias("shipment_id"), "sale_order_id")
        spanned = logs.groupBy("shipment_id").agg(*spans)
        spanned = spanned.filter("packed_at is not null and delivered_at is not null")
        return keys.join(spanned, "shipment_id").groupBy("sale_order_id").agg(*measures)

    since, stamp = changes
    keys = shipments.select(
        F.col("id").alias("shipment_id"),
        "sale_order_id",
        changed_after(F.col(stamp), since).alias("is_new"),
    )
    counted = logs.groupBy("shipment_id").agg(
        *spans,
        *_counts("packed", is_packed, since, stamp),
        *_counts("delivered", is_delivered, since, stamp),
    )
    names = ["packed", "delivered"]
    same = F.when(F.col("is_new"), F.lit(0.0)).otherwise(_product("u", names))
    return (
        keys.join(counted, "shipment_id", "left")
        .groupBy("sale_order_id")
        .agg(*measures, F.sum(_product("n", names) - same).alias("changed_rows"))
        .filter(F.col("packed_2_delivered_tat_day").isNotNull())
    )


def order_tat(
    tables: Mapping[str, DataFrame],
    settings: Settings = Settings(),
    changes: tuple[datetime, str] | None = None,
) -> DataFrame:
    """Shortest times from created to processing and from processing to completed."""
    anyhow = settings.ignore_case
    state = F.col("state")
    states = {
        "created": equals(state, LOG_CREATED, anyhow),
        "processing": one_of(state, LOG_PROCESSING, anyhow),
        "completed": equals(state, LOG_COMPLETED, anyhow),
    }
    orders = (
        tables["sale_orders"]
        .filter(one_of(state, FINISHED_STATES, anyhow))
        .filter(F.col("created_at") > moment(settings.tat_cutoff))
        .select(F.col("id").alias("sale_order_id"))
    )
    logs = tables["sale_order_state_logs"].filter(
        states["created"] | states["processing"] | states["completed"]
    )

    def at(name: str) -> Column:
        return F.when(states[name], F.col("created_at"))

    aggregates = [
        F.max(at("created")).alias("last_created"),
        F.min(at("processing")).alias("first_processing"),
        F.max(at("processing")).alias("last_processing"),
        F.min(at("completed")).alias("first_completed"),
    ]
    if changes is not None:
        for name, matches in states.items():
            aggregates += _counts(name, matches, *changes)
    spans = (
        logs.groupBy("sale_order_id")
        .agg(*aggregates)
        .filter("last_created is not null and first_processing is not null")
    )
    created, processing = F.col("last_created"), F.col("first_processing")
    reprocessing, completed = F.col("last_processing"), F.col("first_completed")
    columns = [
        "sale_order_id",
        days_between(processing, created).alias("create_2_processing_tat_day"),
        seconds_between(processing, created).alias("create_2_processing_tat_seconds"),
        days_between(completed, reprocessing).alias("processing_2_complete_tat_day"),
        seconds_between(completed, reprocessing).alias("processing_2_complete_tat_seconds"),
    ]
    if changes is not None:
        # Processing rows take part twice: as the end of one time and the start of the other.
        names = ["created", "processing", "processing", "completed"]
        columns.append((_product("n", names) - _product("u", names)).alias("changed_rows"))
    return orders.join(spans, "sale_order_id").select(*columns)


def shipment_span(tables: Mapping[str, DataFrame], ordered: bool = True) -> DataFrame:
    """Days between the first and last log row of each shipment; NULL without log rows.

    `ordered` sorts by the span, missing ones first.
    """
    span = days_between(F.max("created_at"), F.min("created_at"))
    spans = tables["shipment_state_logs"].groupBy("shipment_id").agg(span.alias("span_days"))
    keys = tables["shipments"].select(F.col("id").alias("shipment_id"))
    result = keys.join(spans, "shipment_id", "left")
    return result.orderBy(F.asc_nulls_first("span_days")) if ordered else result
