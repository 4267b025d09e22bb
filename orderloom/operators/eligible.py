"""Which items and orders belong in the wide table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.constants import CUSTOMIZED_BOOK, EDITION_PRODUCT, ORDER_STATES
from orderloom.functions.matching import ends_with, one_of
from orderloom.settings import Settings
from orderloom.sources.tables import recent

Tables = Mapping[str, DataFrame]


def eligible_items(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    """Order items that sell an edition product or a customised book."""
    kind = F.col("saleable_type")
    anyhow = settings.ignore_case
    return tables["sale_order_items"].filter(
        ends_with(kind, EDITION_PRODUCT, anyhow) | ends_with(kind, CUSTOMIZED_BOOK, anyhow)
    )


def eligible_orders(
    tables: Tables, settings: Settings = Settings(), since: datetime | None = None
) -> DataFrame:
    """Orders in the states that count; with `since`, at least those changed from then on."""
    orders = tables["sale_orders"] if since is None else recent(tables, "sale_orders", since)
    return orders.filter(
        one_of(F.col("state"), ORDER_STATES, settings.ignore_case)
    )
