"""Source tables stored by the time of their last change, so that reading changes skips the rest.

A row lies in the partition of the day (or week, month, year) of the later of its time stamps. A row
with a time stamp after some moment lies in that day's partition or a later one, so `Tables.recent`
leaves the earlier ones out by name, without opening a file. Rows without any time stamp, which never
count as changed, are in the partition for NULL. Choose days for large tables only: each partition
is a file at least.

Inside a partition rows are sorted by the column that increments look them up by, so the bounds of
ids that `restricted` knows skip row groups too.

The copy is a snapshot: `store` writes all of a table anew. Partitions that hold much are split over
files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schemas import SOURCE_TABLES, conform, struct
from orderloom.sources.shared import names as folder
from orderloom.sources.tables import Tables

_UNITS = ("day", "week", "month", "year")
_STAMPS = ("created_at", "updated_at")

# What increments look the rows of a table up by, where that isn't its first column.
_LOOKED_UP_BY = {
    "sale_order_items": "sale_order_id",
    "invoice_items": "sale_order_item_id",
    "shipments": "sale_order_id",
    "sale_order_payment_term_installments": "sale_order_id",
    "ledger_transactions": "ledgerable_id",
}


def _stamped(name: str) -> bool:
    return set(_STAMPS) <= set(struct(SOURCE_TABLES[name]).names)


def store(
    tables: Mapping[str, DataFrame], root: str, names: Iterable[str] = SOURCE_TABLES, unit: str = "day"
) -> None:
    """Write some source tables, or all, to folders under `root`; what lies there is replaced."""
    if unit not in _UNITS:
        raise ValueError(f"unit {unit}, expected one of {_UNITS}")
    part = f"changed_{unit}"
    for name in names:
        schema = struct(SOURCE_TABLES[name])
        frame = conform(tables[name], SOURCE_TABLES[name], name)
        # Zoned time stamps as the clock shows them here, so that days are the same wherever they are read.
        zoneless = [f.name for f in schema if f.dataType.simpleString() == "timestamp_ntz"]
        frame = frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoneless})
        key = _LOOKED_UP_BY.get(name, schema.names[0])
        if _stamped(name):
            # `greatest` passes over a missing time stamp.
            frame = frame.withColumn(part, F.to_date(F.date_trunc(unit, F.greatest(*_STAMPS))))
            written = frame.hint("rebalance", part).sortWithinPartitions(part, key).write.partitionBy(part)
        else:
            written = frame.hint("rebalance").sortWithinPartitions(key).write
        written.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/{name}")


def from_clustered(spark: SparkSession, root: str) -> Tables:
    """The tables that `store` wrote, whatever unit it was given."""

    def unit(name: str) -> str | None:
        """The unit of a table's partitions; None if it has none."""
        found = {n.partition("=")[0] for n in folder(spark, f"{root}/{name}") if "=" in n}
        return next((u for u in _UNITS if f"changed_{u}" in found), None)

    def read(name: str) -> DataFrame:
        schema, by = struct(SOURCE_TABLES[name]), unit(name)
        if by is not None:
            schema = schema.add(f"changed_{by}", "date")
        return spark.read.schema(schema).parquet(f"{root}/{name}")

    def recent(name: str, since: datetime) -> DataFrame:
        frame, by = read(name), unit(name)
        if by is None:
            return frame
        # Folded before the scan is planned, so partitions are pruned by it.
        first = F.to_date(F.date_trunc(by, F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")))
        return frame.filter(F.col(f"changed_{by}") >= first)

    return Tables(read, recent)
