"""Source tables stored in buckets of the keys they are joined and grouped by.

Rows of one key lie in one bucket, and the buckets of all tables are the same in number, so joins and
totals on these keys read bucket by bucket and need no shuffle: items with their totals and their
invoice items, orders with their terms, logs, instalments and shipments, ledger entries with mappings.
A key that is hot is still cut into slices by `attach` and `expand`, and its join is then shuffled.

The tables are Parquet tables of the session's catalog; their place is the database's folder, which
all executors must share. Choose at least as many buckets as shuffle partitions, or Spark shuffles
for the sake of parallel work.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schemas import SOURCE_TABLES, conform
from orderloom.sources.tables import Tables, from_catalog

# The key of each large table. Other tables are stored without buckets.
KEYS = {
    "sale_orders": "id",
    "sale_order_items": "id",
    "sale_order_payment_terms": "sale_order_id",
    "sale_order_payment_term_after_deliveries": "sale_order_id",
    "sale_order_payment_term_installments": "sale_order_id",
    "sale_order_state_logs": "sale_order_id",
    "shipments": "id",
    "shipment_state_logs": "shipment_id",
    "shipment_items": "id",
    "invoice_items": "sale_order_item_id",
    "invoices": "id",
    "ledger_transactions": "id",
    "credit_debit_mappings": "debit_id",
    "payments": "id",
}


def store(
    tables: Mapping[str, DataFrame], spark: SparkSession, database: str, folder: str, buckets: int,
    names: Iterable[str] = SOURCE_TABLES,
) -> None:
    """Write some source tables, or all, to a database of the catalog that lies in `folder`."""
    spark.sql(f"create database if not exists `{database}` location '{folder}'")
    for name in names:
        frame = conform(tables[name], SOURCE_TABLES[name], name)
        key = KEYS.get(name)
        if key is None:
            writer = frame.write
        else:
            # A bucket's rows meet before they are written, so it is one file, or a few where a hot
            # key makes it so large that Spark splits it over tasks.
            bucket = F.pmod(F.hash(key), F.lit(buckets))
            together = frame.withColumn("_bucket", bucket).hint("rebalance", "_bucket").drop("_bucket")
            writer = together.write.bucketBy(buckets, key).sortBy(key)
        writer.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{name}`")


def from_bucketed(spark: SparkSession, database: str) -> Tables:
    """The tables that `store` wrote."""
    return from_catalog(spark, f"`{database}`")
