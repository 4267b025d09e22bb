
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from orderloom import Settings  # noqa: E402
from orderloom.constants import CANCELLED  # noqa: E402
from orderloom.functions.address import decode_address, is_rejected  # noqa: E402
from orderloom.functions.matching import class_name  # noqa: E402
from orderloom.operators import changes, dimensions, kpis, ledger, tat, terms  # noqa: E402
from orderloom.operators.replace import replace_rows  # noqa: E402
from orderloom.plans.wide import build_detail, build_wide  # noqa: E402
from orderloom.schemas import conform  # noqa: E402
from orderloom.sources import bucketed, clustered  # noqa: E402
from orderloom.sources.shared import keep, shared_folder  # noqa: E402
from orderloom.sources.store import WideTable  # noqa: E402
from orderloom.sources.tables import Tables  # noqa: E402
from orderloom.sources.tpch import order_tables, skewed  # noqa: E402
from orderloom.streaming import feed, sync  # noqa: E402

# The test tables span 1995 to 2001, so the cut-off and the last run lie inside that.
SINCE = datetime.fromisoformat(oracles.SINCE)
SETTINGS = Settings(
    tat_cutoff=datetime.fromisoformat(oracles.CUTOFF),
    fetched_at=datetime.fromisoformat(oracles.FETCHED_AT),
)
# Between SINCE and the last change.
HALFWAY = datetime(2000, 1, 1)
INTENDED = Settings(compat=False, tat_cutoff=SETTINGS.tat_cutoff, fetched_at=SETTINGS.fetched_at)

ROW = ["sale_order_item_id", "invoice_item_id", "payment_term", "rsm"]


def portable(df: DataFrame) -> DataFrame:
    """Types that compare alike across engines: numbers as bigint or double, times as text."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind in ("int", "boolean"):
            column = column.cast("bigint")
        elif kind.startswith("decimal"):
            column = column.cast("double")
        columns.append(column.alias(name))
    return df.select(*columns)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def wide_build(t: Tables) -> DataFrame:
    return rounded(build_wide(t, settings=SETTINGS), 4, "payment_score")


def wide_detail(t: Tables) -> DataFrame:
    columns = ROW + [
        "is_shipment", "payment_after_no_of_days", "delivery_date", "payment_commitment_date",
        "is_installment", "installment_dates", "installment_amounts", "payment_dates",
        "all_payments", "address_rejected",
        "packed_2_delivered_tat_seconds", "create_2_processing_tat_seconds",
        "processing_2_complete_tat_seconds",
    ]
    return build_detail(t, settings=SETTINGS, columns=columns)


def changed(t: Tables, *stamps: str) -> DataFrame:
    return changes.changed_orders(t, SINCE, SETTINGS, stamps or ("created_at", "updated_at"))


def wide_for_changed(t: Tables) -> DataFrame:
    """The rows one incremental run builds."""
    ids = keep(changed(t), "changed_orders")
    return rounded(build_wide(t, ids, SETTINGS), 4, "payment_score")


def payment_score(t: Tables) -> DataFrame:
    return rounded(
        build_detail(t, settings=SETTINGS, columns=ROW + ["payment_score"]), 4, "payment_score"
    )


def changed_orders_clustered(t: Tables) -> DataFrame:
    """Orders of any age changed for any reason, from tables stored by the year of their last change."""
    spark = t["sale_orders"].sparkSession
    root = f"{shared_folder(spark)}/orderloom/clustered-{uuid.uuid4().hex}"
    clustered.store(t, root, CHANGING, "year")
    return changes.changed_orders(clustered.from_clustered(spark, root), SINCE, INTENDED)


def item_totals_bucketed(t: Tables) -> DataFrame:
    """Invoiced totals of the items, from tables stored in buckets of items and orders."""
    spark = t["sale_orders"].sparkSession
    database = f"orderloom_{uuid.uuid4().hex}"
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{shared_folder(spark)}/orderloom/{database}"
    bucketed.store(t, spark, database, folder, partitions, BUCKETED)
    stored = bucketed.from_bucketed(spark, database)
    return item_invoiced_totals(Tables(lambda name: stored[name] if name in BUCKETED else t[name]))


def item_invoiced_totals(t: Tables) -> DataFrame:
    measures = [
        "final_ii_quantity", "is_invoiced", "is_partially_invoiced", "non_invoiced_quantity",
    ]
    rows = build_wide(t, settings=SETTINGS, columns=["sale_order_item_id", *measures])
    return rows.groupBy("sale_order_item_id").agg(
        *[F.max(m).alias(m) for m in measures], F.count(F.lit(1)).alias("n")
    )


def order_invoice_counts(t: Tables) -> DataFrame:
    rows = build_wide(t, settings=INTENDED, columns=["sale_order_id", "is_both_invoiced"])
    return rows.groupBy("sale_order_id").agg(F.max("is_both_invoiced").alias("is_both_invoiced"))


def type_shortening(t: Tables) -> DataFrame:
    return t["sale_order_items"].select(
        F.col("id").alias("sale_order_item_id"),
        class_name(F.col("itemParentable_type")).alias("itemParentable_type"),
        class_name(F.col("saleable_type")).alias("saleable_type"),
    )


def address_fields(t: Tables) -> DataFrame:
    text, address = F.col("billing_address"), F.col("address")
    orders = t["sale_orders"].withColumn("address", decode_address(text))
    return orders.select(
        F.col("id").alias("sale_order_id"),
        address["city"].alias("address_city"),
        address["pincode"].alias("address_pincode"),
        address["state"].alias("address_state"),
        F.coalesce(is_rejected(text, address), F.lit(False)).alias("rejected"),
    )


def keyed_replace(t: Tables) -> DataFrame:
    """Replace the changed orders by new rows; changed orders that are cancelled have none."""
    current = t["sale_orders"].select(F.col("id").alias("sale_order_id"), "net_total", "state")
    ids = keep(changed(t), "changed_orders")
    new = current.join(ids, "sale_order_id", "left_semi").filter(F.col("state") != CANCELLED)
    result = replace_rows(
        current.withColumn("is_new", F.lit(0)), ids, new.withColumn("is_new", F.lit(1))
    )
    return result.drop("state")


def wide_skewed(t: Tables) -> DataFrame:
    """The wide table where one order, item and invoice hold a large part of the rows."""
    columns = ROW + [
        "sale_order_id", "invoice_id", "final_ii_quantity", "is_invoiced", "payment_score",
        "delivery_date", "title_name", "customer_name",
    ]
    return rounded(build_detail(skewed(t), settings=SETTINGS, columns=columns), 4, "payment_score")


# The tables that change detection reads, and those that totals per item join by item and order.
CHANGING = [
    "sale_orders", "sale_order_items", "invoice_items", "invoices", "ledger_transactions",
    "credit_debit_mappings", "payments", "sale_order_state_logs", "shipments", "shipment_state_logs",
]
BUCKETED = [
    "sale_orders", "sale_order_items", "invoice_items", "sale_order_payment_terms",
    "sale_order_payment_term_after_deliveries",
]
STORED = ["sale_order_item_id", "invoice_item_id", "sale_order_id", "final_ii_quantity", "fetch_date"]


def new_table(spark: SparkSession) -> WideTable:
    return WideTable(spark, f"{shared_folder(spark)}/orderloom/wide-{uuid.uuid4().hex}", span=10_000)


def incremental_run(t: Tables) -> DataFrame:
    """The stored table after a first and a second run of the job, and its mark."""
    spark = t["sale_orders"].sparkSession
    store = new_table(spark)
    for now in (SINCE, SETTINGS.fetched_at):
        sync.run(t, store, now, Settings(tat_cutoff=SETTINGS.tat_cutoff))
    return store.read().select(*STORED).withColumn("mark", F.lit(store.mark()).cast("timestamp_ntz"))


def streamed_run(t: Tables) -> DataFrame:
    """The stored table after a first run and two streams of changes, the second one a restart."""
    spark = t["sale_orders"].sparkSession
    store = new_table(spark)
    sync.run(t, store, SINCE, Settings(tat_cutoff=SETTINGS.tat_cutoff))
    update = feed.updater(t, store, INTENDED)
    for since, until in ((SINCE, HALFWAY), (HALFWAY, None)):
        feed.capture(t, f"{store.root}/events", since, until)
        feed.follow(spark, f"{store.root}/events", f"{store.root}/checkpoint", update)
    return store.read().select(*STORED)


def mode_totals_any_case(t: Tables) -> DataFrame:
    """Modes, states and types in other letters, matched without regard to case."""
    lowered = {
        "payments": ["mode", "cr_dr_state"],
        "ledger_transactions": ["state", "ledgerable_type"],
    }

    def load(name: str) -> DataFrame:
        return t[name].withColumns({c: F.lower(c) for c in lowered.get(name, [])})

    return ledger.mode_totals(Tables(load), Settings(ignore_case=True))


def conformed_values(t: Tables) -> DataFrame:
    """Unreadable texts and NaN become NULL when a table is given its types."""
    raw = t["customers"].selectExpr(
        "id",
        "if(id % 7 = 0, 'no number', cast(id as string)) as read_id",
        "if(id % 5 = 0, double('NaN'), id / 4) as balance",
        "if(id % 3 = 0, 'no day', concat('1999-05-0', id % 3)) as day",
    )
    typed = conform(raw, "id long, read_id long, balance decimal(18,2), day date", "raw")
    return typed


def shipment_span(t: Tables) -> DataFrame:
    """Spans with their place in ascending order, missing ones first."""
    spans = tat.shipment_span(t, ordered=False)
    # One row per number of days, so the window is small.
    sizes = spans.groupBy("span_days").agg(F.count("*").alias("n"))
    before = Window.orderBy(F.asc_nulls_first("span_days")).rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select(
        F.col("span_days").alias("days"), (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1).alias("place")
    )
    return spans.join(places, F.col("span_days").eqNullSafe(F.col("days"))).drop("days")


def average_ticket_size(t: Tables) -> DataFrame:
    wide = build_wide(t, settings=SETTINGS, columns=kpis.TICKET_COLUMNS)
    return rounded(
        kpis.average_ticket_size(wide), 6, "average_with_tax", "average_without_tax"
    )


def average_discount(t: Tables) -> DataFrame:
    wide = build_wide(t, settings=SETTINGS, columns=kpis.DISCOUNT_COLUMNS)
    return rounded(kpis.average_discount(wide), 6, "average_discount")


def cc_share(t: Tables) -> DataFrame:
    wide = build_wide(t, settings=SETTINGS, columns=kpis.CC_COLUMNS)
    return rounded(kpis.cc_share(wide), 6, "cc_percentage")


def stored_figures(t: Tables) -> DataFrame:
    """The figures over the stored table, asked in SQL under the names that reports use."""
    spark = t["sale_orders"].sparkSession
    store = new_table(spark)
    store.replace(None, build_wide(t, settings=SETTINGS), SINCE, "first")
    kpis.report_view(store.read(), "regular_orders")
    found = spark.sql("""
        with orders as (
            select max(final_invoice_total_with_tax) as total, sum(total_unit_price_without_tax) as value
            from regular_orders where order_state <> 'CANCELLED' group by sale_order_id)
        select avg(double(total)) as average_with_tax, avg(double(value)) as average_without_tax,
               (select avg(double(sale_order_item_discount_percentage)) from regular_orders
                where is_dc = 1 and final_invoice_total_with_tax > 0 and order_state <> 'CANCELLED')
                   as average_discount,
               (select double(sum(total_ii_quanity) filter (where invoice_prefix = 'CC'))
                       / double(sum(total_ii_quanity)) * 100
                from regular_orders where order_state <> 'CANCELLED') as cc_percentage
        from orders""")
    return rounded(found, 6, *found.columns)


def changed_rows(found: Callable, t: Tables) -> DataFrame:
    counted = found(t, SETTINGS, changes=(SINCE, "created_at"))
    return counted.select("sale_order_id", F.col("changed_rows").cast("bigint").alias("changed_rows"))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "wide_build": wide_build,
    "wide_detail": wide_detail,
    "wide_for_changed": wide_for_changed,
    "ledger_mode_pivot": lambda t: ledger.mode_totals(t, SETTINGS),
    "ledger_advance": lambda t: ledger.advances(t, SETTINGS),
    "payment_list": lambda t: ledger.daily_payments(ledger.payment_lines(t, SETTINGS)).select(
        "invoice_id", "paid_on", "amount", "payments"
    ),
    "first_delivery": lambda t: tat.first_delivery(t, SETTINGS),
    "shipment_tat": lambda t: tat.shipment_tat(t, SETTINGS),
    "order_tat": lambda t: tat.order_tat(t, SETTINGS),
    "shipment_changes": lambda t: changed_rows(tat.shipment_tat, t),
    "order_changes": lambda t: changed_rows(tat.order_tat, t),
    "shipment_span": shipment_span,
    "payment_lists": lambda t: ledger.payment_lists(ledger.payment_lines(t, SETTINGS)),
    "installment_lists": terms.installment_texts,
    "stored_figures": stored_figures,
    "payment_rows": lambda t: ledger.payment_lines(t, SETTINGS),
    "installment_rows": terms.installments,
    "mode_totals_any_case": mode_totals_any_case,
    "conformed_values": conformed_values,
    "wide_skewed": wide_skewed,
    "changed_orders_by_branch": lambda t: changes.changed_orders_by_branch(t, SINCE, SETTINGS),
    "incremental_run": incremental_run,
    "streamed_run": streamed_run,
    "installments_by_order": terms.installment_due,
    "commitment_date": lambda t: build_detail(
        t, settings=SETTINGS, columns=ROW + ["payment_commitment_date"]
    ),
    "payment_score": payment_score,
    "item_invoiced_totals": item_invoiced_totals,
    "item_totals_bucketed": item_totals_bucketed,
    "order_invoice_counts": order_invoice_counts,
    "type_shortening": type_shortening,
    "address_fields": address_fields,
    "product_titles": dimensions.edition_products,
    "rsm_names": lambda t: dimensions.sales_organisation(t).drop("contacts"),
    "customer_dim": dimensions.customers,
    "changed_orders_created": lambda t: changed(t, "created_at"),
    "changed_orders_updated": lambda t: changed(t, "updated_at"),
    "changed_orders": changed,
    "changed_orders_clustered": changed_orders_clustered,
    "changed_orders_intended": lambda t: changes.changed_orders(t, SINCE, INTENDED),
    "keyed_replace": keyed_replace,
    "average_ticket_size": average_ticket_size,
    "average_discount": average_discount,
    "cc_share": cc_share,
}


def entry(spark: SparkSession) -> DataFrame:
    """The wide table over the smallest test tables."""
    return queries()["wide_build"](spark, "/root/testdata/sf0.001")


def text_queries() -> tuple[dict, dict]:
    """Queries and SQL of the text operators and their pipeline, if these can be imported."""
    try:
        import corpus_pipeline
        from orderloom.llm import registry
    except ImportError:
        return {}, {}
    found = {**registry.QUERIES, "pipeline": corpus_pipeline.run}
    sql = dict(registry.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def registered(query: Callable[[Tables], DataFrame]):
        return lambda spark, root: portable(query(order_tables(spark, root)))

    return {name: registered(query) for name, query in QUERIES.items()} | text_queries()[0]


def oracle_sql() -> dict[str, str]:
    own = {name: oracles.with_tables(sql) for name, sql in oracles.RESULTS.items()}
    return own | text_queries()[1]
