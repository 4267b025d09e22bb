from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from handmade import add_order, make_tables
from orderloom.schemas import SOURCE_TABLES, conform
from orderloom.sources.shared import keep, shared_folder
from orderloom.sources.tables import (
    Tables, from_catalog, from_files, from_frames, jdbc_options, register_views,
)


@pytest.fixture(scope="module")
def tables(spark):
    rows = {}
    add_order(rows, 1, net_total="12.50", billing_address='"a, b"')
    return make_tables(spark, rows)


@pytest.mark.parametrize(
    "kind, options", [("parquet", {}), ("orc", {}), ("json", {}), ("csv", {"header": "true", "escape": '"'})]
)
def test_files(spark, tables, tmp_path, kind, options):
    few = ["sale_orders", "shipment_items", "payments"]
    for name in few:
        tables[name].write.format(kind).options(**options).save(f"{tmp_path}/{name}")
    loaded = from_files(spark, str(tmp_path), kind, **options)
    for name in few:
        assert loaded[name].schema.names == tables[name].schema.names
        assert loaded[name].collect() == tables[name].collect()


def test_catalog(spark, tables):
    register_views(tables)
    assert from_catalog(spark)["sale_orders"].collect() == tables["sale_orders"].collect()
    assert spark.sql("select net_total from sale_orders").first()[0] == pytest.approx(12.5)


def test_only_used_tables_are_loaded():
    asked = []
    tables = Tables(lambda name: asked.append(name))
    assert len(tables) == len(list(tables)) == len(SOURCE_TABLES) == 28
    assert asked == []


def test_missing_table():
    with pytest.raises(ValueError, match="payments"):
        from_frames({n: None for n in SOURCE_TABLES if n != "payments"})


def test_conform(spark):
    raw = spark.sql("""select * from values
        ('1', double('NaN'), '2023-01-05 10:00:00', 5), ('x', 2.345D, 'soon', null)
        as t(id, price, day, extra)""")
    typed = conform(raw, "id long, price decimal(18,2), day date")
    assert [f.dataType.simpleString() for f in typed.schema] == ["bigint", "decimal(18,2)", "date"]
    first, second = typed.collect()
    assert (first["id"], first["price"], str(first["day"])) == (1, None, "2023-01-05")
    assert (second["id"], str(second["price"]), second["day"]) == (None, "2.35", None)
    with pytest.raises(ValueError, match="nothing"):
        conform(raw, "nothing long", "raw")


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "sale_orders", 1, user="u")
    assert plain["dbtable"] == "sale_orders" and plain["user"] == "u"
    assert "partitionColumn" not in plain
    ranged = jdbc_options("jdbc:x", "sale_order_state_logs", 8, (5, 104))
    assert ranged["partitionColumn"] == "sale_order_id"
    assert (ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("5", "105", "8")


def test_keep(spark):
    frame = keep(spark.range(5).withColumn("x", F.col("id") * 2), "numbers")
    assert frame.count() == 5
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_folder(spark) in f for f in frame.inputFiles())
