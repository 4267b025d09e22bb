"""A Spark session with the settings the engine is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution measures every shuffle: it turns a join into a broadcast only when the
# measured side is below the broadcast threshold, splits skewed join partitions and merges
# small ones, so spark.sql.shuffle.partitions can be set for the largest shuffle.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Scans of 10 GB or more (Spark's default) that are semi joined with up to some millions of ids, too
    # many for a broadcast join, are first filtered by a Bloom filter of 8 MB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "32m",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    # Call sites of expressions are only for error messages and make large plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(
    app: str = "orderloom", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
