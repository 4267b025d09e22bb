"""Intermediate tables on storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Bounds = tuple[int | None, int | None]

# Spark removes an execution's shuffle files when it ends, rather than when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Code that Spark makes for rows of many columns is too long for the JVM to compile, which then interprets it.
_WHOLE_STAGE = "spark.sql.codegen.wholeStage"

# The folder of the run in progress, if its intermediate tables are to be removed with it.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Without that setting a session on one machine gets a temporary folder; on a cluster
    there is none that would do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="orderloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def keep(df: DataFrame, name: str) -> DataFrame:
    """Compute a frame once and go on with the written table.

    Cuts the lineage like a checkpoint, survives the loss of executors, and unlike one
    tells the optimizer the real size.
    """
    spark = df.sparkSession
    folder = _RUN.get() or f"{shared_folder(spark)}/orderloom"
    path = f"{folder}/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_bounded(df: DataFrame, name: str, *columns: str) -> tuple[DataFrame, dict[str, Bounds]]:
    """`keep`, and the least and largest value of some columns, observed while the rows are written.

    A task that runs twice is observed twice, which changes neither. Both are None without rows.
    """
    seen = Observation()
    ends = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    kept = keep(df.observe(seen, *ends), name)
    return kept, {c: (seen.get[c]["low"], seen.get[c]["high"]) for c in columns}


def bounds(df: DataFrame, column: str) -> Bounds:
    """Least and largest value of a column; None without rows."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return low, high


def within(column: str, ends: Bounds) -> Column:
    """Whether a value lies between the bounds; nothing does if there are none. Reaches the scan."""
    low, high = ends
    return F.lit(False) if low is None else F.col(column).between(low, high)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what `keep` writes inside the block when the block ends, and shuffles as soon as the job
    that made them has.

    Frames that read kept tables must have been computed by then.
    """
    folder = f"{shared_folder(spark)}/orderloom/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        with _setting(spark, _CLEANUP, "true"):
            yield
    finally:
        _RUN.reset(token)
        delete(spark, folder)


def step_by_step(spark: SparkSession) -> AbstractContextManager[None]:
    """Run the jobs inside the block operator by operator: faster for wide rows, which are copied by short
    code then."""
    return _setting(spark, _WHOLE_STAGE, "false")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark reads, if it is there."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it isn't there."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return [status.getPath().getName() for status in system.listStatus(place)]
