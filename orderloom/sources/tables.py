"""Load the source tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schemas import SOURCE_TABLES, conform, struct


class Tables(Mapping[str, DataFrame]):
    """The source tables by name, each loaded and typed when it is first used.

    `recent`, if the storage can skip data by time, loads a table without rows that did not change
    from a moment on; it may leave such rows in.
    """

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        recent: Callable[[str, datetime], DataFrame] | None = None,
    ):
        self._load, self._recent, self._loaded = load, recent, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaded:
            self._loaded[name] = conform(self._load(name), SOURCE_TABLES[name], name)
        return self._loaded[name]

    def recent(self, name: str, since: datetime) -> DataFrame:
        """The table, with at least the rows created or updated at `since` or later."""
        if self._recent is None:
            return self[name]
        return conform(self._recent(name, since), SOURCE_TABLES[name], name)

    def __iter__(self) -> Iterator[str]:
        return iter(SOURCE_TABLES)

    def __len__(self) -> int:
        return len(SOURCE_TABLES)


def recent(tables: Mapping[str, DataFrame], name: str, since: datetime) -> DataFrame:
    """`Tables.recent`, or the whole table of any other mapping."""
    return tables.recent(name, since) if isinstance(tables, Tables) else tables[name]


def from_frames(frames: Mapping[str, DataFrame]) -> Tables:
    """The given frames; all source tables must be there."""
    missing = sorted(set(SOURCE_TABLES) - set(frames))
    if missing:
        raise ValueError(f"missing source tables {missing}")
    return Tables(frames.__getitem__)


def from_files(spark: SparkSession, root: str, format: str = "parquet", **options: str) -> Tables:
    """One directory or file per table under `root`: parquet, orc, json or csv.

    Text formats get the declared schema, so nothing is inferred.
    """

    def read(name: str) -> DataFrame:
        reader = spark.read.format(format).options(**options)
        if format in ("csv", "json"):
            reader = reader.schema(struct(SOURCE_TABLES[name]))
        return reader.load(f"{root}/{name}")

    return Tables(read)


def from_catalog(spark: SparkSession, database: str | None = None) -> Tables:
    """Tables or views of the catalog."""
    return Tables(lambda name: spark.table(f"{database}.{name}" if database else name))


def jdbc_options(
    url: str, table: str, partitions: int, bounds: tuple[int, int] | None = None,
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC scan. With bounds it is read in parallel, by ranges of the key."""
    result = {"url": url, "dbtable": table, "preferTimestampNTZ": "true", "fetchsize": "10000"}
    if bounds is not None and partitions > 1:
        lower, upper = bounds
        names = struct(SOURCE_TABLES[table]).names
        result |= {
            "partitionColumn": names[0],
            "lowerBound": str(lower),
            "upperBound": str(upper + 1),
            "numPartitions": str(partitions),
        }
    return result | options


def from_jdbc(spark: SparkSession, url: str, partitions: int, **options: str) -> Tables:
    """All source tables of one database; filters and columns are pushed to it.

    `partitions` is the number of tasks, each with a connection of its own, that read a table.
    The range of each table's first column (its id, or the order it belongs to) is asked of
    the database, so that every task reads one range over its own connection.
    """

    def read(table: str) -> DataFrame:
        bounds = None
        if partitions > 1:
            key = struct(SOURCE_TABLES[table]).names[0]
            asked = jdbc_options(url, f"(select min({key}) as low, max({key}) as high from {table}) b", 1, **options)
            low, high = spark.read.format("jdbc").options(**asked).load().first()
            bounds = (int(low), int(high)) if low is not None else None
        scan = jdbc_options(url, table, partitions, bounds, **options)
        return spark.read.format("jdbc").options(**scan).load()

    return Tables(read)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make the frames available to `spark.sql` under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
