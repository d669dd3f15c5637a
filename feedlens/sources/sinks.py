"""Sinks: the daily slice table and the top-posts file.

The slice table is partitioned by ``event_date``. Writes replace only the
partitions (days) present in the new data, so a retried or rerun day never
duplicates rows; ``mode="append"`` is available for the source job's literal
behaviour. Rows are clustered by date inside each file, the counterpart of
the source table's ``ORDER BY event_date``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.operators.slices import SLICE_COLUMNS
from feedlens.sources.versioned import DayTable

SLICE_DDL = """
CREATE TABLE IF NOT EXISTS {table} (
  event_date DATE,
  dimension STRING,
  dimension_value STRING,
  views BIGINT,
  likes BIGINT,
  messages_received BIGINT,
  messages_sent BIGINT,
  users_received BIGINT,
  users_sent BIGINT
) USING parquet
PARTITIONED BY (event_date)
"""


def _ordered(df: DataFrame) -> DataFrame:
    cols = [F.col(c).cast("bigint").alias(c) if i > 2 else F.col(c) for i, c in enumerate(SLICE_COLUMNS)]
    # Rows grouped by day for the partitioned write (AQE sizes the tasks),
    # sorted by day inside each file.
    return (df.select(*cols).hint("rebalance", "event_date")
            .sortWithinPartitions("event_date", "dimension", "dimension_value"))


def write_slices(df: DataFrame, path: str, mode: str = "overwrite_days") -> None:
    """Write slices under ``path`` as Parquet partitioned by event_date.
    ``overwrite_days`` replaces the written days only; ``append`` adds rows."""
    w = _ordered(df).write.partitionBy("event_date")
    if mode == "append":
        w.mode("append").parquet(path)
    elif mode == "overwrite_days":
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        raise ValueError(f"unknown mode {mode!r}")


SLICE_SCHEMA = ("event_date date, dimension string, dimension_value string, views bigint, likes bigint, "
                "messages_received bigint, messages_sent bigint, users_received bigint, users_sent bigint")


def replace_slice_days(df: DataFrame, path: str, start, end=None) -> int:
    """Replace the days [start, end] of a versioned slice table in one step, days without
    rows included; returns the new version. ``read_slices`` reads it."""
    return DayTable(df.sparkSession, path, "event_date").replace_days(_ordered(df), start, end or start)


def read_slices(spark: SparkSession, path: str, start=None, end=None, version: int | None = None) -> DataFrame:
    """Slices of the days [start, end] of a versioned table, by default as of its latest version."""
    return DayTable(spark, path, "event_date").read(SLICE_SCHEMA, start, end, version)


def create_slice_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    ddl = SLICE_DDL.format(table=table)
    if location:
        ddl += f"LOCATION '{location}'\n"
    spark.sql(ddl)


def insert_slices(df: DataFrame, table: str, mode: str = "overwrite_days",
                  location: str | None = None) -> None:
    """Insert into a catalog table (created if absent, at ``location`` if given)."""
    spark = df.sparkSession
    create_slice_table(spark, table, location)
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    ordered = _ordered(df).select(*SLICE_COLUMNS[1:], "event_date")
    try:
        if mode == "overwrite_days":
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
            ordered.write.insertInto(table, overwrite=True)
        elif mode == "append":
            ordered.write.insertInto(table)
        else:
            raise ValueError(f"unknown mode {mode!r}")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def with_index(top: DataFrame, order=("views", "post_id")) -> DataFrame:
    """Add the 0-based row index as the first column (the layout of a CSV
    written from a data frame with its index). Only for short, limited
    tables: the window has no partition key."""
    w = Window.orderBy(F.desc(order[0]), *[F.asc(c) for c in order[1:]])
    return top.select((F.row_number().over(w) - 1).alias("index"), *top.columns)


def write_top_posts_csv(top: DataFrame, path: str) -> None:
    """One CSV file with a header and the index column."""
    (with_index(top).coalesce(1).write.mode("overwrite")
     .option("header", True).csv(path))


def _day_folders(spark, path: str) -> list[tuple[dt.date, str]]:
    """(day, folder) of a Parquet table partitioned by ``day``; none if it does not exist."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("day=") and name != "day=__HIVE_DEFAULT_PARTITION__":
            found.append((dt.date.fromisoformat(name[4:]), status.getPath().toString()))
    return found


def has_days(spark, path: str) -> bool:
    """True if the table has a day."""
    return bool(_day_folders(spark, path))


def drop_days(spark, path: str, gone) -> None:
    """Delete the day folders whose day satisfies ``gone``."""
    jvm = spark.sparkContext._jvm
    for day, folder in _day_folders(spark, path):
        if gone(day):
            target = jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
