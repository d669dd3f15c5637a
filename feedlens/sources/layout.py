"""Action tables laid out by user: bucketed and sorted, so that joins and per-user aggregates need no shuffle.

Both tables are cut into the same number of buckets of ``user_id`` and sorted by it
inside each. Whatever groups or joins by user (and other columns) then finds a user's rows of
both tables in the same task: the per-user table, the daily slices and joins of
the two services read without an exchange. A date partition may be kept above
the buckets, so that day ranges still prune folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators.timeframe import PARTITION_DATE_COLUMNS
from feedlens.sources.actions import Actions

#: A join on the user and further columns may keep the tables' partitioning by user alone.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def save_by_user(df: DataFrame, table: str, buckets: int, key: str = "user_id", by_day: bool = False,
                 path: str | None = None) -> None:
    """Write a catalog table of ``buckets`` buckets of ``key``, one file per bucket (and day), sorted by ``key``."""
    if by_day:
        df = df.withColumn(PARTITION_DATE_COLUMNS[0], F.to_date("time"))
    # one task per bucket: a bucket is one file, which a scan can take as sorted
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if by_day:
        writer = writer.partitionBy(PARTITION_DATE_COLUMNS[0])
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def save_actions_by_user(actions: Actions, db: str, buckets: int, by_day: bool = False, path: str | None = None) -> None:
    """``<db>.feed_actions`` and ``<db>.message_actions``, read back by ``sources.actions.read_actions``."""
    for name, df in (("feed_actions", actions.feed), ("message_actions", actions.message)):
        save_by_user(df, f"{db}.{name}", buckets, by_day=by_day, path=f"{path}/{name}" if path else None)


def keep_user_partitioning(spark: SparkSession) -> None:
    """Let joins on the user and more columns use the buckets as they are, for this session."""
    spark.conf.set(CO_PARTITION, "false")
