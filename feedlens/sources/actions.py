"""The two input tables: feed actions and message actions.

Production data is read by name (catalog table, Parquet path or JDBC) and
checked against a fixed schema. Tests and the benchmark build both tables from
the generated ``events`` table; the mapping is the fixture contract and is
pure column arithmetic, so it stays inside the scan's codegen stage and lets
filters and column pruning reach the Parquet reader.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators.timeframe import PARTITION_DATE_COLUMNS, where_days

FEED_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("post_id", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("exp_group", T.IntegerType()),
    T.StructField("os", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("source", T.StringType()),
])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("reciever_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("os", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("source", T.StringType()),
])

# Fixed values of the fixture contract (how `events` stands in for the two
# action tables). Receivers are drawn from the first 15 user ids so that every
# receiver is a real user at each scale.
FEED_EVENT_TYPES = ("view", "click")
MESSAGE_EVENT_TYPE = "purchase"
RECEIVER_USERS = 15


@dataclass(frozen=True)
class Actions:
    feed: DataFrame
    message: DataFrame

    def until(self, day) -> Actions:
        """The actions up to the end of ``day``."""
        return Actions(feed=where_days(self.feed, None, day), message=where_days(self.message, None, day))


def check_schema(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Select the schema's columns in order, failing on missing columns or
    types that cannot be cast safely (numbers to numbers, any to string). A
    date partition column of the table stays behind them, so that day ranges
    prune partitions (``timeframe.where_days``)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    cols = []
    for f in schema.fields:
        src = have[f.name]
        if src != f.dataType:
            ok = (isinstance(f.dataType, T.StringType)
                  or (isinstance(src, T.NumericType) and isinstance(f.dataType, T.NumericType))
                  or (isinstance(src, (T.TimestampType, T.TimestampNTZType, T.DateType))
                      and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))))
            if not ok:
                raise TypeError(f"{name}.{f.name}: {src.simpleString()} is not {f.dataType.simpleString()}")
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    cols += [F.col(c) for c in PARTITION_DATE_COLUMNS if c in have and c not in schema.names][:1]
    return df.select(*cols)


def _user_attributes(name: str = "user_id") -> list[Column]:
    user_id = F.col(name)
    return [
        F.when(user_id % 2 == 0, F.lit("iOS")).otherwise(F.lit("Android")).alias("os"),
        (F.lit(15) + user_id % 50).cast("int").alias("age"),
        (F.expr(f"`{name}` div 3") % 2).cast("int").alias("gender"),
        F.when(user_id % 5 < 2, F.lit("ads")).otherwise(F.lit("organic")).alias("source"),
    ]


def _post_id(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("bigint")


def feed_from_events(events: DataFrame) -> DataFrame:
    """Feed actions from the events fixture: view stays view, click is a like."""
    uid = F.col("user_id")
    return (events
            .where(F.col("event_type").isin(*FEED_EVENT_TYPES))
            .select(
                uid,
                _post_id(F.col("props")).alias("post_id"),
                F.when(F.col("event_type") == "view", F.lit("view")).otherwise(F.lit("like")).alias("action"),
                F.col("ts").alias("time"),
                (uid % 4).cast("int").alias("exp_group"),
                *_user_attributes("user_id")))


def message_from_events(events: DataFrame) -> DataFrame:
    """Message actions from the events fixture: one purchase is one message."""
    uid = F.col("user_id")
    return (events
            .where(F.col("event_type") == MESSAGE_EVENT_TYPE)
            .select(
                uid,
                ((uid * 7 + _post_id(F.col("props"))) % RECEIVER_USERS).alias("reciever_id"),
                F.col("ts").alias("time"),
                *_user_attributes("user_id")))


EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's events, read with their declared schema (no footer
    inference on every read)."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def load_fixture(spark: SparkSession, sf_dir: str) -> Actions:
    events = read_events(spark, sf_dir)
    return Actions(feed=feed_from_events(events), message=message_from_events(events))


def read_actions(spark: SparkSession, feed: str = "feed_actions", message: str = "message_actions",
                 db: str | None = None, fmt: str | None = None) -> Actions:
    """Read both tables by catalog name (``db.feed_actions``) or by path.

    ``db`` plays the role of the database placeholder in the source queries.
    With ``fmt`` set (``parquet``, ``orc``, ``delta`` ...) the names are paths.
    """
    def load(name: str) -> DataFrame:
        if fmt:
            return spark.read.format(fmt).load(name)
        return spark.read.table(f"{db}.{name}" if db else name)

    return Actions(feed=check_schema(load(feed), FEED_SCHEMA, "feed_actions"),
                   message=check_schema(load(message), MESSAGE_SCHEMA, "message_actions"))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              schema: T.StructType | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, one_task: bool = False) -> DataFrame:
    """Read one action table from a JDBC database (the reference's store is a
    SQL database). A partition column splits the read over executors; a table
    known to be small may be read by one task with ``one_task``."""
    if not (partition_column or one_task):
        raise ValueError(f"{table}: pass partition_column with bounds, or one_task=True for a small table")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 64))
    df = reader.load()
    return check_schema(df, schema, table) if schema is not None else df


def register_views(actions: Actions, feed_name: str = "feed_actions",
                   message_name: str = "message_actions") -> None:
    """Expose the two tables as temporary views for ``spark.sql`` queries."""
    actions.feed.createOrReplaceTempView(feed_name)
    actions.message.createOrReplaceTempView(message_name)
