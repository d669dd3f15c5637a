"""Daily slice table: feed and messenger activity per day by os, age and gender.

Plan: per-(day, user) feed counts and message counts (sent, received) are
aggregates; sent and received meet in an inner join on (day, user), feed and
messages in a full outer join on the five user keys, and the three slices come
out of one grouping-sets aggregate (one Expand feeding one hash aggregate)
instead of three group-bys and a union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of
from feedlens.operators.timeframe import where_days

USER_KEYS = ["event_date", "user_id", "os", "age", "gender"]
SLICE_DIMENSIONS = ("os", "age", "gender")
SLICE_METRICS = ["views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"]
SLICE_COLUMNS = ["event_date", "dimension", "dimension_value", *SLICE_METRICS]


def _days(df: DataFrame, start, end) -> DataFrame:
    return where_days(df, start, end)


def etl_feed(feed: DataFrame, start=None, end=None) -> DataFrame:
    """Views and likes per (event_date, user_id, os, age, gender)."""
    return (_days(feed, start, end)
            .groupBy(day_of("time").alias("event_date"), "user_id", "os", "age", "gender")
            .agg(F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes")))


def etl_messages(message: DataFrame, start=None, end=None) -> DataFrame:
    """Messages and distinct partners sent and received per user and day.

    Users who received but did not send that day are dropped (inner join), as
    in the source job; the join is on (day, user) so several days can run at once.
    """
    m = _days(message, start, end).withColumn("event_date", day_of("time"))
    sent = (m.groupBy(*USER_KEYS)
            .agg(F.count(F.lit(1)).alias("messages_sent"),
                 F.count_distinct("reciever_id").alias("users_sent")))
    received = (m.groupBy("event_date", F.col("reciever_id").alias("user_id"))
                .agg(F.count(F.lit(1)).alias("messages_received"),
                     F.count_distinct("user_id").alias("users_received")))
    return (sent.join(received, ["event_date", "user_id"], "inner")
            .select(*USER_KEYS, "messages_received", "messages_sent", "users_received", "users_sent"))


def etl_total(feed_part: DataFrame, message_part: DataFrame) -> DataFrame:
    """Full outer join of the two per-user tables on all five user keys, where
    NULL attributes match each other; metrics of the missing side stay NULL."""
    other = message_part.select(*[F.col(k).alias(f"_m_{k}") for k in USER_KEYS], *SLICE_METRICS[2:])
    same = [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in USER_KEYS]
    keys = [F.coalesce(F.col(k), F.col(f"_m_{k}")).alias(k) for k in USER_KEYS]
    return feed_part.join(other, same, "full").select(*keys, "views", "likes", *SLICE_METRICS[2:])


def etl_slices(total: DataFrame, dimensions=SLICE_DIMENSIONS) -> DataFrame:
    """Sums of every metric per (event_date, dimension value) for each
    dimension; NULL metrics count as 0 and rows with a NULL dimension value
    are left out of that dimension."""
    dims = list(dimensions)
    g = (total.groupingSets([["event_date", d] for d in dims], "event_date", *dims)
         .agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in SLICE_METRICS],
              *[F.grouping(d).alias(f"_g_{d}") for d in dims]))
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for d in dims:
        chosen = F.col(f"_g_{d}") == 0
        name = F.when(chosen, F.lit(d)).otherwise(name)
        value = F.when(chosen, F.col(d).cast("string")).otherwise(value)
    return (g.select("event_date", name.alias("dimension"), value.alias("dimension_value"), *SLICE_METRICS)
            .where(F.col("dimension_value").isNotNull()))


def daily_slices(feed: DataFrame, message: DataFrame, start=None, end=None) -> DataFrame:
    """The whole slice job for the days in [start, end]."""
    return etl_slices(etl_total(etl_feed(feed, start, end), etl_messages(message, start, end)))
