"""Activity bitmaps: one row per user and block of eight weeks, one bit per day.

A block begins on a Monday, so the seven bits of a week lie in one number and a week's
activity is one mask. The table keeps the whole history in a few rows a user and
is updated a day at a time by OR; what it is asked is answered by bit operations:

* the weeks of a block as eight bits, those of the week before as the same bits shifted
  by one, hence new, retained and gone users by AND and NOT;
* retention by adding up the bits of each day over the users of a cohort.

Users are never expanded into (user, week) or (user, day) rows: the sums of all
weeks or days of a block come out of one aggregate with a column for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of, monday, ratio
from feedlens.operators.timeframe import date_literal, where_days
from feedlens.sources.actions import Actions

WEEKS = 8
DAYS = 7 * WEEKS
#: A Monday; blocks are counted from it in both directions.
ORIGIN = "1970-01-05"

SCHEMA = "user_id bigint, feed_days bigint, days bigint, source string, block date"


def block_of(day: Column | str) -> Column:
    """First day of the block that a day lies in."""
    day = F.col(day) if isinstance(day, str) else day
    origin = F.lit(ORIGIN).cast("date")
    return F.date_add(origin, (F.floor(F.datediff(day, origin) / DAYS) * DAYS).cast("int"))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def _has(bits: Column, at: int) -> Column:
    return F.shiftright(bits, at).bitwiseAND(F.lit(1).cast("bigint"))


def user_bitmaps(actions: Actions, start=None, end=None) -> DataFrame:
    """(user_id, feed_days, days, source, block) of the days [start, end]: bits of the days on which the user was
    active in the feed, and in either service; the source is the smallest of the user's feed actions in the block."""
    def rows(df: DataFrame, feed: bool) -> DataFrame:
        day = where_days(df, start, end).select("user_id", day_of("time").alias("day"),
                                                (F.col("source") if feed else F.lit(None).cast("string")).alias("source"))
        bit = _bit(F.datediff("day", block_of("day")))
        return day.select("user_id", block_of("day").alias("block"), "source", bit.alias("bit"),
                          F.when(F.lit(feed), bit).otherwise(F.lit(0).cast("bigint")).alias("feed_bit"))

    seen = rows(actions.feed, True).unionByName(rows(actions.message, False))
    return (seen.groupBy("user_id", "block").agg(F.bit_or("feed_bit").alias("feed_days"), F.bit_or("bit").alias("days"),
                                                 F.min("source").alias("source"))
            .select("user_id", "feed_days", "days", "source", "block"))


def updated(table: DataFrame, actions: Actions, start, end) -> DataFrame:
    """The table's blocks that hold any of the days [start, end], with those days' bits as the actions have them.

    Only these days of the actions are read. The bits of other days stay, so days
    may be run again or out of order. Users without any day left have no row.
    """
    first, last = date_literal(start), date_literal(end)
    held = table.where(F.col("block").between(block_of(first), block_of(last)))
    lo = F.greatest(F.datediff(first, F.col("block")), F.lit(0))
    hi = F.least(F.datediff(last, F.col("block")), F.lit(DAYS - 1))
    other = F.bitwise_not(_bit(hi + 1) - _bit(lo))
    kept = held.select("user_id", *[F.col(c).bitwiseAND(other).alias(c) for c in ("feed_days", "days")], "source", "block")
    return (kept.unionByName(user_bitmaps(actions, start, end)).groupBy("user_id", "block")
            .agg(F.bit_or("feed_days").alias("feed_days"), F.bit_or("days").alias("days"), F.min("source").alias("source"))
            .where("days <> 0").select("user_id", "feed_days", "days", "source", "block"))


# --------------------------------------------------------------------------
# weekly audience
# --------------------------------------------------------------------------

def _weeks(days: Column) -> Column:
    """Eight bits: the weeks of a block with any active day."""
    bits = F.lit(0).cast("bigint")
    for w in range(WEEKS):
        bits = bits.bitwiseOR(F.when(days.bitwiseAND(F.lit(127 << 7 * w).cast("bigint")) != 0, F.lit(1 << w).cast("bigint"))
                              .otherwise(F.lit(0).cast("bigint")))
    return bits


def weekly_audience(table: DataFrame, as_of, feed_only: bool = False) -> DataFrame:
    """``cohorts.weekly_audience`` from the bitmaps: this_week, previous_week, num_users, status."""
    weeks = (table.withColumn("w", _weeks(F.col("feed_days" if feed_only else "days"))).where("w <> 0")
             .select("user_id", "block", "w"))
    order = Window.partitionBy("user_id").orderBy("block")
    near = weeks.withColumns({
        # the last week of the block before and the first of the one after, if the user has them
        "before": F.when(F.lag("block").over(order) == F.date_add("block", -DAYS), _has(F.lag("w").over(order), WEEKS - 1)),
        "after": F.when(F.lead("block").over(order) == F.date_add("block", DAYS), _has(F.lead("w").over(order), 0))})
    w = F.col("w")
    zero = F.lit(0).cast("bigint")
    previous = F.shiftleft(w, 1).bitwiseOR(F.coalesce("before", zero))
    following = w.bitwiseOR(F.shiftleft(F.coalesce("after", zero), WEEKS))
    told = near.select("block", w.bitwiseAND(F.bitwise_not(previous)).alias("new"), w.bitwiseAND(previous).alias("retained"),
                       F.shiftleft(w, 1).bitwiseAND(F.bitwise_not(following)).alias("gone"))
    # a column for every status and week of a block; 'gone' reaches the week after it
    counts = told.groupBy("block").agg(*[F.sum(_has(F.col(s), i)).alias(f"{s}_{i}")
                                         for s in ("new", "retained", "gone") for i in range(WEEKS + 1)])
    rows = counts.select(F.explode(F.array(*[F.struct(
        F.date_add("block", 7 * i).alias("this_week"), F.lit(s).alias("status"), F.col(f"{s}_{i}").alias("n"))
        for s in ("new", "retained", "gone") for i in range(WEEKS + 1)])).alias("r")).select("r.*").where("n > 0")
    sign = F.when(F.col("status") == "gone", F.lit(-1)).otherwise(F.lit(1))
    next_week = F.date_add(monday(date_literal(as_of)), 7)
    return (rows.where(~((F.col("status") == "gone") & (F.col("this_week") == next_week)))
            .groupBy("this_week", "status").agg(F.sum(F.col("n") * sign).alias("num_users"))
            .select("this_week", F.date_add("this_week", -7).alias("previous_week"), "num_users", "status"))


# --------------------------------------------------------------------------
# retention
# --------------------------------------------------------------------------

def _retained(table: DataFrame, segment: Column, name: str) -> DataFrame:
    """Users of each (segment, cohort day) active n days later: the bits of each day added up."""
    feed = table.where("feed_days <> 0")
    lowest = F.bit_count(F.col("feed_days").bitwiseAND(-F.col("feed_days")) - 1)
    user = Window.partitionBy("user_id")
    users = feed.select("feed_days", "block", F.min(F.date_add("block", lowest.cast("int"))).over(user).alias("cohort_date"),
                        F.min("source").over(user).alias("source"))
    users = users.select(segment.alias(name), "cohort_date", "block", "feed_days")
    sums = users.groupBy(name, "cohort_date", "block").agg(*[F.sum(_has(F.col("feed_days"), i)).alias(f"d{i}") for i in range(DAYS)])
    rows = sums.select(name, "cohort_date", F.explode(F.array(*[F.struct(
        F.datediff(F.date_add("block", i), F.col("cohort_date")).alias("day_n"), F.col(f"d{i}").alias("active_users"))
        for i in range(DAYS)])).alias("r")).select(name, "cohort_date", "r.*").where("active_users > 0")
    cohort = Window.partitionBy(name, "cohort_date")  # one cohort: at most a row per day
    return (rows.withColumn("cohort_users", F.max(F.when(F.col("day_n") == 0, F.col("active_users"))).over(cohort))
            .withColumn("retention", ratio("active_users", "cohort_users"))
            .select(name, "cohort_date", "day_n", "active_users", "cohort_users", "retention"))


def retention_by_source(table: DataFrame) -> DataFrame:
    """``cohorts.retention_by_source`` over the table's whole history."""
    return _retained(table, F.col("source"), "source")


def campaign_retention(table: DataFrame, campaign_start, campaign_end) -> DataFrame:
    """``cohorts.campaign_retention`` over the table's whole history."""
    came = F.col("cohort_date").between(date_literal(campaign_start), date_literal(campaign_end))
    return _retained(table, F.when(came, F.lit("campaign")).otherwise(F.lit("other")), "segment")
