"""Audience over time: weekly new / retained / gone users, retention by
traffic source, campaign cohorts, and who went missing on a bad day.

Each job first reduces events to distinct (user, period) rows with an
aggregate whose partial step runs before the shuffle; per-user ordering then
uses windows partitioned by user, whose groups are bounded by the number of
periods (weeks or days), not by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import add_weeks, day_of, monday, ratio
from feedlens.operators.timeframe import date_literal, where_days
from feedlens.sources.actions import Actions


# --------------------------------------------------------------------------
# weekly audience
# --------------------------------------------------------------------------

def _user_weeks(actions: Actions, feed_only: bool) -> DataFrame:
    cols = ["user_id", monday(day_of("time")).alias("week")]
    seen = actions.feed.select(*cols)
    if not feed_only:
        seen = seen.unionByName(actions.message.select(*cols))
    return seen.distinct()


def _with_neighbours(user_weeks: DataFrame) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("week")
    return (user_weeks
            .withColumn("prev_seen", F.lag("week").over(w))
            .withColumn("next_seen", F.lead("week").over(w)))


def _weekly_rows(actions: Actions, feed_only: bool) -> DataFrame:
    """One row per (user, active week) with the user's previous and next
    active weeks."""
    return _with_neighbours(_user_weeks(actions, feed_only))


def weekly_audience_from_activity(activity: DataFrame, as_of, feed_only: bool = False,
                                  approx: bool = False) -> DataFrame:
    """``weekly_audience`` from the per-(day, user) activity table (bit 1 of
    ``f`` = feed) instead of raw events."""
    a = activity.where(F.col("f").bitwiseAND(1) == 1) if feed_only else activity
    weeks = a.select("user_id", monday("day").alias("week")).distinct()
    return _weekly_counts(_with_neighbours(weeks), as_of, approx)


def weekly_audience(actions: Actions, as_of, feed_only: bool = False,
                    approx: bool = False) -> DataFrame:
    """Users per (this_week, status): 'new' (not active the week before,
    including a return after a gap), 'retained' (active the week before too)
    and 'gone' (active the week before, not this week; counted negative).
    Gone users of the week after as_of's week are left out, since that week
    has not happened. Columns: this_week, previous_week, num_users, status.

    Each (user, week) row yields its own status row and, when the user skips
    the next week, a 'gone' row for that week; one aggregate counts both.
    """
    return _weekly_counts(_weekly_rows(actions, feed_only), as_of, approx)


def weekly_status(actions: Actions, as_of, feed_only: bool = False) -> DataFrame:
    """One row per user, week and status behind ``weekly_audience``: user_id, this_week, previous_week, status."""
    return _status_rows(_weekly_rows(actions, feed_only), as_of)


def _status_rows(rows: DataFrame, as_of) -> DataFrame:
    week = F.col("week")
    active = F.struct(
        week.alias("this_week"), add_weeks("week", -1).alias("previous_week"),
        F.when(F.col("prev_seen") == add_weeks("week", -1), F.lit("retained"))
        .otherwise(F.lit("new")).alias("status"))
    gone = F.when(
        F.col("next_seen").isNull() | (F.col("next_seen") != add_weeks("week", 1)),
        F.struct(add_weeks("week", 1).alias("this_week"), week.alias("previous_week"),
                 F.lit("gone").alias("status")))
    out = (rows.select("user_id", F.explode(F.array(active, gone)).alias("r"))
           .where(F.col("r").isNotNull())
           .select("user_id", "r.*"))
    next_week_of_as_of = F.date_add(monday(date_literal(as_of)), 7)
    return out.where(~((F.col("status") == "gone") & (F.col("this_week") == next_week_of_as_of)))


def _weekly_counts(rows: DataFrame, as_of, approx: bool) -> DataFrame:
    users = F.approx_count_distinct("user_id") if approx else F.count(F.lit(1))
    sign = F.when(F.col("status") == "gone", F.lit(-1)).otherwise(F.lit(1))
    return (_status_rows(rows, as_of).groupBy("this_week", "previous_week", "status")
            .agg((users * F.first(sign)).cast("bigint").alias("num_users"))
            .select("this_week", "previous_week", "num_users", "status"))


def weekly_audience_totals(weekly: DataFrame) -> DataFrame:
    """Net users per week (gone users count negative) and the week's label on
    the report chart (dd/MM/yyyy)."""
    return (weekly.groupBy("this_week").agg(F.sum("num_users").cast("bigint").alias("num_users"))
            .select("this_week", F.date_format("this_week", "dd/MM/yyyy").alias("label"), "num_users"))


def weekly_audience_series(weekly: DataFrame) -> DataFrame:
    """The bars of the report chart: users per week and status, with the label."""
    return weekly.select("this_week", F.date_format("this_week", "dd/MM/yyyy").alias("label"), "status", "num_users")


# --------------------------------------------------------------------------
# retention
# --------------------------------------------------------------------------

def _active_days(feed: DataFrame, start=None, end=None) -> DataFrame:
    """Distinct (user, day) with the user's cohort (first day), source and
    the day number since the cohort day."""
    f = where_days(feed, start, end)
    ud = f.groupBy("user_id", day_of("time").alias("day")).agg(F.min("source").alias("source"))
    w = Window.partitionBy("user_id")
    return (ud.withColumn("cohort_date", F.min("day").over(w))
            .withColumn("source", F.min("source").over(w))
            .withColumn("day_n", F.datediff("day", "cohort_date")))


def _retention(days: DataFrame, segment_cols: list[str]) -> DataFrame:
    keys = segment_cols + ["cohort_date", "day_n"]
    agg = days.groupBy(*keys).agg(F.count(F.lit(1)).alias("active_users"))
    # The aggregate is small (segments x cohort days x day numbers); one
    # cohort is a window group of at most (number of days) rows.
    w = Window.partitionBy(*segment_cols, "cohort_date")
    return (agg.withColumn("cohort_users",
                           F.max(F.when(F.col("day_n") == 0, F.col("active_users"))).over(w))
            .withColumn("retention", ratio("active_users", "cohort_users"))
            .select(*keys, "active_users", "cohort_users", "retention"))


def retention_by_source(feed: DataFrame, start=None, end=None) -> DataFrame:
    """Active users and share of the cohort per (source, cohort day, day n)."""
    return _retention(_active_days(feed, start, end), ["source"])


def campaign_retention(feed: DataFrame, campaign_start, campaign_end, start=None, end=None) -> DataFrame:
    """Retention of cohorts that arrived during a campaign against the
    other cohorts: segment is 'campaign' or 'other'."""
    d = _active_days(feed, start, end)
    in_campaign = F.col("cohort_date").between(date_literal(campaign_start), date_literal(campaign_end))
    d = d.withColumn("segment", F.when(in_campaign, F.lit("campaign")).otherwise(F.lit("other")))
    return _retention(d, ["segment"])


# --------------------------------------------------------------------------
# audience drop
# --------------------------------------------------------------------------

DROP_DIMENSIONS = ("os", "gender", "age", "source")


def audience_drop(actions: Actions, base_start, base_end, drop_day,
                  dimensions=DROP_DIMENSIONS) -> DataFrame:
    """Users active in [base_start, base_end] but absent on ``drop_day``,
    counted by each dimension next to the base count.

    A user counts once per value of a dimension, however many combinations of
    attributes the user had; with several values of one attribute the user
    counts under each. Absence is a left join with the drop day's users.
    Columns: dimension, dimension_value, users_base, users_missing, share_missing.
    """
    cols = ["user_id", *dimensions]

    def seen(df: DataFrame, start, end) -> DataFrame:
        return where_days(df, start, end).select(*cols)

    base = (seen(actions.feed, base_start, base_end)
            .unionByName(seen(actions.message, base_start, base_end)).distinct()
            .select("user_id", *[F.col(d).cast("string").alias(d) for d in dimensions])
            .unpivot(["user_id"], list(dimensions), "dimension", "dimension_value")
            .where(F.col("dimension_value").isNotNull()).distinct())
    present = (seen(actions.feed, drop_day, drop_day).select("user_id")
               .unionByName(seen(actions.message, drop_day, drop_day).select("user_id"))
               .distinct().withColumn("present", F.lit(True)))
    return (base.join(present, "user_id", "left").groupBy("dimension", "dimension_value")
            .agg(F.count(F.lit(1)).alias("users_base"),
                 F.count_if(F.col("present").isNull()).alias("users_missing"))
            .withColumn("share_missing", ratio("users_missing", "users_base")))
