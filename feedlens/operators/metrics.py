"""Daily product metrics of the feed and the messenger, and the report rows.

Daily series are aggregates keyed by day, so every shuffle carries at most
(days x tasks) partial rows; joins between daily series join tables with one
row per day. Distinct-user counts are exact (``count(DISTINCT)``); Spark
plans them as a (key, user) dedup step followed by a count, which spreads a
hot day or post over the user hash instead of one task.

The ``*_compat`` functions reproduce two joins of the source reports whose
results differ from the plain meaning (a daily join on the user only, and a
join that keeps only the left table's columns); they are computed without
materialising the fan-out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of, percent2, ratio
from feedlens.operators.timeframe import date_literal, where_days, yesterday
from feedlens.sources.actions import Actions

FEED_DAILY_METRICS = ("dau", "views", "likes", "ctr")
PRODUCT_METRICS = ("likes", "views", "messages_sent", "new_users", "new_posts",
                   "dau_message", "dau_feed", "dau_all_services")


def _count_where(cond: Column) -> Column:
    """countIf(user_id, cond): rows with a non-NULL user where cond holds."""
    return F.count(F.when(cond, F.col("user_id")))


def feed_daily(feed: DataFrame, start=None, end=None) -> DataFrame:
    """DAU, views, likes and CTR of the feed per day in [start, end]."""
    f = where_days(feed, start, end)
    return (f.groupBy(day_of("time").alias("day"))
            .agg(F.count_distinct("user_id").alias("dau"),
                 _count_where(F.col("action") == "view").alias("views"),
                 _count_where(F.col("action") == "like").alias("likes"))
            .withColumn("ctr", ratio("likes", "views")))


def report_day(feed: DataFrame, as_of) -> DataFrame:
    """Yesterday's feed metrics and the report text."""
    day = yesterday(as_of)
    d = feed_daily(feed, day, day)
    text = F.concat(
        F.lit("Feed report for "), F.date_format("day", "dd.MM.yyyy"), F.lit(":\nDAU: "),
        F.col("dau").cast("string"), F.lit("\nViews: "), F.col("views").cast("string"),
        F.lit("\nLikes: "), F.col("likes").cast("string"), F.lit("\nCTR: "),
        F.coalesce(percent2("ctr"), F.lit("n/a")))
    return d.withColumn("message", text)


def report_week(feed: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Feed metrics for each of the ``days`` full days before as_of."""
    end = yesterday(as_of)
    return feed_daily(feed, end - dt.timedelta(days=days - 1), end)


def long_series(daily: DataFrame, metrics, key: str = "day") -> DataFrame:
    """(day, label, metric, value) rows: one line per metric for any chart
    tool; label is the day as the report charts print it (dd/MM/yyyy)."""
    return (daily.select(key, F.date_format(key, "dd/MM/yyyy").alias("label"),
                         *[F.col(m).cast("double").alias(m) for m in metrics])
            .unpivot([key, "label"], list(metrics), "metric", "value"))


# --------------------------------------------------------------------------
# application report
# --------------------------------------------------------------------------

def _user_days(df: DataFrame) -> DataFrame:
    return df.select("user_id", day_of("time").alias("day"))


def user_day_activity(actions: Actions) -> DataFrame:
    """One row per (day, user) over both services: likes, views, messages
    sent, and service bits f (1 = feed, 2 = messenger).

    This is the one large shuffle of the application report: daily actions,
    DAU and new users are all small aggregates of it. Two aggregates that ask
    it for different columns are planned as two shuffles, so the report takes
    them from one table (``_daily_table``).
    """
    user = F.col("user_id")
    feed = actions.feed.select(
        day_of("time").alias("day"), "user_id",
        F.when(F.col("action") == "like", user).alias("_like"),
        F.when(F.col("action") == "view", user).alias("_view"),
        F.lit(None).cast("bigint").alias("_msg"), F.lit(1).alias("_f"))
    msg = actions.message.select(
        day_of("time").alias("day"), "user_id",
        F.lit(None).cast("bigint").alias("_like"), F.lit(None).cast("bigint").alias("_view"),
        F.col("reciever_id").alias("_msg"), F.lit(2).alias("_f"))
    return (feed.unionByName(msg).groupBy("day", "user_id")
            .agg(F.count("_like").alias("likes"), F.count("_view").alias("views"),
                 F.count("_msg").alias("messages_sent"), F.bit_or("_f").alias("f")))


def _daily_totals(activity: DataFrame, compat_dau: bool = False) -> DataFrame:
    f = F.col("f")
    all_users = F.count_if(f.bitwiseAND(1) == 1) if compat_dau else F.count(F.lit(1))
    return (activity.groupBy("day")
            .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"),
                 F.sum("messages_sent").alias("messages_sent"),
                 F.count_if(f == 2).alias("dau_message"), F.count_if(f == 1).alias("dau_feed"),
                 all_users.alias("dau_all_services")))


def daily_actions(actions: Actions) -> DataFrame:
    """Likes, views and messages sent per day over both services (the sums of
    the per-(day, user) tables joined on day and user)."""
    return _daily_totals(user_day_activity(actions)).select("day", "likes", "views", "messages_sent")


def daily_actions_compat(actions: Actions) -> DataFrame:
    """The source report's figures: per-(day, user) feed and message tables
    fully joined on the user only, rows keyed by the feed side's day.

    A feed row of a user with k message days appears k times (once if k = 0),
    and carries all of that user's messages; so the sums are computed with
    weights from a per-user message table instead of the k-fold join.
    """
    feed = (actions.feed.groupBy(day_of("time").alias("day"), "user_id")
            .agg(_count_where(F.col("action") == "like").alias("likes"),
                 _count_where(F.col("action") == "view").alias("views")))
    per_day = (actions.message.groupBy("user_id", day_of("time").alias("mday"))
               .agg(F.count("reciever_id").alias("m")))
    per_user = per_day.groupBy("user_id").agg(F.count(F.lit(1)).alias("k"), F.sum("m").alias("s"))
    k = F.greatest(F.coalesce(F.col("k"), F.lit(0)), F.lit(1))
    return (feed.join(per_user, "user_id", "left")
            .groupBy("day")
            .agg(F.sum(F.col("likes") * k).alias("likes"),
                 F.sum(F.col("views") * k).alias("views"),
                 F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("messages_sent")))


def _new_users(activity: DataFrame) -> DataFrame:
    first = activity.groupBy("user_id").agg(F.min("day").alias("day"))
    return first.groupBy("day").agg(F.count("user_id").alias("new_users"))


def new_users(actions: Actions) -> DataFrame:
    """Users per first day seen in either service."""
    return _new_users(user_day_activity(actions))


def new_posts(feed: DataFrame) -> DataFrame:
    """Posts per first day they appear in the feed."""
    first = feed.groupBy("post_id").agg(F.min(day_of("time")).alias("day"))
    return first.groupBy("day").agg(F.count("post_id").alias("new_posts"))


def _dau_present(d: DataFrame) -> Column:
    # the source joins the three daily DAU counts with inner joins
    return (F.col("dau_message") > 0) & (F.col("dau_feed") > 0)


def dau(actions: Actions, compat: bool = False) -> DataFrame:
    """Users of the messenger only, of the feed only, and of the app, per day.

    A day with no messenger-only or no feed-only user has no row (the source
    joins the three daily counts with inner joins). ``compat`` counts only
    feed users as users of the app, as the source query does.
    """
    d = _daily_totals(user_day_activity(actions), compat_dau=compat)
    return d.where(_dau_present(d)).select("day", "dau_message", "dau_feed", "dau_all_services")


def _daily_table(activity: DataFrame) -> DataFrame:
    """Daily totals, DAU and new users from one reading of the activity table.
    The first day of a user is a window over that user's days (one row per day
    of activity). DAU columns are NULL on days the DAU query drops, new users on
    days without any."""
    first = F.min("day").over(Window.partitionBy("user_id"))
    f, is_new = F.col("f"), (F.col("day") == F.col("_first")) & F.col("user_id").isNotNull()
    d = (activity.withColumn("_first", first).groupBy("day")
         .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"),
              F.sum("messages_sent").alias("messages_sent"),
              F.count_if(f == 2).alias("dau_message"), F.count_if(f == 1).alias("dau_feed"),
              F.count(F.lit(1)).alias("dau_all_services"), F.count_if(is_new).alias("_new")))
    keep = _dau_present(d)
    return d.select("day", "likes", "views", "messages_sent",
                    *[F.when(keep, F.col(c)).alias(c) for c in ("dau_message", "dau_feed", "dau_all_services")],
                    F.when(F.col("_new") > 0, F.col("_new")).alias("new_users"))


def product_daily(actions: Actions) -> DataFrame:
    """Actions, new users, new posts and DAU per day, outer-joined on the day.

    Every day with a new user or a new post also has actions, so the outer
    merges of the source reduce to one table of daily aggregates and a left
    join of the new posts per day. The feed is scanned twice (users, posts),
    the messages once.
    """
    daily = _daily_table(user_day_activity(actions))
    return daily.join(new_posts(actions.feed), "day", "left").select("day", *PRODUCT_METRICS)


# --------------------------------------------------------------------------
# incremental form: the app table from compact daily tables
# --------------------------------------------------------------------------

def first_seen(keys: DataFrame, key: str, earlier: DataFrame | None) -> DataFrame:
    """(key, day) of keys first seen in the given days: the earliest day per
    key within ``keys`` (columns key, day), minus keys already present in
    ``earlier`` (first-seen rows of earlier days). A partial aggregate, then
    an anti join on the key."""
    first = keys.groupBy(key).agg(F.min("day").alias("day"))
    if earlier is not None:
        first = first.join(earlier.select(key), key, "left_anti")
    return first


def product_daily_from_tables(activity: DataFrame, user_first: DataFrame, post_first: DataFrame) -> DataFrame:
    """``product_daily`` from the compact tables kept by the daily activity
    job (per-(day, user) activity, users' and posts' first-seen days): the
    same columns and rows, without reading raw events."""
    d = _daily_totals(activity)
    keep = _dau_present(d)
    daily = d.select("day", "likes", "views", "messages_sent",
                     *[F.when(keep, F.col(c)).alias(c) for c in ("dau_message", "dau_feed", "dau_all_services")])
    nu = user_first.groupBy("day").agg(F.count("user_id").alias("new_users"))
    npost = post_first.groupBy("day").agg(F.count("post_id").alias("new_posts"))
    out = daily.join(nu, "day", "left").join(npost, "day", "left")
    return out.select("day", *PRODUCT_METRICS)


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("n/a"))


def product_report_day(actions: Actions, as_of, daily: DataFrame | None = None) -> DataFrame:
    """Yesterday's row of the application table and the report text
    (``daily``: an already computed ``product_daily`` table)."""
    day = yesterday(as_of)
    table = daily if daily is not None else product_daily(actions)
    d = table.where(F.col("day") == date_literal(day))
    text = F.concat(
        F.lit("App report for "), F.date_format("day", "dd.MM.yyyy"), F.lit(":\nNew users: "),
        _text("new_users"), F.lit("\nDAU: "), _text("dau_all_services"),
        F.lit("\nNew posts: "), _text("new_posts"), F.lit("\nViews: "), _text("views"),
        F.lit("\nLikes: "), _text("likes"))
    return d.withColumn("message", text)


def top_posts(feed: DataFrame, k: int = 10) -> DataFrame:
    """The k most viewed posts (ties by post id) with likes, CTR and users.
    Planned as a per-task top-k and a merge, not a global sort."""
    return (feed.groupBy("post_id")
            .agg(F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_distinct("user_id").alias("uniq_users"))
            .withColumn("ctr", ratio("likes", "views"))
            .orderBy(F.desc("views"), F.asc("post_id"))
            .limit(k)
            .select("post_id", "views", "likes", "ctr", "uniq_users"))

