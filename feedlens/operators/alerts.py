"""Anomaly alert on 15-minute metrics of the feed and the messenger.

Series: feed and messenger metrics per 15-minute bucket from yesterday 00:00
up to (not including) the bucket that holds ``now``; messenger buckets are
left-joined onto feed buckets. Bands: for each metric, the mean and sample
standard deviation of the 4 buckets before, +/- a * std, the upper band then
smoothed over rows [-2, +1] and the lower band over rows [-3, 0]. Check: the
last bucket is an alert when it falls strictly outside its band.

The six metrics become one long table (``unpivot``), so the windows run once,
partitioned by metric; a window group is one metric's series, whose length is
set by the time range (buckets), not by the number of events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import fifteen_minute_start, fixed2, hh_mm, percent2, ratio
from feedlens.operators.timeframe import as_datetime, fifteen_minute_floor, ts_literal, where_days
from feedlens.sources.actions import Actions

# Metric keys and their display names (fixed values).
ALERT_METRICS = ["users_feed", "views", "likes", "ctr", "users_messenger", "number_messages"]
METRIC_LABELS = {
    "users_feed": "Feed audience",
    "views": "Views",
    "likes": "Likes",
    "ctr": "CTR",
    "users_messenger": "Messenger audience",
    "number_messages": "Messages sent",
}
BAND_WIDTH = 3.0
BAND_ROWS = 4


def alert_window(now, since=None) -> tuple[dt.datetime, dt.datetime]:
    """[yesterday 00:00, start of the current 15-minute bucket) for ``now``."""
    now = as_datetime(now)
    end = fifteen_minute_floor(now)
    start = as_datetime(since) if since is not None else dt.datetime.combine(
        now.date() - dt.timedelta(days=1), dt.time())
    return start, end


def alert_series(actions: Actions, now, since=None) -> DataFrame:
    """Columns: ts, date, hm, users_feed, views, likes, ctr (3 decimals),
    users_messenger, number_messages (0 for a bucket without messages)."""
    start, end = alert_window(now, since)

    def frame(df: DataFrame) -> DataFrame:
        # The source bounds only the feed side; bounding the messenger side as
        # well changes nothing for a left join on the bucket and prunes the scan.
        days = where_days(df, start.date(), (end - dt.timedelta(microseconds=1)).date())
        return days.where((F.col("time") >= ts_literal(start)) & (F.col("time") < ts_literal(end)))

    feed = (frame(actions.feed).groupBy(fifteen_minute_start("time").alias("ts"))
            .agg(F.count_distinct("user_id").alias("users_feed"),
                 F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes")))
    msg = (frame(actions.message).groupBy(fifteen_minute_start("time").alias("ts"))
           .agg(F.count_distinct("user_id").alias("users_messenger"),
                F.count("reciever_id").alias("number_messages")))
    return (feed.join(msg, "ts", "left")
            .select("ts", F.to_date("ts").alias("date"), hh_mm("ts").alias("hm"),
                    "users_feed", "views", "likes",
                    F.round(ratio("likes", "views"), 3).alias("ctr"),
                    F.coalesce(F.col("users_messenger"), F.lit(0)).alias("users_messenger"),
                    F.coalesce(F.col("number_messages"), F.lit(0)).alias("number_messages")))


def alert_long(series: DataFrame, metrics=ALERT_METRICS, keys=()) -> DataFrame:
    """(keys..., ts, metric, value) rows."""
    ids = [*keys, "ts"]
    return (series.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
            .unpivot(ids, list(metrics), "metric", "value"))


def ts_label(ts: str = "ts"):
    """A bucket as the alert chart prints it (dd/MM HH:mm)."""
    return F.date_format(ts, "dd/MM HH:mm")


def alert_bands(series: DataFrame, a: float = BAND_WIDTH, n: int = BAND_ROWS,
                metrics=ALERT_METRICS, keys=()) -> DataFrame:
    """Columns: [keys...,] metric, ts, label, value, prev_value, mean, std, up,
    low; with ``keys`` each of their values is a series of its own.

    mean and std cover the n rows before (NULL unless all n hold a value);
    the upper band is smoothed on a centred frame, the lower on a trailing one.
    """
    long = alert_long(series, metrics, keys)
    order = Window.partitionBy(*keys, "metric").orderBy("ts")
    before = order.rowsBetween(-n, -1)
    full = F.count("value").over(before) == n
    banded = long.select(
        *keys, "metric", "ts", "value",
        F.lag("value").over(order).alias("prev_value"),
        F.when(full, F.avg("value").over(before)).alias("mean"),
        F.when(full, F.stddev_samp("value").over(before)).alias("std"))
    half = n // 2
    up = F.col("mean") + a * F.col("std")
    low = F.col("mean") - a * F.col("std")
    return banded.select(
        *keys, "metric", "ts", ts_label("ts").alias("label"), "value", "prev_value", "mean", "std",
        F.avg(up).over(order.rowsBetween(-half, n - half - 1)).alias("up"),
        F.avg(low).over(order.rowsBetween(-(n - 1), 0)).alias("low"))


def alert_check(bands: DataFrame, keys=()) -> DataFrame:
    """The last bucket of each metric: is_alert when value < low or > up
    (a missing band never alerts), the change from the previous bucket, and
    the alert text. Columns: metric, ts, value, low, up, is_alert, deviation, message."""
    # The band table is already partitioned by metric and sorted by ts, so
    # this window adds neither a shuffle nor a sort.
    order = Window.partitionBy(*keys, "metric").orderBy("ts")
    last = (bands.withColumn("_next", F.lead("ts").over(order))
            .where(F.col("_next").isNull())
            .select(*keys, "metric", "ts", "value", "prev_value", "low", "up"))
    return flagged(last, keys)


def flagged(last: DataFrame, keys=()) -> DataFrame:
    """The result columns of ``alert_check`` from (metric, ts, value, prev_value, low, up)."""
    v = F.col("value")
    alert = F.coalesce((v < F.col("low")) | (v > F.col("up")), F.lit(False))
    deviation = F.abs(F.lit(1.0) - F.try_divide(v, F.col("prev_value")))
    label = F.lit(None).cast("string")
    for key, text in METRIC_LABELS.items():
        label = F.when(F.col("metric") == key, F.lit(text)).otherwise(label)
    message = F.concat(
        F.lit("Alert! Metric "), F.coalesce(label, F.col("metric")), F.lit(":\n- current value "),
        F.coalesce(fixed2(v), F.lit("n/a")), F.lit(";\n- deviation from the previous value "),
        F.coalesce(percent2(F.col("deviation")), F.lit("n/a")))
    out = last.select(*keys, "metric", "ts", "value", "low", "up", alert.alias("is_alert"),
                          deviation.alias("deviation"))
    return out.select("*", F.when(F.col("is_alert"), message).alias("message"))


def check_each(series: DataFrame, buckets: DataFrame) -> DataFrame:
    """``alert_check`` for each bucket (column ``ts``) of ``buckets`` as the last
    closed one: its series runs from the start of the day before the moment the
    bucket closed, as in ``alert_window``. ``series`` holds 15-minute rows of
    ``alert_series``; a bucket meets two days of it at most, by an equi-join on
    the date. Columns as ``alert_check``; the bucket is ``ts``."""
    closes = F.col("closed") + F.expr("INTERVAL 15 MINUTES")
    first = F.date_sub(F.to_date(closes), 1)
    wanted = (buckets.select(F.col("ts").alias("closed")).distinct()
              .withColumn("first", first)
              .withColumn("date", F.explode(F.sequence("first", F.to_date("closed")))))
    rows = series.withColumn("date", F.to_date("ts")).join(wanted, "date")
    within = rows.where(F.col("ts") <= F.col("closed"))
    checked = alert_check(alert_bands(within, keys=("closed",)), keys=("closed",))
    # a bucket without a row of its own (no feed actions) has nothing to test
    return checked.where(F.col("ts") == F.col("closed")).drop("closed")
