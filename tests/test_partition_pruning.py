import os

from pyspark.sql import functions as F

from feedlens.operators import experiments as ex
from feedlens.operators import metrics
from feedlens.sources.actions import feed_from_events


def test_date_partition_column_is_pruned(spark, tmp_dir):
    path = os.path.join(tmp_dir, "feed_by_day")
    feed = feed_from_events(spark.read.parquet("/root/testdata/sf0.01/events.parquet"))
    feed.withColumn("event_date", F.to_date("time")).write.partitionBy("event_date").parquet(path)
    part = spark.read.parquet(path)
    users = ex.user_ctr(part, "2024-01-08", "2024-01-14", groups=(1, 2))
    plan = users._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan
    assert "2024-01-08" in plan.split("PartitionFilters:")[1].split("]")[0] or "19730" in plan
    plain = ex.user_ctr(feed, "2024-01-08", "2024-01-14", groups=(1, 2))
    assert sorted(map(tuple, users.collect())) == sorted(map(tuple, plain.collect()))
    day = metrics.report_day(part, "2024-01-31").first()
    assert day.day.isoformat() == "2024-01-30"


def _partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]


def test_read_actions_keeps_the_partition_column(spark, tmp_dir):
    """Tables read as production reads them: every job's scans skip partitions."""
    from feedlens.operators import alerts, metrics, slices
    from feedlens.sources.actions import message_from_events, read_actions

    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    for name, part, df in (("feed", "event_date", feed_from_events(events)), ("message", "dt", message_from_events(events))):
        df.withColumn(part, F.to_date("time")).write.partitionBy(part).parquet(os.path.join(tmp_dir, name))
    actions = read_actions(spark, os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "message"), fmt="parquet")
    plain = (feed_from_events(events), message_from_events(events))
    jobs = {
        "slices": slices.daily_slices(actions.feed, actions.message, "2024-01-30", "2024-01-30"),
        "feed day": metrics.report_day(actions.feed, "2024-01-31"),
        "feed week": metrics.report_week(actions.feed, "2024-01-31"),
        "experiment": ex.user_ctr(actions.feed, "2024-01-08", "2024-01-14", groups=(1, 2)),
        "alert": alerts.alert_series(actions, "2024-01-30 12:00:00"),
        "until": metrics.product_daily(actions.until("2024-01-20")),
    }
    for name, df in jobs.items():
        filters = _partition_filters(df)
        assert filters and all("event_date" in f or "dt" in f for f in filters), name
    assert sorted(map(tuple, jobs["slices"].collect())) == sorted(
        map(tuple, slices.daily_slices(*plain, "2024-01-30", "2024-01-30").collect()))


def test_app_table_scans(spark, actions001):
    """One reading of the activity (feed and messages) and one of the feed's posts."""
    plan = metrics.product_daily(actions001)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 3
