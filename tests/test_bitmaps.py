"""Activity bitmaps: kept a day at a time, they answer what the whole history answers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from feedlens.operators import bitmaps, cohorts
from feedlens.operators.timeframe import where_days
from feedlens.plans import jobs
from feedlens.plans import params as P
from feedlens.sources.actions import FEED_SCHEMA, MESSAGE_SCHEMA, Actions


def _rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple(map(str, r)))


def _actions(spark, seen, sent=()):
    """seen, sent: (user_id, day number from 2023-11-01)"""
    at = lambda n: dt.datetime(2023, 11, 1, 9) + dt.timedelta(days=n)
    feed = [(u, 1, "view", at(n), 0, "iOS", 20, 0, "ads" if u % 2 else "organic") for u, n in seen]
    message = [(u, 2, at(n), "iOS", 20, 0, "ads") for u, n in sent]
    return Actions(spark.createDataFrame(feed, FEED_SCHEMA), spark.createDataFrame(message, MESSAGE_SCHEMA))


def test_long_histories_over_many_blocks(spark):
    rnd = random.Random(3)
    seen = [(u, n) for u in range(60) for n in range(200) if rnd.random() < (0.02 if u % 3 else 0.15)]
    sent = [(u, n) for u in range(40, 80) for n in range(200) if rnd.random() < 0.03]
    actions = _actions(spark, seen, sent)
    table = bitmaps.user_bitmaps(actions).cache()
    assert table.groupBy("user_id", "block").count().where("count > 1").count() == 0
    assert table.select("block").distinct().count() >= 4 and table.where(F.dayofweek("block") != 2).count() == 0
    for as_of in ("2024-05-20", "2024-02-01"):
        for feed_only in (False, True):
            part = actions.until(as_of)
            assert _rows(bitmaps.weekly_audience(bitmaps.user_bitmaps(part), as_of, feed_only)) == \
                _rows(cohorts.weekly_audience(part, as_of, feed_only))
    assert _rows(bitmaps.retention_by_source(table)) == _rows(cohorts.retention_by_source(actions.feed))
    assert _rows(bitmaps.campaign_retention(table, "2023-11-05", "2023-12-24")) == \
        _rows(cohorts.campaign_retention(actions.feed, "2023-11-05", "2023-12-24"))
    table.unpersist()


def test_daily_job_reads_one_day_and_equals_the_history(spark, actions001, tmp_dir):
    whole = actions001.until("2024-01-12")
    order = ["2024-01-05", *(f"2024-01-{d:02d}" for d in (6, 7, 8, 9, 10, 11, 12)), "2024-01-09"]   # a rerun at the end
    jobs.daily_bitmap_job(whole, tmp_dir, start="2024-01-01", end="2024-01-04")
    for day in order:
        # the job gets nothing but its day: no other day is needed
        only = Actions(*(where_days(t, day, day) for t in (whole.feed, whole.message)))
        jobs.daily_bitmap_job(only, tmp_dir, start=day)
    table = jobs.read_bitmaps(spark, tmp_dir)
    assert _rows(table) == _rows(bitmaps.user_bitmaps(whole))
    assert _rows(bitmaps.weekly_audience(table, "2024-01-12")) == _rows(cohorts.weekly_audience(whole, "2024-01-12"))
    assert _rows(bitmaps.retention_by_source(table)) == _rows(cohorts.retention_by_source(whole.feed))


def test_rerun_takes_back_a_day(spark, tmp_dir):
    """Actions that are gone in a rerun lose their bits, and users without days their rows."""
    jobs.daily_bitmap_job(_actions(spark, [(1, 10), (1, 11), (2, 11)]), tmp_dir, start="2023-11-11", end="2023-11-12")
    jobs.daily_bitmap_job(_actions(spark, [(1, 10)]), tmp_dir, start="2023-11-12")
    assert _rows(jobs.read_bitmaps(spark, tmp_dir)) == _rows(bitmaps.user_bitmaps(_actions(spark, [(1, 10)])))


def test_empty_actions(spark):
    actions = _actions(spark, [])
    table = bitmaps.user_bitmaps(actions)
    assert table.count() == 0 and bitmaps.weekly_audience(table, P.AS_OF).count() == 0
    assert bitmaps.retention_by_source(table).count() == 0
