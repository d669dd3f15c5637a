import glob
import os

from feedlens.plans import jobs
from feedlens.plans import params as P


def test_daily_slices_job_is_idempotent(spark, actions001, tmp_dir):
    target = os.path.join(tmp_dir, "slices")
    first = jobs.daily_slices_job(actions001, P.AS_OF, target).count()
    jobs.daily_slices_job(actions001, P.AS_OF, target)   # a retry
    back = spark.read.parquet(target)
    assert back.count() == first > 0
    assert {r.event_date.isoformat() for r in back.select("event_date").distinct().collect()} == {"2024-01-30"}


def test_report_jobs(spark, actions001, tmp_dir):
    feed = jobs.feed_report_job(actions001, P.AS_OF, tmp_dir)
    assert feed.message.startswith("Feed report for 30.01.2024:\nDAU: ")
    assert feed.tables["week"].count() == 7
    app = jobs.app_report_job(actions001, P.AS_OF, tmp_dir)
    assert app.message.startswith("App report for 30.01.2024:\nNew users: ")
    assert len(glob.glob(os.path.join(tmp_dir, "app_report", "*", "top_posts", "*.csv"))) == 1
    assert spark.read.parquet(os.path.join(tmp_dir, "app_report", "as_of=2024-01-31", "series")).count() > 0


def test_alert_job(spark, actions001, tmp_dir):
    rows = jobs.alert_job(actions001, P.NOW, tmp_dir)
    assert set(rows.columns) >= {"metric", "value", "is_alert", "message"}
    stored = spark.read.parquet(os.path.join(tmp_dir, "alerts"))
    assert stored.count() == 6


def test_ab_and_aa_jobs(spark, actions001, tmp_dir):
    rows = jobs.ab_test_job(actions001, P.EXP_START, P.EXP_END, 1, 2, reps=200, buckets=20,
                            out_dir=tmp_dir).collect()
    assert len(rows) == 7 and all(0.0 <= r.p_value <= 1.0 for r in rows)
    out = jobs.aa_test_job(actions001, P.EXP_START, P.EXP_END, (2, 3), reps=300, sample=20, out_dir=tmp_dir)
    assert out.message.startswith("A/A: ") and "of 300 tests" in out.message
    assert sum(r.n for r in out.tables["histogram"].collect()) == 300


def _rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple(map(str, r)))


def test_incremental_tables_equal_full_history(spark, actions001, tmp_dir):
    from feedlens.operators import cohorts, metrics
    tables = os.path.join(tmp_dir, "tables")
    jobs.daily_activity_job(actions001, tables, start="2024-01-01", end="2024-01-25")   # backfill
    for d in range(27, 32):                                                            # then daily runs
        jobs.daily_activity_job(actions001, tables, as_of=f"2024-01-{d:02d}")
    jobs.daily_activity_job(actions001, tables, as_of="2024-01-31")                     # a retry
    activity, uf, pf = jobs.read_activity_tables(spark, tables)
    assert _rows(metrics.product_daily_from_tables(activity, uf, pf)) == _rows(metrics.product_daily(actions001))
    assert _rows(cohorts.weekly_audience_from_activity(activity, P.AS_OF)) == \
        _rows(cohorts.weekly_audience(actions001, P.AS_OF))
    assert _rows(cohorts.weekly_audience_from_activity(activity, P.AS_OF, feed_only=True)) == \
        _rows(cohorts.weekly_audience(actions001, P.AS_OF, feed_only=True))
    assert uf.count() == uf.select("user_id").distinct().count()
    out = jobs.app_report_job(actions001, P.AS_OF, tables_dir=tables)
    assert out.message == jobs.app_report_job(actions001, P.AS_OF).message


def _job_rows(spark, tables):
    return [_rows(spark.read.parquet(os.path.join(tables, n)).select(*c)) for n, c in (
        (jobs.ACTIVITY, ("day", "user_id", "likes", "views", "messages_sent", "f")),
        (jobs.USER_FIRST_SEEN, ("day", "user_id")), (jobs.POST_FIRST_SEEN, ("day", "post_id")))]


def test_rerun_of_an_earlier_day(spark, actions001, tmp_dir):
    """Late rows of a day arrive after later days ran: the rerun gives the tables of one run over all."""
    from pyspark.sql import functions as F

    from feedlens.operators.timeframe import where_days
    from feedlens.sources.actions import Actions

    early = where_days(actions001.feed, "2024-01-01", "2024-01-07"), where_days(actions001.message, "2024-01-01", "2024-01-07")
    user = early[0].where(F.to_date("time") == F.lit("2024-01-01")).orderBy("user_id").first().user_id
    late = F.col("user_id").eqNullSafe(user) & (F.to_date("time") == F.lit("2024-01-01"))
    partial = Actions(*(t.where(~late) for t in early))
    whole = Actions(*early)
    tables, once = os.path.join(tmp_dir, "rerun"), os.path.join(tmp_dir, "once")
    for d in range(1, 8):
        jobs.daily_activity_job(partial, tables, start=f"2024-01-{d:02d}")
    jobs.daily_activity_job(whole, tables, start="2024-01-01")
    jobs.daily_activity_job(whole, once, start="2024-01-01", end="2024-01-07")
    assert _job_rows(spark, tables) == _job_rows(spark, once)
    first = spark.read.parquet(os.path.join(tables, jobs.USER_FIRST_SEEN)).where(F.col("user_id") == user).collect()
    assert [r.day.isoformat() for r in first] == ["2024-01-01"]


def test_day_emptied_by_a_rerun(spark, actions001, tmp_dir):
    from pyspark.sql import functions as F

    from feedlens.operators.timeframe import where_days
    from feedlens.sources.actions import Actions

    week = Actions(*(where_days(t, "2024-01-01", "2024-01-04") for t in (actions001.feed, actions001.message)))
    without = Actions(*(t.where(F.to_date("time") != F.lit("2024-01-01")) for t in (week.feed, week.message)))
    tables, once = os.path.join(tmp_dir, "emptied"), os.path.join(tmp_dir, "once")
    jobs.daily_activity_job(week, tables, start="2024-01-01", end="2024-01-04")
    jobs.daily_activity_job(without, tables, start="2024-01-01")
    jobs.daily_activity_job(without, once, start="2024-01-01", end="2024-01-04")
    assert _job_rows(spark, tables) == _job_rows(spark, once)


def test_unreadable_table_is_an_error(spark, actions001, tmp_dir):
    """A damaged first-seen table must not count as an empty one."""
    import pytest
    tables = os.path.join(tmp_dir, "damaged")
    jobs.daily_activity_job(actions001, tables, start="2024-01-01", end="2024-01-02")
    for f in glob.glob(os.path.join(tables, jobs.USER_FIRST_SEEN, "day=2024-01-01", "*.parquet")):
        with open(f, "wb") as out:
            out.write(b"not a table")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    with pytest.raises(Exception):
        jobs.daily_activity_job(actions001, tables, start="2024-01-03")


def test_rerun_of_a_past_report(spark, actions001):
    """The report of a past date does not change when later actions arrive."""
    then = jobs.app_report_job(actions001.until("2024-01-19"), "2024-01-20")
    now = jobs.app_report_job(actions001, "2024-01-20")
    assert now.message == then.message
    for name in ("daily", "weekly", "weekly_totals", "top_posts"):
        assert _rows(now.tables[name]) == _rows(then.tables[name])
