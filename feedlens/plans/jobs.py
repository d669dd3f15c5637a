"""The scheduled jobs, as plain functions of a clock parameter.

Scheduling, retries and message delivery belong to the caller (any
scheduler); each job here reads the action tables, computes its tables and
writes them under an output folder. Writes are idempotent: rerunning a job
for the same date replaces its own output, so scheduler retries are safe.

* ``daily_slices_job``   the daily slice table, one day per run (partition overwrite)
* ``feed_report_job``    yesterday's feed text and the 7-day series
* ``app_report_job``     yesterday's app text, daily series, weekly audience, top posts CSV
* ``alert_job``          15-minute bands and alert rows for ``now``
* ``daily_sketch_job``   sketches of the day's users, which merge to any range of days
* ``daily_bitmap_job``   bitmaps of the users' active days, for audience and retention
* ``daily_activity_job`` the compact daily tables the app report can read
                         instead of the whole raw history
* ``ab_test_job``        every A/B test of a pair of groups over a date range
* ``aa_test_job``        the A/A simulation summary and p-value histogram
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of
from feedlens.operators import alerts, bitmaps, cohorts, metrics, sketches, slices
from feedlens.operators import experiments as ex
from feedlens.operators.timeframe import as_date, as_datetime, date_literal, where_days, yesterday
from feedlens.session import ensure_checkpoint_dir
from feedlens.sources import sinks
from feedlens.sources.actions import Actions
from feedlens.sources.versioned import DayTable, is_versioned


@dataclass
class ReportOutput:
    message: str | None
    tables: dict[str, DataFrame]


def daily_slices_job(actions: Actions, as_of, target: str, mode: str = "overwrite_days",
                     table: str | None = None) -> DataFrame:
    """Slices of yesterday (relative to as_of) written to ``target`` (a
    Parquet folder) or to the catalog ``table``. Returns the written rows.
    ``mode='versioned'`` replaces the day in a ``versioned.DayTable`` at ``target``."""
    day = yesterday(as_of)
    df = slices.daily_slices(actions.feed, actions.message, day, day)
    if mode == "versioned":
        sinks.replace_slice_days(df, target, day, day)
    elif table:
        sinks.insert_slices(df, table, mode=mode, location=target or None)
    else:
        sinks.write_slices(df, target, mode=mode)
    return df


def _first_message(df: DataFrame) -> str | None:
    row = df.select("message").first()
    return row.message if row else None


def feed_report_job(actions: Actions, as_of, out_dir: str | None = None) -> ReportOutput:
    """Yesterday's text (one row) and the last 7 days as a long series."""
    day = metrics.report_day(actions.feed, as_of)
    ensure_checkpoint_dir(actions.feed.sparkSession)
    week = metrics.report_week(actions.feed, as_of).checkpoint(eager=True)
    series = metrics.long_series(week, metrics.FEED_DAILY_METRICS)
    if out_dir:
        stamp = as_date(as_of).isoformat()
        series.write.mode("overwrite").parquet(f"{out_dir}/feed_report/as_of={stamp}/series")
    return ReportOutput(message=_first_message(day), tables={"day": day, "week": week, "series": series})


ACTIVITY, POST_DAYS = "activity", "post_days"
USER_FIRST_SEEN, POST_FIRST_SEEN = "user_first_seen", "post_first_seen"
USER_SKETCHES, USER_BITMAPS = "user_sketches", "user_bitmaps"
#: Columns of the tables that reports read.
COLUMNS = {ACTIVITY: "user_id bigint, likes bigint, views bigint, messages_sent bigint, f int, day date",
           USER_FIRST_SEEN: "user_id bigint, day date", POST_FIRST_SEEN: "post_id bigint, day date"}


def _write_days(df: DataFrame, path: str, start, end=None, versioned: bool = False) -> None:
    """Replace the days [start, end] (or from ``start`` on) of a table
    partitioned by day with ``df``'s rows; a day without rows goes. A versioned
    table (``sources.versioned``) changes in one step; it stays one."""
    if versioned or is_versioned(df.sparkSession, path):
        DayTable(df.sparkSession, path).replace_days(df, start, end)
        return
    # REBALANCE groups rows by day for the partitioned write and lets AQE
    # split a large day over several tasks (and merge small ones).
    (df.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))
    # one row per day
    written = {r["day"] for r in df.select("day").distinct().collect()}
    sinks.drop_days(df.sparkSession, path, lambda d: as_date(start) <= d and (end is None or d <= as_date(end))
                    and d not in written)


def _read_days(spark, path: str, schema) -> DataFrame:
    """A table of ``_write_days``; empty if nothing has been written. Any other
    failure to read it is the caller's error."""
    if is_versioned(spark, path):
        return DayTable(spark, path).read(schema)
    if not sinks.has_days(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _rewrite_first_seen(spark, tables_dir: str, source: str, name: str, key: str, start, versioned: bool = False) -> None:
    """First-seen rows from ``start`` on: the earliest day per key in the
    source's days from ``start`` on, without the keys first seen before."""
    days = f"{key} bigint, day date"
    later = _read_days(spark, f"{tables_dir}/{source}", days).where(F.col("day") >= date_literal(start))
    earlier = _read_days(spark, f"{tables_dir}/{name}", days).where(F.col("day") < date_literal(start))
    # The rows replace part of the table they are compared with: the new ones
    # are on shared storage before any of it is written.
    new = metrics.first_seen(later.select(key, "day"), key, earlier).checkpoint(eager=True)
    _write_days(new, f"{tables_dir}/{name}", start, versioned=versioned)


def daily_activity_job(actions: Actions, tables_dir: str, as_of=None, start=None, end=None,
                       versioned: bool = False) -> dict:
    """Keep four compact tables under ``tables_dir``, partitioned by day:
    ``activity`` (one row per day and user: likes, views, messages, service
    bits), ``post_days`` (one row per day and post), ``user_first_seen`` and
    ``post_first_seen`` (one row per user or post, under its first day).

    A run covers yesterday (from ``as_of``) or the days [start, end]; it reads
    only those days of the action tables. The days' rows are replaced, days
    that have become empty included, and the first-seen rows from ``start`` on
    are computed anew from the compact tables, so retries, backfills and reruns
    of any earlier day give the tables of one run over the whole history. With
    ``versioned`` each table's days change in one step: readers, and a run that
    fails in between, find the days as they were (tables once written so stay so).
    """
    spark = actions.feed.sparkSession
    ensure_checkpoint_dir(spark)
    if start is None:
        start = end = yesterday(as_of)
    end = end or start
    feed = where_days(actions.feed, start, end)
    msg = where_days(actions.message, start, end)
    _write_days(metrics.user_day_activity(Actions(feed=feed, message=msg)).checkpoint(eager=True),
                f"{tables_dir}/{ACTIVITY}", start, end, versioned)
    posts = feed.select("post_id", day_of("time").alias("day")).distinct().checkpoint(eager=True)
    _write_days(posts, f"{tables_dir}/{POST_DAYS}", start, end, versioned)
    _rewrite_first_seen(spark, tables_dir, ACTIVITY, USER_FIRST_SEEN, "user_id", start, versioned)
    _rewrite_first_seen(spark, tables_dir, POST_DAYS, POST_FIRST_SEEN, "post_id", start, versioned)
    return {"start": as_date(start), "end": as_date(end)}


def daily_sketch_job(actions: Actions, tables_dir: str, as_of=None, start=None, end=None,
                     lg_k: int = sketches.LG_K) -> dict:
    """Keep ``user_sketches`` under ``tables_dir``, partitioned by day: a sketch of each
    day's users of each service (``sketches.daily_sketches``). A run covers yesterday (from
    ``as_of``) or the days [start, end], reads only those days and replaces them."""
    ensure_checkpoint_dir(actions.feed.sparkSession)
    if start is None:
        start = end = yesterday(as_of)
    end = end or start
    made = sketches.daily_sketches(actions, start, end, lg_k).checkpoint(eager=True)
    _write_days(made, f"{tables_dir}/{USER_SKETCHES}", start, end)
    return {"start": as_date(start), "end": as_date(end)}


def daily_bitmap_job(actions: Actions, tables_dir: str, as_of=None, start=None, end=None) -> dict:
    """Keep ``user_bitmaps`` under ``tables_dir``: a row per user and block of eight weeks with a bit for each
    active day (``operators.bitmaps``), a versioned table by block. A run covers yesterday (from
    ``as_of``) or the days [start, end]; it reads only those days of the actions and only the
    blocks they lie in, and replaces these in one step."""
    spark = actions.feed.sparkSession
    if start is None:
        start = end = yesterday(as_of)
    end = end or start
    table = DayTable(spark, f"{tables_dir}/{USER_BITMAPS}", "block")
    blocks = spark.range(1).select(bitmaps.block_of(date_literal(start)), bitmaps.block_of(date_literal(end))).first()
    made = bitmaps.updated(table.read(bitmaps.SCHEMA, *blocks), actions, start, end)
    return {"start": as_date(start), "end": as_date(end), "version": table.replace_days(made, *blocks)}


def read_bitmaps(spark, tables_dir: str) -> DataFrame:
    """The bitmaps under ``tables_dir``, for ``bitmaps.weekly_audience`` and the retention reports."""
    return DayTable(spark, f"{tables_dir}/{USER_BITMAPS}", "block").read(bitmaps.SCHEMA)


def read_sketches(spark, tables_dir: str) -> DataFrame:
    """The daily sketches under ``tables_dir``, for ``sketches.users_by_week`` and ``users_between``."""
    return spark.read.schema("service string, users binary, day date").parquet(f"{tables_dir}/{USER_SKETCHES}")


def read_activity_tables(spark, tables_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(DayTable(spark, f"{tables_dir}/{n}").read(COLUMNS[n]) if is_versioned(spark, f"{tables_dir}/{n}")
                 else spark.read.parquet(f"{tables_dir}/{n}") for n in (ACTIVITY, USER_FIRST_SEEN, POST_FIRST_SEEN))


def app_report_job(actions: Actions, as_of, out_dir: str | None = None,
                   tables_dir: str | None = None, until=None) -> ReportOutput:
    """Yesterday's application text, the daily table and its long series, the
    weekly audience by status with its net totals, and the top-10 posts file.
    Actions after ``until`` (by default yesterday) are left out, so a rerun of
    a past date gives the rows it gave then. With ``tables_dir`` (kept by
    ``daily_activity_job``), the daily table and the weekly audience come from
    the compact tables instead of the raw history."""
    spark = actions.feed.sparkSession
    ensure_checkpoint_dir(spark)
    last = as_date(until) if until is not None else yesterday(as_of)
    actions = actions.until(last)
    if tables_dir:
        activity, user_first, post_first = (t.where(F.col("day") <= date_literal(last))
                                            for t in read_activity_tables(spark, tables_dir))
        daily = metrics.product_daily_from_tables(activity, user_first, post_first)
        audience = cohorts.weekly_audience_from_activity(activity, as_of)
    else:
        daily = metrics.product_daily(actions)
        audience = cohorts.weekly_audience(actions, as_of)
    audience = audience.checkpoint(eager=True)  # a few rows per week
    weekly, totals = cohorts.weekly_audience_series(audience), cohorts.weekly_audience_totals(audience)
    # One row per day: computed once, checkpointed to the session's
    # checkpoint folder, then read by the text and the series.
    daily = daily.checkpoint(eager=True)
    day = metrics.product_report_day(actions, as_of, daily=daily)
    series = metrics.long_series(daily, metrics.PRODUCT_METRICS)
    top = metrics.top_posts(actions.feed, 10)
    if out_dir:
        base = f"{out_dir}/app_report/as_of={as_date(as_of).isoformat()}"
        series.write.mode("overwrite").parquet(f"{base}/series")
        weekly.write.mode("overwrite").parquet(f"{base}/weekly_audience")
        totals.write.mode("overwrite").parquet(f"{base}/weekly_totals")
        sinks.write_top_posts_csv(top, f"{base}/top_posts")
    return ReportOutput(message=_first_message(day),
                        tables={"daily": daily, "day": day, "series": series, "weekly": weekly,
                                "weekly_totals": totals, "top_posts": top})


def alert_job(actions: Actions, now, out_dir: str | None = None) -> DataFrame:
    """Band check for ``now``; returns the rows of metrics that alert."""
    bands = alerts.alert_bands(alerts.alert_series(actions, now))
    check = alerts.alert_check(bands)
    if out_dir:
        stamp = as_datetime(now).strftime("%Y-%m-%dT%H%M")
        check.write.mode("overwrite").parquet(f"{out_dir}/alerts/now={stamp}")
    return check.where("is_alert")


def ab_test_job(actions: Actions, start, end, control: int, treatment: int,
                reps: int = ex.BOOTSTRAP_REPS, buckets: int = ex.BUCKETS,
                smoothing: float = ex.SMOOTHING_WEIGHT, alpha: float = ex.ALPHA,
                method: str = "auto", out_dir: str | None = None) -> DataFrame:
    """All tests of the study for one pair over [start, end]
    (``experiments.ab_tests``); ``method`` is the Mann-Whitney law."""
    pair = (int(control), int(treatment))
    ensure_checkpoint_dir(actions.feed.sparkSession)
    out = ex.ab_tests(ex.user_ctr(actions.feed, start, end, pair), [pair], pair, reps, buckets, smoothing, alpha, method)
    if out_dir:
        out.write.mode("overwrite").parquet(
            f"{out_dir}/ab_test/{as_date(start).isoformat()}_{as_date(end).isoformat()}_{pair[0]}_{pair[1]}")
    return out


def aa_test_job(actions: Actions, start, end, groups=(2, 3), reps: int = ex.AA_REPS,
                sample: int = ex.AA_SAMPLE, alpha: float = ex.ALPHA,
                out_dir: str | None = None, share: float | None = None) -> ReportOutput:
    """The A/A check: ``reps`` Welch tests on samples of ``sample`` users per
    group (or the ``share`` of each); the share of p <= alpha and the 10-bin
    p-value histogram."""
    users = ex.user_ctr(actions.feed, start, end, groups)
    ensure_checkpoint_dir(actions.feed.sparkSession)
    stats = ex.aa_draw_stats(users, tuple(groups), reps, sample, share)
    pvalues = ex.with_t_p_value(stats, alpha).select("sim", "t", "df", "p_value")
    pvalues = pvalues.checkpoint(eager=True)     # read by the summary and the histogram
    summary = ex.aa_summary(pvalues, alpha)
    hist = ex.histogram(pvalues, "p_value", bins=10)
    if out_dir:
        base = f"{out_dir}/aa_test/{as_date(start).isoformat()}_{as_date(end).isoformat()}"
        summary.write.mode("overwrite").parquet(f"{base}/summary")
        hist.write.mode("overwrite").parquet(f"{base}/histogram")
    row = summary.first()
    text = (f"A/A: {row.n_significant} of {row.n_sims} tests with p <= {alpha}"
            f" (share {row.fp_share:.4f})") if row and row.n_sims else None
    return ReportOutput(message=text, tables={"p_values": pvalues, "summary": summary, "histogram": hist})
