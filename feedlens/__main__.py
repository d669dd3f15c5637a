"""Run one scheduled job: ``spark-submit -m feedlens <job> [options]`` or
``python -m feedlens <job> [options]``.

Jobs: slices (daily slice table), feed-report, app-report, alert. The clock
is a parameter (--as-of for daily jobs, --now for the alert), so a scheduler
retry or a backfill of a past date gives the same output.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from feedlens.plans import jobs
from feedlens.session import ensure_checkpoint_dir
from feedlens.sources.actions import load_fixture, read_actions


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="feedlens")
    p.add_argument("job", choices=["slices", "activity", "sketches", "bitmaps", "feed-report", "app-report", "alert", "alert-stream",
                                   "ab-test", "aa-test"])
    p.add_argument("--as-of", default=dt.date.today().isoformat(), help="job date; 'yesterday' is the day before")
    p.add_argument("--time-zone", default="UTC", help="session time zone: the borders of days")
    p.add_argument("--now", default=None, help="alert clock, e.g. '2024-01-30 12:00:00'")
    src = p.add_mutually_exclusive_group()
    src.add_argument("--db", help="catalog database holding feed_actions and message_actions")
    src.add_argument("--fixture", help="folder with events.parquet (test data)")
    p.add_argument("--feed", default="feed_actions", help="feed table name or path")
    p.add_argument("--message", default="message_actions", help="message table name or path")
    p.add_argument("--format", default=None, help="read --feed/--message as paths in this format")
    p.add_argument("--out", required=True, help="output folder (shared storage)")
    p.add_argument("--table", default=None, help="slices: catalog table instead of a folder")
    p.add_argument("--append", action="store_true", help="slices: append instead of replacing the day")
    p.add_argument("--tables", help="app-report: compact tables kept by the activity job")
    p.add_argument("--start", help="activity, sketches, bitmaps: first day of a backfill; ab-test / aa-test: first day")
    p.add_argument("--end", help="ab-test / aa-test: last day of the experiment")
    p.add_argument("--groups", default="1,2", help="ab-test: control,treatment; aa-test: the two groups")
    p.add_argument("--reps", type=int, default=None, help="bootstrap (ab-test) or A/A repetitions")
    p.add_argument("--sample", type=int, default=500, help="aa-test: users drawn per group")
    p.add_argument("--share", type=float, default=None, help="aa-test: share of each group instead of --sample")
    p.add_argument("--method", default="auto", choices=["auto", "exact", "asymptotic"],
                   help="ab-test: law of the Mann-Whitney p-value")
    p.add_argument("--until", help="app-report: last day of actions to use (default: yesterday)")
    p.add_argument("--buckets", type=int, default=200, help="ab-test: buckets for bucket CTR")
    p.add_argument("--events", help="alert-stream: folder where event Parquet files land")
    p.add_argument("--stream-checkpoint", help="alert-stream: checkpoint folder (shared storage)")
    p.add_argument("--once", action="store_true", help="alert-stream: process what is there and stop")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"feedlens-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    ensure_checkpoint_dir(spark)
    if args.job == "alert-stream":
        from feedlens.streaming.alert_stream import run_alert_stream
        if not (args.events and args.stream_checkpoint):
            raise SystemExit("alert-stream needs --events and --stream-checkpoint")
        query = run_alert_stream(spark, args.events, args.out, args.stream_checkpoint,
                                 available_now=args.once)
        query.awaitTermination()
        print(json.dumps({"job": args.job, "out": args.out}))
        return 0
    if args.fixture:
        actions = load_fixture(spark, args.fixture)
    else:
        actions = read_actions(spark, args.feed, args.message, db=args.db, fmt=args.format)
    result: dict = {"job": args.job}
    if args.job == "slices":
        df = jobs.daily_slices_job(actions, args.as_of, args.out, table=args.table,
                                   mode="append" if args.append else "overwrite_days")
        result["rows"] = df.count()
    elif args.job in ("activity", "sketches", "bitmaps"):
        job = {"activity": jobs.daily_activity_job, "sketches": jobs.daily_sketch_job, "bitmaps": jobs.daily_bitmap_job}[args.job]
        if args.start:
            result.update(job(actions, args.out, start=args.start, end=args.end or args.start))
        else:
            result.update(job(actions, args.out, as_of=args.as_of))
    elif args.job == "feed-report":
        result["message"] = jobs.feed_report_job(actions, args.as_of, args.out).message
    elif args.job == "app-report":
        result["message"] = jobs.app_report_job(actions, args.as_of, args.out, tables_dir=args.tables,
                                                until=args.until).message
    elif args.job in ("ab-test", "aa-test"):
        if not (args.start and args.end):
            raise SystemExit(f"{args.job} needs --start and --end")
        g = tuple(int(x) for x in args.groups.split(","))
        if args.job == "ab-test":
            rows = jobs.ab_test_job(actions, args.start, args.end, g[0], g[1], reps=args.reps or 3000,
                                    buckets=args.buckets, method=args.method, out_dir=args.out).collect()
            result["tests"] = [r.asDict() for r in rows]
        else:
            out = jobs.aa_test_job(actions, args.start, args.end, g, reps=args.reps or 10000,
                                   sample=args.sample, share=args.share, out_dir=args.out)
            result["message"] = out.message
    else:
        now = args.now or dt.datetime.now().isoformat(sep=" ", timespec="seconds")
        result["alerts"] = [r.message for r in jobs.alert_job(actions, now, args.out).collect()]
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
