"""Mergeable distinct counts: bounds, merging of any days, and the daily job."""

import os

import pytest
from pyspark.sql import functions as F

from feedlens.operators import cohorts, sketches
from feedlens.plans import jobs
from feedlens.plans import params as P
from feedlens.sources.actions import FEED_SCHEMA, MESSAGE_SCHEMA, Actions


def _many(spark, days=6, users=30_000):
    """Users of day d are d * 5000 .. d * 5000 + users."""
    rows = (spark.range(days * users).select((F.expr(f"id div {users}")).alias("d"), (F.col("id") % users).alias("u"))
            .select((F.col("u") + F.col("d") * 5000).alias("user_id"), F.lit(1).cast("long").alias("post_id"), F.lit("view").alias("action"),
                    F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(d as int))").alias("time"),
                    F.lit(1).alias("exp_group"), F.lit("iOS").alias("os"), F.lit(20).alias("age"), F.lit(0).alias("gender"),
                    F.lit("ads").alias("source")))
    return Actions(rows.select([f.name for f in FEED_SCHEMA]), spark.createDataFrame([], MESSAGE_SCHEMA))


@pytest.mark.parametrize("lg_k", [10, 12, 14])
def test_estimates_keep_their_bound(spark, lg_k):
    daily = sketches.daily_sketches(_many(spark), lg_k=lg_k).cache()
    bound = sketches.stated_bound(lg_k)
    for start, end, users in (("2024-01-01", "2024-01-01", 30_000), ("2024-01-02", "2024-01-04", 40_000),
                              ("2024-01-01", "2024-01-06", 55_000)):
        got = sketches.users_between(daily, start, end).first()[0]
        assert got == pytest.approx(users, rel=bound)
    assert daily.select(F.max(F.length("users"))).first()[0] <= (1 << lg_k) + 64
    daily.unpersist()


def test_checks_tell_a_wrong_estimate(spark):
    actions = _many(spark, days=2)
    assert [tuple(r)[1:] for r in sketches.weekly_users_check(actions).collect()] == [(35_000, True)]
    # 1049 and 1051 of 1000 lie inside the bound of 1024 registers, not inside that of 4096
    exact = spark.createDataFrame([(1, 1000), (2, 1000), (3, 3)], "week int, users bigint")
    told = spark.createDataFrame([(1, 1049), (2, 1051)], "week int, users_estimated bigint")
    assert {r.week: r.within_bound for r in sketches._checked(exact, told, ["week"], 10).collect()} == {1: True, 2: True, 3: False}
    assert {r.week: r.within_bound for r in sketches._checked(exact, told, ["week"], 12).collect()} == {1: False, 2: False, 3: False}


def test_daily_job_keeps_a_table_that_any_range_reads(spark, actions001, tmp_dir):
    for d in range(10, 15):
        jobs.daily_sketch_job(actions001, tmp_dir, start=f"2024-01-{d}")
    jobs.daily_sketch_job(actions001, tmp_dir, start="2024-01-12")    # a rerun replaces its day
    table = jobs.read_sketches(spark, tmp_dir)
    assert sorted(os.listdir(os.path.join(tmp_dir, jobs.USER_SKETCHES)))[-1] == "day=2024-01-14"
    assert table.groupBy("day", "service").count().where("count > 1").count() == 0
    exact = (actions001.feed.select("user_id", "time").unionByName(actions001.message.select("user_id", "time"))
             .where("time >= '2024-01-11' and time < '2024-01-14'").agg(F.count_distinct("user_id")).first()[0])
    got = sketches.users_between(table, "2024-01-11", "2024-01-13").first()[0]
    assert got == pytest.approx(exact, rel=sketches.stated_bound())


def test_status_sketches_merge_over_weeks(spark, actions001):
    table = sketches.audience_sketches(actions001, P.AS_OF)
    got = sketches.status_between(table, "retained", "2024-01-08", "2024-01-22").first()[0]
    exact = (cohorts.weekly_status(actions001, P.AS_OF).where("status = 'retained' and this_week between '2024-01-08' and '2024-01-22'")
             .select("user_id").distinct().count())
    assert got == pytest.approx(exact, rel=sketches.stated_bound()) and exact > 0
