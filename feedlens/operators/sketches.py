"""Mergeable distinct counts: one HyperLogLog sketch per day, service and status, kept as a table.

A sketch has a fixed size (4 kB at the default precision) whatever the number of
users, and sketches of any days merge to the sketch of their union. The daily
job makes those of its day from that day's actions; the report of a week, a
month or any range of days then merges a few of them and reads no action again.

``stated_bound`` is the sketch's own error: about 1.04 / sqrt(2^lg_k) standard
errors; three of them cover practically every estimate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of, monday
from feedlens.operators import cohorts
from feedlens.operators.timeframe import date_literal, where_days
from feedlens.sources.actions import Actions

#: Base-2 logarithm of a sketch's registers.
LG_K = 12
SERVICES = ("feed", "messenger")


def stated_bound(lg_k: int = LG_K, errors: float = 3.0) -> float:
    """Largest relative error of an estimate, in ``errors`` standard errors of a merged sketch."""
    return errors * 1.04 / math.sqrt(1 << lg_k)


def daily_sketches(actions: Actions, start=None, end=None, lg_k: int = LG_K) -> DataFrame:
    """(day, service, users): a sketch of each day's users of each service.

    Tasks sketch their own rows first, so the shuffle carries a sketch per task,
    day and service. Rows without a user are left out.
    """
    rows = [where_days(df, start, end).select(day_of("time").alias("day"), F.lit(service).alias("service"), "user_id")
            for service, df in zip(SERVICES, (actions.feed, actions.message))]
    return (rows[0].unionByName(rows[1]).where("user_id is not null")
            .groupBy("day", "service").agg(F.hll_sketch_agg("user_id", lg_k).alias("users")))


def merged_users(sketches: DataFrame, *keys: Column | str) -> DataFrame:
    """Estimated users of each group of ``keys`` (or of all rows), from their sketches' union: ..., users_estimated."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users", F.lit(True))).alias("users_estimated"))


def users_by_week(sketches: DataFrame) -> DataFrame:
    """(week, users_estimated) over both services, from the daily sketches."""
    return merged_users(sketches, monday("day").alias("week"))


def users_between(sketches: DataFrame, start, end) -> DataFrame:
    """One row: estimated users of any of the days [start, end], whatever the service."""
    return merged_users(sketches.where(F.col("day").between(date_literal(start), date_literal(end))))


def _checked(exact: DataFrame, estimated: DataFrame, keys: list[str], lg_k: int) -> DataFrame:
    both = exact.join(estimated, keys, "left")
    off = F.abs(F.col("users_estimated") - F.col("users"))
    bound = F.lit(stated_bound(lg_k)) * F.col("users")
    return both.select(*keys, "users", F.coalesce(off <= F.greatest(bound, F.lit(0.5)), F.lit(False)).alias("within_bound"))


def weekly_users_check(actions: Actions, lg_k: int = LG_K) -> DataFrame:
    """(week, users, within_bound): exact users of each week, and whether the merged daily sketches tell them
    within their stated bound."""
    seen = actions.feed.select("user_id", "time").unionByName(actions.message.select("user_id", "time"))
    exact = seen.groupBy(monday(day_of("time")).alias("week")).agg(F.count_distinct("user_id").alias("users"))
    return _checked(exact, users_by_week(daily_sketches(actions, lg_k=lg_k)), ["week"], lg_k)


def audience_sketches(actions: Actions, as_of, feed_only: bool = False, lg_k: int = LG_K) -> DataFrame:
    """(this_week, previous_week, status, users): the sketch behind each number of ``weekly_audience``,
    so that new, retained or gone users of several weeks can be counted together."""
    return (cohorts.weekly_status(actions, as_of, feed_only).where("user_id is not null")
            .groupBy("this_week", "previous_week", "status").agg(F.hll_sketch_agg("user_id", lg_k).alias("users")))


def audience_check(actions: Actions, as_of, feed_only: bool = False, lg_k: int = LG_K) -> DataFrame:
    """(this_week, previous_week, status, users, within_bound): the exact number of ``weekly_audience`` (gone users
    counted positive), and whether the sketch tells it within its stated bound."""
    keys = ["this_week", "previous_week", "status"]
    exact = cohorts.weekly_status(actions, as_of, feed_only).groupBy(*keys).agg(F.count("user_id").alias("users"))
    return _checked(exact, merged_users(audience_sketches(actions, as_of, feed_only, lg_k), *keys), keys, lg_k)


def status_between(sketches: DataFrame, status: str, start, end) -> DataFrame:
    """One row: estimated distinct users with ``status`` in any week of [start, end], from ``audience_sketches``."""
    return merged_users(sketches.where((F.col("status") == status) & F.col("this_week").between(
        date_literal(start), date_literal(end))))
