"""Versioned day tables, and tables laid out by user."""

import os

import pytest
from pyspark.sql import functions as F

from feedlens.operators import experiments as ex
from feedlens.operators import metrics, slices
from feedlens.plans import jobs
from feedlens.plans import params as P
from feedlens.sources import layout, sinks, versioned
from feedlens.sources.actions import read_actions

SCHEMA = "k bigint, day date"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple(map(str, r)))


def _days(spark, *pairs):
    return spark.createDataFrame([(k, d) for k, d in pairs], "k bigint, d string").select("k", F.to_date("d").alias("day"))


def test_days_are_replaced_in_one_step(spark, tmp_dir):
    table = versioned.DayTable(spark, os.path.join(tmp_dir, "t"))
    assert table.read(SCHEMA).count() == 0 and not versioned.is_versioned(spark, table.path)
    assert table.replace_days(_days(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")), "2024-01-01", "2024-01-03") == 1
    assert table.replace_days(_days(spark, (20, "2024-01-02")), "2024-01-02", "2024-01-03") == 2   # the 3rd has become empty
    assert [r[0] for r in _rows(table.read(SCHEMA))] == [1, 20]
    assert sorted(r[0] for r in _rows(table.read(SCHEMA, version=1))) == [1, 2, 3]
    assert [r[0] for r in _rows(table.read(SCHEMA, "2024-01-02"))] == [20] and table.read(SCHEMA, "2024-02-01").count() == 0
    plan = table.read(SCHEMA, "2024-01-02", "2024-01-02")
    assert len(plan.inputFiles()) >= 1 and all("day=2024-01-02" in f for f in plan.inputFiles())
    with pytest.raises(ValueError):
        table.replace_days(_days(spark, (9, "2023-12-31")), "2024-01-01")


def test_a_write_that_fails_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    """A crash after the data and before the manifest: readers find the days as they were."""
    table = versioned.DayTable(spark, os.path.join(tmp_dir, "t"))
    table.replace_days(_days(spark, (1, "2024-01-01"), (2, "2024-01-02")), "2024-01-01", "2024-01-02")
    reader = table.read(SCHEMA)
    monkeypatch.setattr(versioned.DayTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        table.replace_days(_days(spark, (10, "2024-01-01")), "2024-01-01", "2024-01-02")
    monkeypatch.undo()
    assert _rows(table.read(SCHEMA)) == _rows(reader) and reader.count() == 2
    gone = table.vacuum()
    assert len(gone) == 1 and _rows(table.read(SCHEMA)) == _rows(reader)
    # a reader that began before a replacement still reads its version
    table.replace_days(_days(spark, (10, "2024-01-01")), "2024-01-01", "2024-01-02")
    assert reader.count() == 2 and [r[0] for r in _rows(table.read(SCHEMA))] == [10]
    for d in range(3):
        table.replace_days(_days(spark, (d, "2024-01-01")), "2024-01-01", "2024-01-01")
    assert len(table.vacuum(keep=1)) >= 3 and table.versions()[-1:] == table.versions()
    assert [r[0] for r in _rows(table.read(SCHEMA))] == [2]


def test_two_writers(spark, tmp_dir, monkeypatch):
    """A writer that finds its version taken goes on top of it if the days differ, and fails if they do not."""
    path = os.path.join(tmp_dir, "t")
    first, second = versioned.DayTable(spark, path), versioned.DayTable(spark, path)
    first.replace_days(_days(spark, (1, "2024-01-01"), (2, "2024-01-02")), "2024-01-01", "2024-01-02")
    publish = versioned.DayTable._publish

    def race(day, row):
        """Let another writer publish between this one's data and its manifest."""
        def raced(self, version, days):
            monkeypatch.setattr(versioned.DayTable, "_publish", publish)
            second.replace_days(_days(spark, (row, day)), day, day)
            return publish(self, version, days)
        monkeypatch.setattr(versioned.DayTable, "_publish", raced)

    race("2024-01-02", 22)
    assert first.replace_days(_days(spark, (11, "2024-01-01")), "2024-01-01", "2024-01-01") == 3
    assert sorted(r[0] for r in _rows(first.read(SCHEMA))) == [11, 22]
    race("2024-01-01", 111)
    with pytest.raises(versioned.Conflict):
        first.replace_days(_days(spark, (99, "2024-01-01")), "2024-01-01", "2024-01-01")
    assert sorted(r[0] for r in _rows(first.read(SCHEMA))) == [22, 111]


def test_versioned_activity_tables_equal_plain_ones(spark, actions001, tmp_dir):
    plain, own = os.path.join(tmp_dir, "plain"), os.path.join(tmp_dir, "own")
    for d in ("2024-01-01", "2024-01-02", "2024-01-01"):
        jobs.daily_activity_job(actions001, plain, start=d)
        jobs.daily_activity_job(actions001, own, start=d, versioned=True)
    for a, b in zip(jobs.read_activity_tables(spark, plain), jobs.read_activity_tables(spark, own)):
        assert _rows(a.select(sorted(a.columns))) == _rows(b.select(sorted(b.columns))) and a.count() > 0
    daily = metrics.product_daily_from_tables(*jobs.read_activity_tables(spark, own))
    assert daily.count() == 2


def test_versioned_slices(spark, actions001, tmp_dir):
    for as_of in ("2024-01-16", "2024-01-17", "2024-01-16"):
        rows = jobs.daily_slices_job(actions001, as_of, tmp_dir, mode="versioned")
    assert rows.count() > 0
    want = slices.daily_slices(actions001.feed, actions001.message, "2024-01-15", "2024-01-16")
    got = sinks.read_slices(spark, tmp_dir)
    assert _rows(got.select(*want.columns)) == _rows(want)
    assert sinks.read_slices(spark, tmp_dir, version=1).select("event_date").distinct().count() == 1


@pytest.fixture()
def by_user(spark, actions001, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS by_user_test")
    before = spark.conf.get(layout.CO_PARTITION)
    layout.save_actions_by_user(actions001, "by_user_test", 8, path=tmp_dir)
    layout.keep_user_partitioning(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield read_actions(spark, db="by_user_test")
    spark.conf.set(layout.CO_PARTITION, before)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP DATABASE by_user_test CASCADE")


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_tables_by_user_join_and_group_without_exchange(spark, actions001, by_user):
    assert _rows(by_user.feed) == _rows(actions001.feed)
    joined = by_user.feed.join(by_user.message.select("user_id", "reciever_id", F.col("time").alias("sent")), "user_id")
    assert _exchanges(joined) == 0 and "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    plain = actions001.feed.join(actions001.message.select("user_id", "reciever_id", F.col("time").alias("sent")), "user_id")
    assert joined.count() == plain.count()
    # per-user table, and a day's slices of the feed
    users = ex.user_ctr(by_user.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS)
    assert _exchanges(users) == 0
    assert _rows(users) == _rows(ex.user_ctr(actions001.feed, P.EXP_START, P.EXP_END, P.AB_GROUPS))
    feed = slices.etl_feed(by_user.feed)
    assert _exchanges(feed) == 0 and _rows(feed) == _rows(slices.etl_feed(actions001.feed))
    # both services of a user and day: the join on user, day and attributes keeps the buckets
    sent = by_user.message.groupBy("user_id", F.to_date("time").alias("event_date")).agg(F.count("*").alias("n"))
    assert _exchanges(feed.join(sent, ["user_id", "event_date"], "full")) == 0
    # what the receivers got is grouped by another user and has to move
    assert _exchanges(slices.etl_messages(by_user.message)) < _exchanges(slices.etl_messages(actions001.message))


def test_days_above_the_buckets_prune(spark, actions001, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS by_day_test")
    try:
        layout.save_actions_by_user(actions001, "by_day_test", 4, by_day=True, path=tmp_dir)
        feed = read_actions(spark, db="by_day_test").feed
        users = ex.user_ctr(feed, P.EXP_START, P.EXP_START, P.AB_GROUPS)
        plan = users._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(event_date" in plan and "Exchange" not in plan
        assert _rows(users) == _rows(ex.user_ctr(actions001.feed, P.EXP_START, P.EXP_START, P.AB_GROUPS))
    finally:
        spark.sql("DROP DATABASE by_day_test CASCADE")
