import datetime as dt

from pyspark.sql import functions as F

from feedlens.operators import metrics, slices
from feedlens.sources.actions import Actions

D = dt.date(2024, 1, 10)


def _actions(spark, feed_rows, msg_rows):
    feed = spark.createDataFrame(
        [(u, p, act, dt.datetime.combine(d, dt.time(9)), 0, "iOS", 20, 0, "ads") for u, p, act, d in feed_rows],
        "user_id bigint, post_id bigint, action string, time timestamp_ntz, exp_group int, os string, "
        "age int, gender int, source string")
    msg = spark.createDataFrame(
        [(u, r, dt.datetime.combine(d, dt.time(9)), "iOS", 20, 0, "ads") for u, r, d in msg_rows],
        "user_id bigint, reciever_id bigint, time timestamp_ntz, os string, age int, gender int, source string")
    return Actions(feed=feed, message=msg)


def test_daily_actions_fan_out(spark):
    d = lambda k: D + dt.timedelta(days=k)
    # user 1: 2 feed days and 3 message days
    a = _actions(spark, [(1, 7, "view", d(0)), (1, 7, "like", d(0)), (1, 8, "view", d(1))],
                 [(1, 2, d(0)), (1, 3, d(2)), (1, 3, d(2)), (1, 4, d(3))])
    compat = {r.day: (r.likes, r.views, r.messages_sent) for r in metrics.daily_actions_compat(a).collect()}
    # the user-only join gives 2 x 3 = 6 rows: each feed day is repeated 3 times and carries all 4 messages
    assert compat == {d(0): (3, 3, 4), d(1): (0, 3, 4)}
    fixed = {r.day: (r.likes, r.views, r.messages_sent) for r in metrics.daily_actions(a).collect()}
    assert fixed == {d(0): (1, 1, 1), d(1): (0, 1, 0), d(2): (0, 0, 2), d(3): (0, 0, 1)}


def test_new_users_sum_to_distinct_users(spark, actions001):
    total = metrics.new_users(actions001).agg(F.sum("new_users")).first()[0]
    distinct = (actions001.feed.select("user_id").union(actions001.message.select("user_id"))
                .distinct().count())
    assert total == distinct


def test_dau_days_need_both_only_groups(spark):
    a = _actions(spark, [(1, 1, "view", D), (2, 1, "view", D), (3, 1, "view", D + dt.timedelta(days=1))],
                 [(2, 5, D), (4, 5, D), (3, 5, D + dt.timedelta(days=1))])
    rows = {r.day: (r.dau_message, r.dau_feed, r.dau_all_services) for r in metrics.dau(a).collect()}
    assert rows == {D: (1, 1, 3)}          # the second day has no feed-only user: no row
    compat = {r.day: r.dau_all_services for r in metrics.dau(a, compat=True).collect()}
    assert compat == {D: 2}


def test_top_posts_order_and_tie_break(spark):
    a = _actions(spark, [(1, 10, "view", D), (2, 10, "view", D), (1, 11, "view", D), (2, 11, "view", D),
                         (3, 12, "view", D), (3, 12, "like", D)], [])
    rows = metrics.top_posts(a.feed, 2).collect()
    assert [(r.post_id, r.views, r.uniq_users) for r in rows] == [(10, 2, 2), (11, 2, 2)]


def test_report_texts(spark):
    a = _actions(spark, [(1, 10, "view", D), (2, 10, "view", D), (1, 11, "like", D)], [])
    r = metrics.report_day(a.feed, D + dt.timedelta(days=1)).first()
    assert r.message == "Feed report for 10.01.2024:\nDAU: 2\nViews: 2\nLikes: 1\nCTR: 50.00%"


def test_slice_totals_agree_across_dimensions(spark, actions001):
    s = slices.daily_slices(actions001.feed, actions001.message)
    totals = (s.groupBy("event_date", "dimension")
              .agg(*[F.sum(m).alias(m) for m in slices.SLICE_METRICS])
              .groupBy("event_date").agg(*[F.countDistinct(m).alias(m) for m in slices.SLICE_METRICS]))
    for row in totals.collect():
        assert all(row[m] == 1 for m in slices.SLICE_METRICS)
    assert s.schema["views"].dataType.simpleString() == "bigint"


def test_etl_one_day_drops_receivers_who_did_not_send(spark):
    a = _actions(spark, [(1, 1, "view", D)], [(1, 2, D), (3, 1, D), (2, 5, D - dt.timedelta(days=1))])
    m = {r.user_id: r for r in slices.etl_messages(a.message, D, D).collect()}
    assert set(m) == {1}                      # user 2 received on D but sent nothing that day
    assert (m[1].messages_sent, m[1].users_sent, m[1].messages_received, m[1].users_received) == (1, 1, 1, 1)


def test_unknown_attributes_match_in_etl_total(spark):
    import datetime as dt

    from feedlens.operators import slices
    day = dt.date(2024, 1, 1)
    feed = spark.createDataFrame([(day, 1, None, 30, None, 5, 1)],
                                 "event_date date, user_id bigint, os string, age int, gender int, views bigint, likes bigint")
    message = spark.createDataFrame([(day, 1, None, 30, None, 2, 3, 1, 1), (day, 2, "iOS", 20, 0, 1, 1, 1, 1)],
                                    "event_date date, user_id bigint, os string, age int, gender int, messages_received bigint, "
                                    "messages_sent bigint, users_received bigint, users_sent bigint")
    got = {r.user_id: tuple(r) for r in slices.etl_total(feed, message).collect()}
    assert got == {1: (day, 1, None, 30, None, 5, 1, 2, 3, 1, 1), 2: (day, 2, "iOS", 20, 0, None, None, 1, 1, 1, 1)}
