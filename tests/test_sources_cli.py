import json
import os

import pytest
from pyspark.sql import functions as F

from feedlens.sources.actions import FEED_SCHEMA, check_schema, read_actions


def test_read_actions_from_paths_with_schema_check(spark, actions001, tmp_dir):
    fpath, mpath = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "msg")
    actions001.feed.write.parquet(fpath)
    actions001.message.write.parquet(mpath)
    a = read_actions(spark, fpath, mpath, fmt="parquet")
    assert [(f.name, f.dataType) for f in a.feed.schema] == [(f.name, f.dataType) for f in FEED_SCHEMA]
    assert a.feed.count() == actions001.feed.count()


def test_check_schema_casts_and_rejects(spark, actions001):
    wide = actions001.feed.withColumn("exp_group", F.col("exp_group").cast("bigint"))
    got = check_schema(wide, FEED_SCHEMA).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in FEED_SCHEMA]
    with pytest.raises(ValueError, match="missing columns"):
        check_schema(actions001.feed.drop("post_id"), FEED_SCHEMA)
    with pytest.raises(TypeError):
        check_schema(actions001.feed.withColumn("user_id", F.array(F.lit(1))), FEED_SCHEMA)


def test_cli_slices_and_alert(spark, tmp_dir, capsys):
    from feedlens.__main__ import main
    out = os.path.join(tmp_dir, "cli")
    assert main(["slices", "--fixture", "/root/testdata/sf0.01", "--as-of", "2024-01-16", "--out", out]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["rows"] > 0
    assert spark.read.parquet(out).select("event_date").distinct().count() == 1
    assert main(["alert", "--fixture", "/root/testdata/sf0.01", "--now", "2024-01-30 12:00:00", "--out", out]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert isinstance(res["alerts"], list)


def test_cli_alert_stream_once(spark, tmp_dir, capsys):
    from feedlens.__main__ import main
    src = os.path.join(tmp_dir, "landing")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").coalesce(1).write.parquet(src)
    out = os.path.join(tmp_dir, "stream_out")
    assert main(["alert-stream", "--events", src, "--stream-checkpoint", os.path.join(tmp_dir, "ck"),
                 "--once", "--out", out]) == 0
    assert spark.read.parquet(os.path.join(out, "windows")).where("users_feed > 0").count() > 300


def test_cli_ab_test(spark, tmp_dir, capsys):
    from feedlens.__main__ import main
    assert main(["ab-test", "--fixture", "/root/testdata/sf0.01", "--start", "2024-01-08", "--end", "2024-01-14",
                 "--groups", "1,2", "--reps", "100", "--buckets", "20", "--out", tmp_dir]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(res["tests"]) == 7


def test_cli_activity_then_report(spark, tmp_dir, capsys):
    from feedlens.__main__ import main
    tables = os.path.join(tmp_dir, "tables")
    assert main(["activity", "--fixture", "/root/testdata/sf0.001", "--start", "2024-01-01",
                 "--end", "2024-01-30", "--out", tables]) == 0
    assert main(["app-report", "--fixture", "/root/testdata/sf0.001", "--as-of", "2024-01-31",
                 "--tables", tables, "--out", os.path.join(tmp_dir, "rep")]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["message"].startswith("App report for 30.01.2024")


def test_sql_over_registered_views(spark, actions001):
    from feedlens.operators import experiments as ex
    from feedlens.sources import register_views
    register_views(actions001)
    sql = spark.sql("""
        SELECT exp_group, user_id,
               count_if(action = 'like') AS likes,
               count_if(action = 'view') AS views,
               try_divide(likes, views) AS ctr
        FROM feed_actions
        WHERE to_date(time) BETWEEN DATE'2024-01-08' AND DATE'2024-01-14' AND exp_group IN (1, 2)
        GROUP BY exp_group, user_id""")
    api = ex.user_ctr(actions001.feed, "2024-01-08", "2024-01-14", (1, 2))
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, api.collect()))
