import csv
import glob
import os

from pyspark.sql import functions as F

from feedlens.operators import metrics, slices
from feedlens.sources import sinks


def _day(spark, actions, day):
    return slices.daily_slices(actions.feed, actions.message, day, day)


def test_rerun_of_a_day_does_not_duplicate(spark, actions001, tmp_dir):
    path = os.path.join(tmp_dir, "slices")
    d1, d2 = "2024-01-15", "2024-01-16"
    sinks.write_slices(_day(spark, actions001, d1), path)
    n1 = spark.read.parquet(path).count()
    sinks.write_slices(_day(spark, actions001, d1), path)          # retry of the same day
    assert spark.read.parquet(path).count() == n1
    sinks.write_slices(_day(spark, actions001, d2), path)          # next day is added
    back = spark.read.parquet(path)
    assert back.select("event_date").distinct().count() == 2
    sinks.write_slices(_day(spark, actions001, d2), path, mode="append")
    again = spark.read.parquet(path)                               # a new listing of the files
    assert again.where(F.col("event_date") == d2).count() == 2 * _day(spark, actions001, d2).count()


def test_catalog_table_insert(spark, actions001, tmp_dir):
    table = "slices_test_tbl"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df = _day(spark, actions001, "2024-01-15")
    loc = os.path.join(tmp_dir, "tbl")
    sinks.insert_slices(df, table, location=loc)
    sinks.insert_slices(df, table, location=loc)
    assert spark.table(table).count() == df.count()
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_top_posts_csv_has_index(spark, actions001, tmp_dir):
    out = os.path.join(tmp_dir, "top")
    sinks.write_top_posts_csv(metrics.top_posts(actions001.feed), out)
    files = glob.glob(os.path.join(out, "*.csv"))
    assert len(files) == 1
    with open(files[0]) as f:
        rows = list(csv.reader(f))
    assert rows[0] == ["index", "post_id", "views", "likes", "ctr", "uniq_users"]
    assert [r[0] for r in rows[1:]] == [str(i) for i in range(10)]
    views = [int(r[2]) for r in rows[1:]]
    assert views == sorted(views, reverse=True)
