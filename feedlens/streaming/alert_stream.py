"""The alert's 15-minute metrics as a Structured Streaming query.

* Feed and messenger metrics per tumbling 15-minute window, with a watermark;
  a window is emitted once (append mode) when the watermark passes its end,
  which is the batch job's rule of leaving the open bucket out.
* Distinct users per window are exact: ``count(DISTINCT)`` is not supported
  on streams, so a first aggregation by (window, user) feeds a second one by
  window (chained stateful operators; the watermark flows through both).
* ``window_metrics`` computes feed and messenger metrics in one query over
  the union of both streams, so a window's six metrics arrive together.
* ``with_bands`` checks every closed window against its band inside the stream:
  ``BandState`` keeps, per metric, the few values before it that the two
  smoothed bands need, so no window is read again.
* ``run_alert_stream`` appends each micro-batch of closed windows to a
  Parquet table by date and batch id (a replayed batch overwrites its own
  folders, so nothing is duplicated), and the checks of these windows to another.
  ``check_buckets`` is the check from the stored windows, for a range of them
  that is to be judged again.

Event time must be a TIMESTAMP (with time zone) column to carry a watermark;
the fixture's TIMESTAMP_NTZ is cast with the session time zone (UTC).
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedlens.operators import alerts
from feedlens.operators.timeframe import date_literal
from feedlens.sources.actions import EVENTS_SCHEMA, feed_from_events, message_from_events


BUCKET = "15 minutes"


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def _event_time(df: DataFrame, watermark: str) -> DataFrame:
    return (df.withColumn("event_time", F.col("time").cast("timestamp"))
            .withWatermark("event_time", watermark))


def feed_window_metrics(feed: DataFrame, watermark: str = BUCKET) -> DataFrame:
    """Closed 15-minute windows of a feed stream: ts, users_feed, views, likes, ctr."""
    per_user = (_event_time(feed, watermark)
                .groupBy(F.window("event_time", BUCKET).alias("w"), "user_id")
                .agg(F.count_if(F.col("action") == "view").alias("views"),
                     F.count_if(F.col("action") == "like").alias("likes")))
    return (per_user.groupBy("w")
            .agg(F.count(F.lit(1)).alias("users_feed"),
                 F.sum("views").alias("views"), F.sum("likes").alias("likes"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("ts"), "users_feed", "views", "likes",
                    F.round(F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")), 3)
                    .alias("ctr")))


def message_window_metrics(message: DataFrame, watermark: str = BUCKET) -> DataFrame:
    """Closed 15-minute windows of a message stream: ts, users_messenger, number_messages."""
    per_user = (_event_time(message, watermark)
                .groupBy(F.window("event_time", BUCKET).alias("w"), "user_id")
                .agg(F.count("reciever_id").alias("n")))
    return (per_user.groupBy("w")
            .agg(F.count(F.lit(1)).alias("users_messenger"), F.sum("n").alias("number_messages"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("ts"), "users_messenger", "number_messages"))


def event_window_metrics(events: DataFrame, watermark: str = BUCKET) -> tuple[DataFrame, DataFrame]:
    """Feed and messenger window streams from one events stream."""
    return (feed_window_metrics(feed_from_events(events), watermark),
            message_window_metrics(message_from_events(events), watermark))


def window_metrics(feed: DataFrame, message: DataFrame, watermark: str = BUCKET) -> DataFrame:
    """All six alert metrics per closed 15-minute window, from the union of a
    feed stream and a message stream, in one query: a (window, user)
    aggregate, then a window aggregate. Both services' metrics of a window are
    emitted together. Columns: ts, users_feed, views, likes, ctr,
    users_messenger, number_messages (windows without feed rows have
    users_feed = 0; the batch alert leaves them out)."""
    f = feed.select("time", "user_id",
                    (F.col("action") == "view").cast("int").alias("v"),
                    (F.col("action") == "like").cast("int").alias("l"),
                    F.lit(1).alias("is_feed"), F.lit(0).alias("m"))
    m = message.select("time", "user_id", F.lit(0).alias("v"), F.lit(0).alias("l"),
                       F.lit(0).alias("is_feed"), F.col("reciever_id").isNotNull().cast("int").alias("m"))
    per_user = (_event_time(f.unionByName(m), watermark)
                .groupBy(F.window("event_time", BUCKET).alias("w"), "user_id")
                .agg(F.sum("v").alias("views"), F.sum("l").alias("likes"),
                     F.max("is_feed").alias("in_feed"), F.sum("m").alias("msgs"),
                     F.min("is_feed").alias("min_feed")))
    out = (per_user.groupBy("w")
           .agg(F.count_if(F.col("in_feed") == 1).alias("users_feed"),
                F.sum("views").alias("views"), F.sum("likes").alias("likes"),
                F.count_if(F.col("min_feed") == 0).alias("users_messenger"),
                F.sum("msgs").alias("number_messages")))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("ts"), "users_feed",
                      F.col("views").cast("bigint").alias("views"), F.col("likes").cast("bigint").alias("likes"),
                      F.round(F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")), 3)
                      .alias("ctr"),
                      "users_messenger", F.col("number_messages").cast("bigint").alias("number_messages"))


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Closed windows of one micro-batch under ``date=<day>/batch=<id>``: a
    replayed batch replaces its own folders, and readers list only the days
    they ask for."""
    (df.withColumn("date", F.to_date("ts")).withColumn("batch", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "batch").parquet(path))


def check_buckets(spark: SparkSession, table: str, buckets: DataFrame) -> DataFrame:
    """Band check of every bucket of ``buckets`` (column ``ts``) against the
    windows stored by the stream: the rows of one ``alert_check`` per bucket."""
    # one row: the days to read
    span = buckets.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    start = span["lo"].date() - dt.timedelta(days=1)
    series = (spark.read.parquet(table)
              .where(F.col("date").between(date_literal(start), date_literal(span["hi"])))
              .where(F.col("users_feed") > 0).drop("date", "batch"))
    return alerts.check_each(series, buckets)


Point = tuple[int, float | None]     # a bucket's start in microseconds of its own clock, value
DAY, STEP = 86_400_000_000, 900_000_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _mean(values: list[float]) -> float | None:
    total = 0.0
    for v in values:
        total += v
    return total / len(values) if values else None


def _sample_std(values: list[float]) -> float:
    """By the running moments that Spark's ``stddev_samp`` uses, so that both give the same digits."""
    mean = m2 = 0.0
    for n, v in enumerate(values, start=1):
        d = v - mean
        mean += d / n
        m2 += d * (d - d / n)
    return math.sqrt(m2 / (len(values) - 1))


def band_of_last(points: list[Point], a: float = alerts.BAND_WIDTH, n: int = alerts.BAND_ROWS):
    """(prev_value, low, up) of the last of a metric's points: those of ``alerts.alert_bands``, whose
    series starts on the day before the moment that the bucket closed.

    The last row's lower band is the mean over n rows and the upper one over those of
    them that its centred frame reaches back to; each row needs the n values before it.
    """
    first = (points[-1][0] + STEP) // DAY * DAY - DAY
    values = [v for ts, v in points if ts >= first]

    def band(i: int, sign: int) -> float | None:
        before = values[max(0, i - n):i]
        if len(before) < n or any(v is None for v in before):
            return None
        return _mean(before) + sign * a * _sample_std(before)

    def smoothed(rows: int, sign: int) -> float | None:
        found = (band(i, sign) for i in range(max(0, len(values) - rows), len(values)))
        return _mean([x for x in found if x is not None])

    return (values[-2] if len(values) > 1 else None), smoothed(n, -1), smoothed(n // 2 + 1, 1)


class BandState(StatefulProcessor):
    """Per metric: the last values, as many as the bands of the next one need.

    Windows reach it closed, each once, and no later batch has an earlier window
    (append mode emits them as the watermark passes), so a batch's rows are taken
    in order of time. A window without feed actions is handed on unchecked.
    """

    KEPT = 2 * alerts.BAND_ROWS - 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "ts array<bigint>, value array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        points: list[Point] = []
        if self.last.exists():
            ts, values = self.last.get()
            points = list(zip(ts, values))
        new = pd.concat(list(rows)).sort_values("ts")
        out = []
        for us, value, in_feed in zip(new["ts"].astype("datetime64[us]").astype("int64"), new["value"], new["in_feed"]):
            value = None if pd.isna(value) else float(value)
            prev = low = up = None
            if in_feed:
                points = [*points[-self.KEPT:], (int(us), value)]
                prev, low, up = band_of_last(points)
            out.append((key[0], int(us), value, prev, low, up, bool(in_feed)))
        points = points[-self.KEPT:]
        self.last.update(([p[0] for p in points], [p[1] for p in points]))
        made = pd.DataFrame(out, columns=["metric", "ts", "value", "prev_value", "low", "up", "in_feed"]).astype(
            {c: "float64" for c in ("value", "prev_value", "low", "up")})
        yield made.assign(ts=pd.to_datetime(made["ts"], unit="us"))

    def close(self) -> None:
        pass


def with_bands(windows: DataFrame) -> DataFrame:
    """(metric, ts, value, prev_value, low, up, in_feed) for each metric of a stream of ``window_metrics``;
    bands are null where ``in_feed`` is false. The session's state store must be the RocksDB one."""
    metrics = alerts.ALERT_METRICS
    long = (windows.select("ts", (F.col("users_feed") > 0).alias("in_feed"),
                           F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                               for m in metrics])).alias("m"))
            .select("m.metric", "ts", "m.value", "in_feed"))
    checked = long.groupBy("metric").transformWithStateInPandas(
        BandState(), "metric string, ts timestamp_ntz, value double, prev_value double, low double, up double, in_feed boolean",
        "Append", "None")
    # a missing number comes back from pandas as NaN
    numbers = {c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("value", "prev_value", "low", "up")}
    return checked.withColumns(numbers)


def _windows_of(checked: DataFrame) -> DataFrame:
    """The windows again, one row each, from their metrics."""
    by_metric = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in alerts.ALERT_METRICS]
    out = checked.groupBy("ts").agg(*by_metric)
    return out.select("ts", *[F.col(m).cast("double" if m == "ctr" else "bigint").alias(m) for m in alerts.ALERT_METRICS])


def run_alert_stream(spark: SparkSession, events_path: str, out_dir: str, checkpoint_dir: str,
                     available_now: bool = True, processing_time: str = "15 minutes",
                     check_alerts: bool = True, max_files_per_trigger: int | None = None):
    """Start the alert stream over event files landing in ``events_path``.

    Each micro-batch appends its closed windows to ``out_dir/windows`` (by
    date, then batch id, so a replayed batch replaces itself) and writes the
    band check of every window it closed to ``out_dir/alerts/batch=<id>``, also
    after a pause or over a backlog. The bands come from the stream's own state
    (``BandState``), which survives a restart in the checkpoint; nothing that was
    written is read again. The session's state store is set to RocksDB while the
    query starts. Returns the streaming query.
    """
    events = read_event_stream(spark, events_path, max_files_per_trigger)
    windows = window_metrics(feed_from_events(events), message_from_events(events))
    table, alert_table = f"{out_dir}/windows", f"{out_dir}/alerts"

    def sink(df: DataFrame, batch_id: int) -> None:
        # The batch's stateful plan runs once; what follows reads its rows.
        df = df.persist()
        try:
            if df.isEmpty():
                return
            _write_batch(_windows_of(df) if check_alerts else df, table, batch_id)
            if check_alerts:
                (alerts.flagged(df.where("in_feed"))
                 .write.mode("overwrite").parquet(f"{alert_table}/batch={batch_id}"))
        finally:
            df.unpersist()

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        w = ((with_bands(windows) if check_alerts else windows).writeStream.outputMode("append").foreachBatch(sink)
             .option("checkpointLocation", checkpoint_dir))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
        return w.start()
    finally:
        spark.conf.set(STATE_STORE, before)
