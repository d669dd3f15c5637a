"""Date parameters and day-range predicates.

The jobs never read the clock: "today" is a parameter (``as_of``) and "now"
too, so a rerun of a past day gives the same rows. Day ranges become plain
comparisons on the raw timestamp, which reach the Parquet scan as pushed
filters (and prune partitions when the table is partitioned by time).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(d: dt.date | str) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def as_datetime(t: dt.datetime | str) -> dt.datetime:
    if isinstance(t, dt.datetime):
        return t
    if isinstance(t, dt.date):
        return dt.datetime(t.year, t.month, t.day)
    return dt.datetime.fromisoformat(str(t))


def ts_literal(t: dt.datetime | dt.date | str) -> Column:
    """A timestamp literal without time zone (the fixture's type)."""
    return F.lit(as_datetime(t).isoformat(sep=" ")).cast("timestamp_ntz")


def date_literal(d: dt.date | str) -> Column:
    return F.lit(as_date(d).isoformat()).cast("date")


def day_range(col: str, start: dt.date | str | None, end: dt.date | str | None) -> Column:
    """``col`` falls on a day in [start, end] (either side may be open)."""
    c = F.col(col)
    parts = []
    if start is not None:
        parts.append(c >= ts_literal(as_date(start)))
    if end is not None:
        parts.append(c < ts_literal(as_date(end) + dt.timedelta(days=1)))
    if not parts:
        return F.lit(True)
    return parts[0] if len(parts) == 1 else parts[0] & parts[1]


# Date partition columns recognised on the action tables. Catalyst cannot
# derive a partition predicate from a predicate on the timestamp, so when a
# table is partitioned by the event date, the day range is stated on that
# column too and whole partitions are skipped before any file is opened.
PARTITION_DATE_COLUMNS = ("event_date", "dt")


def where_days(df: DataFrame, start: dt.date | str | None, end: dt.date | str | None,
               time_col: str = "time") -> DataFrame:
    """Rows of ``df`` whose ``time_col`` falls on a day in [start, end]."""
    if start is None and end is None:
        return df
    out = df.where(day_range(time_col, start, end))
    for c in PARTITION_DATE_COLUMNS:
        if c in df.columns:
            if start is not None:
                out = out.where(F.col(c) >= date_literal(start))
            if end is not None:
                out = out.where(F.col(c) <= date_literal(end))
            break
    return out


def yesterday(as_of: dt.date | str) -> dt.date:
    return as_date(as_of) - dt.timedelta(days=1)


def fifteen_minute_floor(t: dt.datetime | str) -> dt.datetime:
    t = as_datetime(t)
    return t.replace(minute=t.minute - t.minute % 15, second=0, microsecond=0)
