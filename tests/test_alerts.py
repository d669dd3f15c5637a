import datetime as dt

import numpy as np
import pandas as pd
import pytest

from feedlens.operators import alerts

T0 = dt.datetime(2024, 1, 30, 0, 0)


def _series(spark, values, metric="views"):
    rows = [(T0 + dt.timedelta(minutes=15 * i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"ts timestamp_ntz, {metric} double")
    return df


def _pandas_bands(values, a=3, n=4):
    s = pd.Series(values, dtype=float)
    mean = s.shift(1).rolling(n).mean()
    std = s.shift(1).rolling(n).std()
    up = (mean + a * std).rolling(n, center=True, min_periods=1).mean()
    low = (mean - a * std).rolling(n, center=False, min_periods=1).mean()
    return mean, std, up, low


def test_bands_match_pandas_rolling(spark):
    values = [2.0 ** i for i in range(8)]
    b = alerts.alert_bands(_series(spark, values), metrics=["views"]).orderBy("ts").toPandas()
    mean, std, up, low = _pandas_bands(values)
    assert b["mean"].isna().tolist()[:4] == [True] * 4       # first four baselines are NULL
    np.testing.assert_allclose(b["mean"].astype(float), mean, equal_nan=True)
    np.testing.assert_allclose(b["std"].astype(float), std, equal_nan=True)
    np.testing.assert_allclose(b["up"].astype(float), up, equal_nan=True)
    np.testing.assert_allclose(b["low"].astype(float), low, equal_nan=True)


def test_null_in_frame_blanks_the_baseline(spark):
    values = [5.0, 6.0, 7.0, None, 8.0, 9.0, 10.0, 11.0, 12.0, 13.0]
    b = alerts.alert_bands(_series(spark, values), metrics=["views"]).orderBy("ts").toPandas()
    # rows 4..7 have the NULL (row 3) in their 4-row frame
    assert b["mean"].iloc[4:8].isna().all()
    assert not np.isnan(b["mean"].iloc[8])


def test_planted_spike_raises_alert(spark):
    values = [100.0 + (i % 3) for i in range(30)] + [400.0]
    check = alerts.alert_check(alerts.alert_bands(_series(spark, values), metrics=["views"])).first()
    assert check.is_alert is True
    assert check.deviation == pytest.approx(abs(1 - 400.0 / 102.0))
    assert check.message.startswith("Alert! Metric Views:\n- current value 400.00;")
    calm = alerts.alert_check(alerts.alert_bands(_series(spark, values[:-1]), metrics=["views"])).first()
    assert calm.is_alert is False and calm.message is None


def test_alert_window_drops_open_bucket():
    start, end = alerts.alert_window(dt.datetime(2024, 1, 30, 12, 7, 30))
    assert start == dt.datetime(2024, 1, 29, 0, 0)
    assert end == dt.datetime(2024, 1, 30, 12, 0)
