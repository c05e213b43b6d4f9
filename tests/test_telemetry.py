"""Telemetry (N1-N3) and the trailing summary (A2) on hand-computed inputs."""

import math

import pytest

from tickforge.operators import bars, telemetry
from tickforge.schema import TRADE_SCHEMA


def test_counter_rate_reset_aware(spark):
    rows = [("s", 0, 0.0), ("s", 60_000, 10.0), ("s", 120_000, 4.0), ("s", 240_000, 10.0),  # reset at 120s
            ("t", 30_000, 5.0), ("t", 90_000, 8.0)]
    df = spark.createDataFrame(rows, "series string, ts_ms long, value double")
    r = telemetry.counter_rate(df, ["series"], window_ms=300_000).collect()
    assert len(r) == 1
    assert r[0].increase == 10.0 + 4.0 + 6.0 + 3.0
    assert r[0].rate_per_min == pytest.approx(23.0 / 300.0 * 60.0)


def test_bucket_quantile(spark):
    rows = [("a", 10.0, 20), ("a", 50.0, 60), ("a", math.inf, 100), ("b", 10.0, 99), ("b", math.inf, 100)]
    df = spark.createDataFrame(rows, "g string, le double, count long")
    q = {r.g: r.quantile for r in telemetry.bucket_quantile(df, 0.5, ["g"]).collect()}
    assert q["a"] == pytest.approx(10.0 + (50.0 - 10.0) * (50 - 20) / (60 - 20))
    q95 = {r.g: r.quantile for r in telemetry.bucket_quantile(df, 0.995, ["g"]).collect()}
    assert q95["b"] == 10.0  # falls in the +Inf bucket: largest finite bound


def test_gauge_sum_default(spark):
    df = spark.createDataFrame([("x", 1, 2.0), ("x", 2, 3.0), ("y", 1, 4.0)], "s string, ts_ms long, value double")
    assert telemetry.gauge_sum(df, ["s"]).collect()[0].value == 7.0
    assert telemetry.gauge_sum(df.limit(0), ["s"]).collect()[0].value == 1.0


def test_trailing_summary(spark):
    rows = [(1, 100.0, 1.0, 100.0, 1_000, False, True), (2, 110.0, 2.0, 220.0, 2_000, True, True),
            (3, 99.0, 1.0, 99.0, 3_000, False, True), (4, 50.0, 5.0, 250.0, 10, False, True)]
    df = spark.createDataFrame(rows, TRADE_SCHEMA)
    r = bars.trailing_summary(df, as_of_ms=3_000, minutes=1).collect()[0]  # window keeps ts >= -57000: all rows
    assert r.total_ticks == 4
    assert r.vwap == round((100 + 220 + 99 + 250) / 9.0, 2)
    assert r.net_order_flow_imbalance == 1.0 - 2.0 + 1.0 + 5.0
    lr = [math.log(100 / 50), math.log(110 / 100), math.log(99 / 110)]
    assert r.realized_volatility == round(math.sqrt(sum(x * x for x in lr)), 4)
