"""Silver dedupe and bars: properties and equivalences."""

from pyspark.sql import functions as F

from conftest import SF01
from tickforge.operators import bars, silver
from tickforge.schema import TRADE_SCHEMA
from tickforge.sources.tapes import tape_events, tape_lineitem


def test_dedupe_newest_and_filter_first(spark):
    rows = [
        (1, 10.0, 1.0, 10.0, 100, True, True),
        (1, 11.0, 1.0, 11.0, 200, True, True),
        (1, -1.0, 1.0, -1.0, 300, True, True),  # newer but invalid: must not shadow
        (2, 5.0, 1.0, 5.0, 100, False, True),
        (2, 6.0, 1.0, 6.0, 100, False, True),  # tie in time: larger price wins
    ]
    s = silver.silver(spark.createDataFrame(rows, TRADE_SCHEMA), "2024-06-13").orderBy("trade_id").collect()
    assert [(r.trade_id, r.price) for r in s] == [(1, 11.0), (2, 6.0)]
    assert s[0].partition_date == "2024-06-13"


def test_dedupe_idempotent(spark):
    t = tape_lineitem(spark, SF01)
    once = silver.silver(t)
    twice = silver.silver(once)
    assert once.count() == 45832 and once.exceptAll(twice).count() == 0


def test_ohlc_properties_and_volume(spark):
    t = tape_events(spark, SF01)
    b = bars.ohlcv(t, bars.HOUR_MS, ["symbol"])
    assert b.where("low > open or low > close or high < open or high < close").count() == 0
    tot = t.agg(F.sum("quantity")).first()[0]
    assert abs(b.agg(F.sum("volume")).first()[0] - tot) < 1e-6


def test_partials_merge_equals_direct(spark):
    t = tape_events(spark, SF01)
    direct = bars.ohlcv(t, bars.DAY_MS, ["symbol"])
    merged = bars.merge_partials(bars.ohlcv_partials(t, bars.MINUTE_MS, ["symbol"]), bars.DAY_MS, ["symbol"])
    cols = ["symbol", "window_start", "open", "high", "low", "close"]
    assert direct.select(*cols).exceptAll(merged.select(*cols)).count() == 0
    d = direct.select("symbol", "window_start", "volume").toPandas().sort_values(["symbol", "window_start"])
    m = merged.select("symbol", "window_start", "volume").toPandas().sort_values(["symbol", "window_start"])
    assert abs(d["volume"].to_numpy() - m["volume"].to_numpy()).max() < 1e-6


def test_quote_fallback(spark):
    rows = [(1, 2.0, 3.0, 0.0, 1, True, True), (2, 4.0, 1.0, 0.0, 2, True, True)]
    out = silver.quote_fallback(spark.createDataFrame(rows, TRADE_SCHEMA)).orderBy("trade_id").collect()
    assert [r.quote_quantity for r in out] == [6.0, 4.0]
