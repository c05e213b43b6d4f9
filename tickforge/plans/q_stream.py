"""Queries: streaming bars, newest-wins dedupe and Gold refresh (U1-U3), run with availableNow."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.plans.q_bars import _bar_sql
from tickforge.plans.q_features import gold_all, gold_sql
from tickforge.plans.registry import register
from tickforge.plans.rounding import fround, sql_fround
from tickforge.plans.sql_tapes import E_TAPE, L_TAPE, with_tapes
from tickforge.sources.tapes import events_to_tape, lineitem_to_tape
from tickforge.streaming import streams

LI_ORDER_DESC = ("timestamp", "price", "quantity", "quote_quantity", "l_partkey", "l_suppkey")


@register("stream_ohlcv", "U1", with_tapes(E_TAPE) + _bar_sql(60_000))
def q_stream_ohlcv(spark, sf):
    tape = events_to_tape(streams.read_table_stream(spark, sf, "events"))
    bars = streams.stream_ohlcv(tape, "1 minute", watermark="10 minutes")
    out = streams.stream_ohlcv_table(spark, bars)
    return out.withColumns({c: F.round(c, 4) for c in ("volume", "quote_volume", "order_flow_imbalance")})


@register(
    "stream_dedupe",
    "U2 D2",
    with_tapes(L_TAPE)
    + """
, d AS (SELECT *, row_number() OVER (PARTITION BY ds, trade_id ORDER BY "timestamp" DESC, price DESC, quantity DESC,
                                     quote_quantity DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM l)
SELECT trade_id, price, quantity, quote_quantity, "timestamp", is_buyer_maker, is_best_match, symbol, ds, l_partkey, l_suppkey
FROM d WHERE rn = 1""",
)
def q_stream_dedupe(spark, sf):
    tape = lineitem_to_tape(streams.read_table_stream(spark, sf, "lineitem"))
    t = streams.stream_dedupe_table(spark, tape, ["trade_id"], LI_ORDER_DESC, "ds")
    return t.select("trade_id", "price", "quantity", "quote_quantity", "timestamp", "is_buyer_maker", "is_best_match",
                    "symbol", "ds", "l_partkey", "l_suppkey")


_SILVER_E = """,
sv AS (SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY ds, trade_id ORDER BY "timestamp" DESC, price DESC, quantity DESC,
                                      quote_quantity DESC) AS rn
         FROM e WHERE price > 0 AND quantity > 0) WHERE rn = 1)"""


@register(
    "stream_gold",
    "U3 F1 K7",
    "SELECT * EXCLUDE (symbol) FROM (" + gold_sql("ds", pre=_SILVER_E, src="sv") + ")",
)
def q_stream_gold(spark, sf):
    tape = events_to_tape(streams.read_table_stream(spark, sf, "events"))
    g = streams.stream_gold_table(spark, tape)
    return gold_all(g, ["trade_id"])


ROLLING_SQL = (
    with_tapes(E_TAPE)
    + """
, r AS (SELECT *, CASE WHEN row_number() OVER wo = 1 THEN 0.0 ELSE ln(price / lag(price) OVER wo) END AS lr
        FROM e WINDOW wo AS (PARTITION BY symbol ORDER BY "timestamp", trade_id))
SELECT trade_id, symbol,
       """
    + sql_fround('avg(price) OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)')
    + """ AS price_roll_mean_20,
       """
    + sql_fround('coalesce(stddev_samp(price) OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0.0)')
    + """ AS price_roll_std_20,
       """
    + sql_fround('sqrt(sum(lr * lr) OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))')
    + """ AS realized_volatility_10
FROM r"""
)


@register("stream_rolling_features", "U4 W1 W2 W7", ROLLING_SQL)
def q_stream_rolling_features(spark, sf):
    tape = events_to_tape(streams.read_table_stream(spark, sf, "events"))
    f = streams.stream_rolling_features(spark, tape, windows=(5, 10, 20), lag_steps=(1,), vol_windows=(10,),
                                        derived=False, size_bucket=False)
    return f.select("trade_id", "symbol", fround("price_roll_mean_20").alias("price_roll_mean_20"),
                    fround("price_roll_std_20").alias("price_roll_std_20"),
                    fround("realized_volatility_10").alias("realized_volatility_10"))
