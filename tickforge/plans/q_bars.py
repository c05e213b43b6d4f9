"""Queries: OHLCV bars, mergeable partials, trailing VWAP/order-flow/volatility."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.operators import bars
from tickforge.plans.registry import register
from tickforge.plans.sql_tapes import E_TAPE, with_tapes
from tickforge.sources.tapes import tape_events

TRAILING_DAYS = 7


def _bar_sql(bar_ms: int, group: str = "") -> str:
    g = f"{group}, " if group else ""
    return f"""
SELECT {g}CAST(floor("timestamp" / {bar_ms}) * {bar_ms} AS BIGINT) AS window_start,
       arg_min(price, ("timestamp", trade_id)) AS open,
       max(price) AS high,
       min(price) AS low,
       arg_max(price, ("timestamp", trade_id)) AS close,
       round(sum(quantity), 4) AS volume,
       round(sum(quote_quantity), 4) AS quote_volume,
       round(sum(CASE WHEN is_buyer_maker THEN -quantity ELSE quantity END), 4) AS order_flow_imbalance
FROM e GROUP BY ALL"""


def _round_bars(df):
    return df.withColumns({c: F.round(c, 4) for c in ("volume", "quote_volume", "order_flow_imbalance")})


@register("ohlcv_1m", "A1 E3", with_tapes(E_TAPE) + _bar_sql(bars.MINUTE_MS))
def q_ohlcv_1m(spark, sf):
    return _round_bars(bars.ohlcv(tape_events(spark, sf), bars.MINUTE_MS))


@register("ohlcv_1h_by_symbol", "A1", with_tapes(E_TAPE) + _bar_sql(bars.HOUR_MS, "symbol"))
def q_ohlcv_1h_by_symbol(spark, sf):
    return _round_bars(bars.ohlcv(tape_events(spark, sf), bars.HOUR_MS, ["symbol"]))


@register("ohlcv_partials_merged_1d", "A3", with_tapes(E_TAPE) + _bar_sql(bars.DAY_MS, "symbol"))
def q_ohlcv_partials_merged(spark, sf):
    partials = bars.ohlcv_partials(tape_events(spark, sf), bars.MINUTE_MS, ["symbol"])
    return _round_bars(bars.merge_partials(partials, bars.DAY_MS, ["symbol"]))


@register(
    "vwap_ofi_trailing",
    "A2 P11 W6",
    with_tapes(E_TAPE)
    + f"""
, r AS (SELECT * FROM e WHERE "timestamp" >= (SELECT max("timestamp") FROM e) - {TRAILING_DAYS} * 86400000),
q AS (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id) AS prev FROM r)
SELECT symbol,
       round(sum(price * quantity) / sum(quantity), 2) AS vwap,
       round(sum(CASE WHEN is_buyer_maker THEN -quantity ELSE quantity END), 4) AS net_order_flow_imbalance,
       round(coalesce(sqrt(sum(CASE WHEN prev > 0 AND price / prev > 0 THEN pow(ln(price / prev), 2) END)), 0.0), 4)
         AS realized_volatility,
       CAST(count(*) AS BIGINT) AS total_ticks
FROM q GROUP BY symbol""",
)
def q_vwap_ofi_trailing(spark, sf):
    t = tape_events(spark, sf)
    as_of = t.agg(F.max("timestamp")).first()[0]
    return bars.trailing_summary(t, as_of, minutes=TRAILING_DAYS * 24 * 60, group_cols=["symbol"])
