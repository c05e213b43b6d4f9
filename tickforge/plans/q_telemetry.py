"""Queries: counter rate, histogram quantile and gauge sum over metric samples derived from the
events tape (N1-N3)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tickforge.operators import telemetry
from tickforge.operators.sequence import drop_helpers, with_sequence
from tickforge.plans.registry import register
from tickforge.plans.rounding import fround, sql_fround
from tickforge.plans.sql_tapes import E_TAPE, with_tapes
from tickforge.sources.tapes import EVENTS_ORDER, tape_events

# Bucket upper bounds of the price histogram and the quantile asked for.
PRICE_BUCKETS = (10.0, 25.0, 50.0, 100.0, 250.0, 500.0, math.inf)
P95 = 0.95


def _counter_samples(spark, sf):
    """A per-symbol trade counter that restarts every day: value = trades so far that day."""
    s = drop_helpers(with_sequence(tape_events(spark, sf), EVENTS_ORDER, ["symbol", "ds"]))
    return s.select("symbol", "trade_id", F.col("timestamp").alias("ts_ms"), (F.col("seq") + 1).cast("double").alias("value"))


@register(
    "counter_rate",
    "N1",
    with_tapes(E_TAPE)
    + """
, c AS (SELECT symbol, "timestamp" AS ts_ms, trade_id,
               CAST(row_number() OVER (PARTITION BY symbol, ds ORDER BY "timestamp", trade_id) AS DOUBLE) AS value FROM e),
d AS (SELECT ts_ms, CASE WHEN lag(value) OVER w IS NULL THEN 0.0
                         WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w ELSE value END AS inc
      FROM c WINDOW w AS (PARTITION BY symbol ORDER BY ts_ms, trade_id))
SELECT CAST(floor(ts_ms / 300000) * 300000 AS BIGINT) AS window_start, sum(inc) AS increase,
       sum(inc) / 300.0 * 60.0 AS rate_per_min
FROM d GROUP BY ALL""",
)
def q_counter_rate(spark, sf):
    return telemetry.counter_rate(_counter_samples(spark, sf).drop("trade_id"), ["symbol"], 300_000)


def _bucket_rows(spark, sf):
    t = tape_events(spark, sf)
    cum = t.groupBy("symbol").agg(
        *[F.sum(F.when(F.col("price") <= F.lit(le), 1).otherwise(0)).alias(f"b{i}") for i, le in enumerate(PRICE_BUCKETS)]
    )
    stack = ", ".join(f"CAST({le!r} AS DOUBLE), b{i}" if le != math.inf else f"CAST('Infinity' AS DOUBLE), b{i}"
                      for i, le in enumerate(PRICE_BUCKETS))
    return cum.selectExpr("symbol", f"stack({len(PRICE_BUCKETS)}, {stack}) AS (le, count)")


_LES = ", ".join(f"(CAST({le!r} AS DOUBLE))" if le != math.inf else "(CAST('inf' AS DOUBLE))" for le in PRICE_BUCKETS)


@register(
    "bucket_quantile",
    "N2",
    with_tapes(E_TAPE)
    + f"""
, les AS (SELECT CAST(v.x AS DOUBLE) AS le FROM (VALUES {_LES}) v(x)),
b AS (SELECT symbol, le, CAST(count_if(price <= le) AS DOUBLE) AS c FROM e, les GROUP BY symbol, le),
t AS (SELECT symbol, max(c) AS total FROM b GROUP BY symbol),
cur AS (SELECT b.symbol, min(le) AS le FROM b JOIN t USING (symbol) WHERE c >= {P95} * total GROUP BY b.symbol),
x AS (SELECT cur.symbol, cur.le AS cur_le, bc.c AS cur_c, coalesce(max(bp.le), 0.0) AS lo_le,
             coalesce(arg_max(bp.c, bp.le), 0.0) AS lo_c, t.total
      FROM cur JOIN b bc ON bc.symbol = cur.symbol AND bc.le = cur.le JOIN t ON t.symbol = cur.symbol
      LEFT JOIN b bp ON bp.symbol = cur.symbol AND bp.le < cur.le
      GROUP BY cur.symbol, cur.le, bc.c, t.total)
SELECT symbol, {sql_fround(f"CASE WHEN cur_le = 'inf'::DOUBLE THEN (SELECT max(le) FROM les WHERE le < 'inf'::DOUBLE) ELSE lo_le + (cur_le - lo_le) * (({P95} * total - lo_c) / (cur_c - lo_c)) END")} AS quantile
FROM x""",
)
def q_bucket_quantile(spark, sf):
    q = telemetry.bucket_quantile(_bucket_rows(spark, sf), P95, ["symbol"])
    return q.select("symbol", fround("quantile").alias("quantile"))


@register(
    "gauge_sum",
    "N3",
    with_tapes(E_TAPE)
    + """
, g AS (SELECT symbol, arg_max(price, ("timestamp", trade_id)) AS v FROM e GROUP BY symbol)
SELECT """
    + sql_fround("coalesce(sum(v), 1.0)")
    + " AS value FROM g",
)
def q_gauge_sum(spark, sf):
    t = tape_events(spark, sf).select("symbol", "trade_id", F.col("timestamp").alias("ts_ms"), F.col("price").alias("value"))
    return telemetry.gauge_sum(t, ["symbol"], tiebreak=["trade_id"]).select(fround("value").alias("value"))
