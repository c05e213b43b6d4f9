"""Queries: streams in several arrivals with kept state (U1, U2, U4). The events reach the stream
in four arrivals, quarters of their time span, and the stream is restarted for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.operators import bars
from tickforge.plans.q_bars import _bar_sql, _round_bars
from tickforge.plans.q_stream import ROLLING_SQL
from tickforge.plans.registry import register
from tickforge.plans.rounding import fround
from tickforge.plans.sql_tapes import E_TAPE, with_tapes
from tickforge.session import scratch_dir
from tickforge.sources.tapes import tape_events
from tickforge.streaming import incremental as inc
from tickforge.streaming.streams import run_available_now

ARRIVALS = 4


def _quarters(tape: DataFrame) -> tuple[DataFrame, int]:
    """The tape with its quarter ``q`` of the time span, and a quarter's width in ms."""
    lo, hi = tape.agg(F.min("timestamp"), F.max("timestamp")).first()
    lo, hi = lo or 0, hi or 0
    width = max(1, (hi - lo + 1) // ARRIVALS)
    return tape.withColumn("q", F.least(F.lit(ARRIVALS - 1), F.floor((F.col("timestamp") - lo) / width).cast("int"))), width


def _split(rows: DataFrame, arrival) -> list[DataFrame]:
    """One frame an arrival."""
    marked = rows.withColumn("_at", arrival)
    return [marked.where(F.col("_at") == k).drop("_at", "q") for k in range(ARRIVALS)]


@register("stream_bars_incremental", "U1 A3", with_tapes(E_TAPE) + _bar_sql(bars.HOUR_MS, "symbol"))
def q_stream_bars_incremental(spark, sf):
    """Update mode over four arrivals; every tenth trade comes one arrival late, within the
    watermark. Hour bars from the minute states of the touched days."""
    tape, width = _quarters(tape_events(spark, sf))
    late = F.least(F.lit(ARRIVALS - 1), F.col("q") + (F.col("trade_id") % 10 == 0).cast("int"))
    root = scratch_dir(spark, "bar-states")

    def start(stream, checkpoint):
        states = inc.stream_bar_states(stream, "1 minute", f"{width + 60_000} milliseconds", ["symbol"])
        inc.run_bar_states(states, root, checkpoint)

    inc.run_in_arrivals(spark, _split(tape, late), start)
    return _round_bars(inc.bars_from_states(spark.read.parquet(root), bars.HOUR_MS, ["symbol"]))


@register(
    "stream_first_wins",
    "U2",
    with_tapes(E_TAPE)
    + f""", span AS (SELECT min("timestamp") AS lo, greatest(1, (max("timestamp") - min("timestamp") + 1) // {ARRIVALS}) AS w FROM e)
SELECT trade_id, symbol, "timestamp", price FROM e
UNION ALL
SELECT trade_id, symbol, "timestamp" + 2 * w, price FROM e, span
WHERE trade_id % 5 <> 0 AND trade_id % 7 = 3 AND ("timestamp" - lo) // w <= 1""",
)
def q_stream_first_wins(spark, sf):
    """First-wins with a delay of an eighth of an arrival. Copies come (a) one arrival later,
    unchanged; (b) two arrivals later, that much younger: outside the delay, so they pass again;
    (c) one arrival later and a delay younger, of rows at an arrival's end: still remembered."""
    tape, width = _quarters(tape_events(spark, sf).select("trade_id", "symbol", "timestamp", "price"))
    delay, tid, ts = max(1, width // 8), F.col("trade_id"), F.col("timestamp")
    ends = tape.groupBy("q").agg(F.max("timestamp").alias("end"))  # one row an arrival
    tape = tape.join(F.broadcast(ends), "q")
    b = tid % 5 != 0
    same = tape.where((tid % 5 == 0) & (F.col("q") < ARRIVALS - 1)).withColumn("at", F.col("q") + 1)
    again = tape.where(b & (tid % 7 == 3) & (F.col("q") <= 1)).withColumns({"at": F.col("q") + 2, "timestamp": ts + 2 * width})
    near = tape.where(b & (tid % 7 != 3) & (tid % 11 == 4) & (F.col("q") < ARRIVALS - 1) & (ts > F.col("end") - delay))
    near = near.withColumns({"at": F.col("q") + 1, "timestamp": ts + delay})
    rows = tape.withColumn("at", F.col("q")).unionByName(same).unionByName(again).unionByName(near).drop("end")
    root = scratch_dir(spark, "first-wins")

    def start(stream, checkpoint):
        kept = inc.first_wins(stream, ["trade_id"], f"{delay} milliseconds")
        run_available_now(kept, lambda batch, epoch: inc.append_rows(batch, epoch, root), checkpoint)

    inc.run_in_arrivals(spark, [f.drop("at") for f in _split(rows, F.col("at"))], start)
    return spark.read.parquet(root).select("trade_id", "symbol", "timestamp", "price")


@register("stream_rolling_state", "U4 W1 W2 W7", ROLLING_SQL)
def q_stream_rolling_state(spark, sf):
    """Rolling features with a ring buffer a symbol in the state store, over four arrivals."""
    tape, _ = _quarters(tape_events(spark, sf).select("trade_id", "symbol", "timestamp", "price"))
    root = scratch_dir(spark, "rolling-state")

    def start(stream, checkpoint):
        run_available_now(inc.stream_rolling(stream), lambda batch, epoch: inc.append_rows(batch, epoch, root), checkpoint)

    inc.run_in_arrivals(spark, _split(tape, F.col("q")), start)
    names = ("price_roll_mean_20", "price_roll_std_20", "realized_volatility_10")
    return spark.read.parquet(root).select("trade_id", "symbol", *[fround(n).alias(n) for n in names])
