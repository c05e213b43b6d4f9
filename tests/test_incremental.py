"""Streams with kept state: several arrivals, restarts, late rows and replays."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from tickforge.operators import bars, features
from tickforge.sources.tapes import tape_events
from tickforge.streaming import incremental as inc
from tickforge.streaming.streams import run_available_now

HOUR = 3_600_000


def _rows(spark, rows):
    schema = "trade_id long, price double, quantity double, quote_quantity double, timestamp long, is_buyer_maker boolean, symbol string"
    return spark.createDataFrame([(i, p, 1.0, p, t, False, s) for i, p, t, s in rows], schema)


def test_states_of_late_rows_merge_and_days_are_touched_alone(spark, tmp_path):
    day = 24 * HOUR
    one = _rows(spark, [(1, 10.0, 1000, "a"), (2, 12.0, 2000, "a"), (3, 5.0, day + 1000, "a")])
    two = _rows(spark, [(4, 9.0, day - 500, "a"), (5, 99.0, 500, "a"), (6, 7.0, day + 2000, "a")])
    far = _rows(spark, [(7, 1.0, 9 * day, "a")])
    lost = _rows(spark, [(8, 1000.0, 1500, "a"), (9, 2.0, 9 * day + 1, "a")])
    root = str(tmp_path / "states")

    def start(stream, checkpoint):
        inc.run_bar_states(inc.stream_bar_states(stream, "1 minute", "2 days", ["symbol"]), root, checkpoint)

    inc.run_in_arrivals(spark, [one, two, far, lost], start)
    states = spark.read.parquet(root)
    got = {r["window_start"]: r for r in inc.bars_from_states(states, day, ["symbol"]).collect()}
    want = {r["window_start"]: r for r in bars.ohlcv(one.unionByName(two).unionByName(far).unionByName(lost.where("trade_id = 9")), day, ["symbol"]).collect()}
    # Trade 8 came days behind the watermark: its window's state was given up.
    assert {k: v.asDict() for k, v in got.items()} == {k: {c: v[c] for c in got[k].asDict()} for k, v in want.items()}
    assert got[0]["open"] == 99.0 and got[0]["close"] == 9.0
    epochs = {(r["ds"], r["epoch"]) for r in states.select(F.col("ds").cast("string"), "epoch").distinct().collect()}
    assert sum(d == "1970-01-10" for d, _ in epochs) == 2 and len({e for _, e in epochs}) == 4

    before = sorted(map(str, inc.bars_from_states(states, HOUR, ["symbol"]).collect()))
    inc.compact_day(spark, root, "1970-01-01", ["symbol"])
    compact = spark.read.parquet(root)
    assert compact.where("ds = '1970-01-01'").select("epoch").distinct().count() == 1
    assert sorted(map(str, inc.bars_from_states(compact, HOUR, ["symbol"]).collect())) == before


def test_a_replayed_epoch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "states")
    states = bars.ohlcv_partials(_rows(spark, [(1, 10.0, 1000, "a"), (2, 3.0, 2000, "b")]), 60_000, ["symbol"]).withColumn("ds", F.lit("1970-01-01"))
    for epoch in (0, 1, 1):
        inc.append_bar_states(states, epoch, root)
    table = spark.read.parquet(root)
    assert table.count() == 4 and inc.newest_states(table, ["symbol"]).count() == 2


def test_first_wins_forgets_after_the_delay(spark, tmp_path):
    root = str(tmp_path / "first")
    batches = [
        [(1, 1.0, 10 * HOUR, "a"), (2, 2.0, 10 * HOUR, "a")],
        [(1, 9.0, 10 * HOUR + 1, "a"), (3, 3.0, 14 * HOUR, "a")],  # 1: a copy within the delay
        [(1, 8.0, 15 * HOUR, "a"), (2, 7.0, 10 * HOUR, "a")],  # 1: forgotten by now; 2: behind the watermark
    ]

    def start(stream, checkpoint):
        run_available_now(inc.first_wins(stream, ["trade_id"], "1 hour"), lambda b, e: inc.append_rows(b, e, root), checkpoint)

    inc.run_in_arrivals(spark, [_rows(spark, b) for b in batches], start)
    assert sorted(r["price"] for r in spark.read.parquet(root).collect()) == [1.0, 2.0, 3.0, 8.0]


def test_rolling_state_over_restarts_equals_one_batch(spark, tmp_path):
    tape = tape_events(spark, SF001).select("symbol", "timestamp", "trade_id", "price").checkpoint()
    cuts = [r[0] for r in tape.orderBy("timestamp", "trade_id").select("timestamp").collect()][:: max(1, tape.count() // 5)][1:5]
    arrivals = [tape.where((F.col("timestamp") >= a) & (F.col("timestamp") < b)) for a, b in zip([0, *cuts], [*cuts, 1 << 62])]

    def run(frames, root):
        def start(stream, checkpoint):
            run_available_now(inc.stream_rolling(stream), lambda b, e: inc.append_rows(b, e, root), checkpoint)

        inc.run_in_arrivals(spark, frames, start)
        return spark.read.parquet(root).drop("epoch").toPandas().sort_values("trade_id").reset_index(drop=True)

    several, one = run(arrivals, str(tmp_path / "several")), run([tape], str(tmp_path / "one"))
    assert len(several) == tape.count() and (several["trade_id"] == one["trade_id"]).all()
    ref = features.trade_features(tape_events(spark, SF001), group_cols=["symbol"], windows=(20,), lag_steps=(1,), vol_windows=(10,), derived=False, size_bucket=False)
    ref = ref.select("trade_id", *[c for c in several.columns if c not in ("trade_id", "symbol")]).toPandas().sort_values("trade_id")
    for c in ("price_roll_mean_20", "price_roll_std_20", "realized_volatility_10"):
        assert np.allclose(several[c], one[c], atol=1e-9) and np.allclose(several[c], ref[c].to_numpy(), atol=1e-8)
