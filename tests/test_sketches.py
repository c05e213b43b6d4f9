"""Day sketches against exact drift and ranks; the segmented counter scan against a plain walk."""

import numpy as np
from pyspark.sql import functions as F

from tickforge.operators import drift, sketches, telemetry


def _days(spark, n=6_000):
    rng = np.random.default_rng(8)
    rows = [(f"2024-01-{1 + i * 6 // n:02d}", float(rng.normal(i * 6 // n * 0.1)), float(rng.integers(0, 5)), None if i % 9 else 1.0) for i in range(n)]
    return spark.createDataFrame(rows, "ds string, a double, b double, c double")


def test_any_two_ranges_from_the_same_sketches(spark):
    df = _days(spark).checkpoint()
    table = sketches.day_sketches(df, ["a", "b", "c"]).checkpoint()
    assert table.count() == 18
    for cut in ("2024-01-02", "2024-01-05"):
        got = {r["feature"]: r for r in sketches.sketch_drift(table, F.col("ds") < cut, F.col("ds") >= cut).collect()}
        stack = "stack(3, 'a', a, 'b', b, 'c', c) AS (feature, value)"
        rows = df.selectExpr("ds", stack).where("value IS NOT NULL")
        rows = rows.select("feature", "value", F.when(F.col("ds") < cut, "ref").otherwise("cur").alias("sample"))
        _, exact = drift.drift_statistics(rows)
        for r in exact.collect():
            g = got[r["feature"]]
            assert (g["n_ref"], g["n_cur"]) == (r["n_ref"], r["n_cur"])
            assert abs(g["ks_stat"] - r["ks_stat"]) <= sketches.drift_error()
        # Of a continuous feature the bins hold the same shares, but for the ranks' error.
        assert abs(got["a"]["psi"] - {r["feature"]: r["psi"] for r in exact.collect()}["a"]) < 0.05
        assert got["c"]["psi"] == 0 and got["c"]["ks_stat"] == 0


def test_ranges_may_overlap_or_be_empty(spark):
    table = sketches.day_sketches(_days(spark), ["a"])
    same = sketches.sketch_drift(table, F.lit(True), F.lit(True)).first()
    assert same["n_ref"] == same["n_cur"] == 6000 and same["ks_stat"] <= sketches.drift_error() and same["psi"] < 0.01
    empty = sketches.sketch_drift(table, F.col("ds") < "2000", F.lit(True)).first()
    assert (empty["n_ref"], empty["n_cur"], empty["psi"], empty["ks_stat"]) == (0, 6000, 0.0, 0.0)
    nan = spark.createDataFrame([("d", float("nan")), ("d", 1.0)], "ds string, a double")
    assert sketches.day_sketches(nan, ["a"]).first()["n"] == 1


def test_quantiles_stay_within_the_rank_error(spark):
    values = np.random.default_rng(2).standard_normal(50_000)
    df = spark.createDataFrame([(f"d{i % 20}", float(v)) for i, v in enumerate(values)], "ds string, a double")
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    got = sketches.sketch_quantiles(sketches.merged(sketches.day_sketches(df, ["a"])), probs).first()["quantiles"]
    assert all(abs((values <= q).mean() - p) <= sketches.rank_error() for q, p in zip(got, probs))


def test_counter_rate_is_a_plain_walk_with_one_row_exchange(spark):
    rng = np.random.default_rng(9)
    rows, value = [], {}
    for i in range(3_000):
        s = int(rng.integers(0, 4))
        value[s] = 0.0 if rng.random() < 0.02 else value.get(s, 0.0) + float(rng.integers(0, 9))
        rows.append((f"s{s}", f"h{s % 2}", i * 700, value[s]))
    df = spark.createDataFrame(rows, "series string, host string, ts_ms long, value double").repartition(5)
    want, last = {}, {}
    for s, h, t, v in rows:
        step = 0.0 if s not in last else v - last[s] if v >= last[s] else v
        last[s] = v
        want[h, t // 300_000 * 300_000] = want.get((h, t // 300_000 * 300_000), 0.0) + step
    out = telemetry.counter_rate(df, ["series", "host"], by=["host"])
    assert {(r["host"], r["window_start"]): r["increase"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning(series") == 2  # rows by (series, window); segments by series
    lone = telemetry.counter_rate(spark.createDataFrame([("a", None, 1.0), ("a", 5, 1.0)], "series string, ts_ms long, value double"), ["series"])
    assert [r["increase"] for r in lone.collect()] == [0.0]
