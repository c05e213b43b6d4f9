"""Positional engine: positions, block-halo windows, running sums, exact quantiles, plan shape."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge.operators.sequence import (
    drop_helpers,
    exact_quantiles,
    ordered_windows,
    rows_frame,
    with_sequence,
)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame(
        {
            "g": rng.choice(["a", "b", None], size=n, p=[0.7, 0.2, 0.1]),  # "a" is a hot group
            "t": rng.integers(0, 500, size=n).astype("int64"),  # many ties in time
            "id": np.arange(n, dtype="int64"),
            "x": rng.normal(size=n),
        }
    )
    pdf.loc[::97, "t"] = None  # NULL times sort last
    return spark.createDataFrame(pdf.astype({"t": "Int64"}))


def test_seq_matches_row_number_across_buckets(spark, frame):
    s = drop_helpers(with_sequence(frame, ["t", "id"], ["g"], rows_per_bucket=97))
    ref = frame.withColumn(
        "ref", F.row_number().over(Window.partitionBy("g").orderBy(F.col("t").asc_nulls_last(), "id")) - 1
    ).withColumn("n_ref", F.count(F.lit(1)).over(Window.partitionBy("g")))
    j = s.join(ref.select("id", "ref", "n_ref"), "id")
    assert j.count() == frame.count()
    assert j.where("seq <> ref or n_group <> n_ref").count() == 0


def test_global_seq_is_permutation(spark, frame):
    s = with_sequence(frame, ["t", "id"], rows_per_bucket=211)
    got = sorted(r[0] for r in s.select("seq").collect())
    assert got == list(range(frame.count()))


def test_block_halo_equals_plain_window(spark, frame):
    s = with_sequence(frame.where("t is not null"), ["t", "id"], ["g"], rows_per_bucket=150)

    def stage(w):
        return {
            "m7": F.avg("x").over(rows_frame(w, 7)),
            "l5": F.lag("x", 5).over(w),
            "f3": F.lead("x", 3).over(w),
            "mx": F.max("x").over(rows_frame(w, 50)),
        }

    got = drop_helpers(ordered_windows(s, [stage], lookback=50, lookahead=3, block_rows=64))
    w = Window.partitionBy("g").orderBy("t", "id")
    ref = frame.where("t is not null").select(
        "id",
        F.avg("x").over(w.rowsBetween(-6, 0)).alias("r_m7"),
        F.lag("x", 5).over(w).alias("r_l5"),
        F.lead("x", 3).over(w).alias("r_f3"),
        F.max("x").over(w.rowsBetween(-49, 0)).alias("r_mx"),
    )
    j = got.join(ref, "id").toPandas()
    assert len(j) == frame.where("t is not null").count()
    for a, b in [("m7", "r_m7"), ("l5", "r_l5"), ("f3", "r_f3"), ("mx", "r_mx")]:
        assert np.allclose(j[a].astype(float), j[b].astype(float), equal_nan=True, atol=1e-12), a


def test_running_sums(spark, frame):
    f = frame.where("t is not null").withColumn("one", F.lit(1.0))
    s = with_sequence(f, ["t", "id"], ["g"], running_sums=["x", "one"], rows_per_bucket=100).toPandas()
    s = s.sort_values(["g", "seq"])
    for _, grp in s.groupby(s["g"].fillna("<null>")):
        assert np.allclose(grp["cum_x"], np.cumsum(grp["x"]), atol=1e-9)
        assert np.allclose(grp["cum_one"], np.arange(1, len(grp) + 1))
        assert np.allclose(grp["total_x"], grp["x"].sum(), atol=1e-9)


def test_exact_quantiles_match_numpy(spark, frame):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = exact_quantiles(frame, "x", probs, ["g"], rows_per_bucket=120).toPandas()
    pdf = frame.toPandas()
    for _, row in q.iterrows():
        vals = pdf.loc[pdf["g"].isna() if row["g"] is None else pdf["g"] == row["g"], "x"].to_numpy()
        assert np.allclose(row["edges"], np.percentile(vals, np.array(probs) * 100), atol=1e-12)


def test_no_single_partition_exchange(spark, frame):
    s = with_sequence(frame, ["t", "id"], ["g"], rows_per_bucket=100)
    plan = ordered_windows(s, [lambda w: {"m": F.avg("x").over(rows_frame(w, 5))}], lookback=5, block_rows=64)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
    assert "_tf_bucket" in text and "_tf_block" in text  # exchanges on (group, bucket) and (group, block)


def test_hot_tie_is_split_and_numbered(spark):
    """A third of all rows share one timestamp: the value is detected as hot, isolated in its own
    bucket and numbered by the next order column; positions still equal row_number."""
    from tickforge.operators.sequence import plan_buckets

    rng = np.random.default_rng(11)
    n = 3000
    t = rng.integers(0, 10_000, size=n)
    t[: n // 3] = 4242  # hot tie
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], size=n, p=[0.8, 0.2]), "t": t, "id": rng.permutation(n), "x": 1.0})
    df = spark.createDataFrame(pdf)
    plan = plan_buckets(df, "t", rows_per_bucket=100)
    assert 4242.0 in plan.hot
    s = drop_helpers(with_sequence(df, ["t", "id"], ["g"], running_sums=["x"], rows_per_bucket=100)).toPandas()
    exp = pdf.sort_values(["g", "t", "id"]).assign(r=lambda d: d.groupby("g").cumcount())
    m = s.merge(exp[["id", "r"]], on="id")
    assert len(m) == n and (m["seq"] == m["r"]).all()
    assert np.allclose(m["cum_x"], m["seq"] + 1) and (s.groupby("g")["total_x"].nunique() == 1).all()


def test_many_evenly_spaced_quantiles(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.full(500, 3.0), rng.normal(size=700)])  # heavy ties
    probs = list(np.linspace(0, 1, 257))
    q = exact_quantiles(spark.createDataFrame(pd.DataFrame({"v": x})), "v", probs, rows_per_bucket=50).collect()[0]
    assert np.allclose(q["edges"], np.percentile(x, np.array(probs) * 100), atol=1e-12)


def test_approx_quantiles_close_to_exact(spark):
    from tickforge.operators.sequence import approx_quantiles

    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 20_000, p=[0.9, 0.1]), "v": rng.normal(size=20_000)})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.g: r.edges for r in approx_quantiles(df, "v", probs, ["g"], accuracy=10_000).collect()}
    for g, vals in pdf.groupby("g")["v"]:
        ranks = np.searchsorted(np.sort(vals.to_numpy()), got[g]) / len(vals)
        assert np.all(np.abs(ranks - np.array(probs)) <= 2e-3 + 1.0 / len(vals))


def test_positions_of_integers_beyond_doubles(spark):
    # Nanosecond stamps: neighbours share a double; a third of the rows share one stamp.
    rows = [(1_700_000_000_000_000_000 + (i % 40 if i % 3 else 7), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "ts long, id long")
    out = with_sequence(df, ["ts", "id"], rows_per_bucket=200)
    assert [(r["ts"], r["id"]) for r in out.orderBy("seq").collect()] == sorted(rows)
    assert sorted(r["seq"] for r in out.select("seq").collect()) == list(range(4000))


def test_constant_leading_key_is_split_by_the_next(spark):
    rows = [(5, float("nan") if i % 10 == 0 else float(i % 97), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "day long, value double, id long")
    out = with_sequence(df, ["day", "value", "id"], rows_per_bucket=200)
    got = [r["id"] for r in out.orderBy("seq").collect()]
    want = [i for _, _, i in sorted((x for x in rows if x[1] == x[1]), key=lambda x: x[1:])] + [i for _, v, i in rows if v != v]
    assert got == want


def test_wide_quantiles_match_the_long_form(spark, monkeypatch):
    """Many columns at once, in several chunks and ranges: NULL, NaN, -0.0, hot and absent values."""
    from tickforge.operators import sequence

    monkeypatch.setattr(sequence, "WIDE_CELLS", 200)
    rng = np.random.default_rng(1)
    rows = [
        (float(a), int(i % 3), None if i % 7 == 0 else float("nan") if i % 50 == 0 else float(c), None, -0.0 if i % 2 else 0.0)
        for i, (a, c) in enumerate(rng.normal(size=(600, 2)).round(2))
    ]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double, z double").repartition(3)
    long = df.selectExpr("stack(5, 'a', a, 'b', CAST(b AS DOUBLE), 'c', c, 'd', d, 'z', z) AS (feature, v)")
    for probs, size in (([0.0, 0.5, 1.0], 2_000_000), ([i / 99 for i in range(100)], 90)):
        want = {r["feature"]: str((r["edges"], r["n_values"])) for r in exact_quantiles(long, "v", probs, ["feature"]).collect()}
        got = sequence.exact_quantiles_wide(df, df.columns, probs, rows_per_bucket=size).collect()
        assert {r["feature"]: str((r["edges"], r["n_values"])) for r in got} == want and set(want) == {"a", "b", "c", "z"}
    assert sequence.exact_quantiles_wide(df.limit(0), ["a"], [0.5]).collect() == []
