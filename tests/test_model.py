"""Quantile transform, codes, metrics, pruning and promotion rules."""

import numpy as np
import pandas as pd

from tickforge.operators import model as mdl


def test_transform_matches_interp_definition(spark):
    x = np.array([1, 1, 1, 2, 2, 3, 5, 8, 8, 8, 13, 21, 21], dtype=float)  # repeated knots
    df = spark.createDataFrame(pd.DataFrame({"v": x, "id": range(len(x))}))
    knots = mdl.collect_knots(mdl.fit_quantile_knots(df, ["v"], n_quantiles=7))
    k = np.array(knots["v"])
    assert np.allclose(k, np.percentile(x, np.linspace(0, 100, 7)))
    got = mdl.apply_quantile_transform(df, knots, "_q").orderBy("id").toPandas()["v_q"].to_numpy()
    refs = np.linspace(0, 1, 7)
    exp = 0.5 * (np.interp(x, k, refs) - np.interp(-x, -k[::-1], -refs[::-1]))
    exp[x == k[0]] = 0.0
    exp[x == k[-1]] = 1.0
    assert np.allclose(got, exp)
    assert got.min() >= 0 and got.max() <= 1


def test_codes(spark):
    df = spark.createDataFrame([(0.1,), (2.5 / 255,), (3.5 / 255,), (1.2,), (-0.5,)], "v double")
    u8 = [r[0] for r in mdl.quantize(df, ["v"], "u8").collect()]
    assert u8 == [26, 2, 4, 255, 0]  # half-even: 2.5 -> 2, 3.5 -> 4; clipped
    tr = [r[0] for r in mdl.quantize(df, ["v"], "trunc").collect()]
    assert tr[0] == 25 and tr[3] == 306


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(100, 5, 200)
    p = y + rng.normal(0, 1, 200)
    m = mdl.regression_metrics(spark.createDataFrame(pd.DataFrame({"actual": y, "predicted": p}))).collect()[0]
    assert m["rmse"] == round(float(np.sqrt(np.mean((y - p) ** 2))), 4)
    assert m["mae"] == round(float(np.mean(np.abs(y - p))), 4)
    assert abs(m["r2"] - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-4
    assert abs(m["mape_pct"] - np.mean(np.abs((y - p) / (y + 1e-9))) * 100) < 1e-4


def test_pruning_rules(spark):
    imp = spark.createDataFrame([("a", 1.0), ("b", 0.005), ("c", 0.02), ("d", 0.5)], "feature string, importance double")
    kept = {r.feature for r in mdl.prune_by_max_share(imp).where("keep").collect()}
    assert kept == {"a", "c", "d"}
    neg = spark.createDataFrame([(f"f{i}", -1.0 - i) for i in range(20)], "feature string, importance double")
    assert mdl.prune_by_max_share(neg).where("keep").count() in (15, 20)
    mean_kept = {r.feature for r in mdl.prune_by_mean(imp).where("keep").collect()}
    assert mean_kept == {"a", "d"}
    assert [r.feature for r in mdl.top_n(imp, 2).collect()] == ["a", "d"]


def test_promotion(spark):
    runs = spark.createDataFrame(
        [("r1", 1, 0.5), ("r2", 2, 0.1), ("r3", 3, 0.3), ("r4", 4, 0.9)], "run_id string, trained_at int, r2 double"
    )
    st = {r.run_id: r.stage for r in mdl.promotion(runs).collect()}
    assert st == {"r1": "Archived", "r2": "None", "r3": "Archived", "r4": "Production"}


def test_gbt_fit_and_score(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"x": rng.normal(size=400), "z": rng.normal(size=400)})
    pdf["target_y"] = 3 * pdf["x"] + 0.1 * rng.normal(size=400)
    df = spark.createDataFrame(pdf)
    model = mdl.fit_gbt(df, ["x", "z"], maxIter=20)
    pred = model.transform(df)
    m = mdl.regression_metrics(pred, "target_y", "prediction").collect()[0]
    assert m["r2"] > 0.9
    imp = mdl.tree_importances(model, ["x", "z"]).orderBy("importance", ascending=False).first()
    assert imp.feature == "x"
    pi = mdl.permutation_importance(model, df.withColumn("seq", __import__("pyspark.sql.functions", fromlist=["F"]).monotonically_increasing_id()),
                                    ["x", "z"], n_rows=400, repeats=2)
    top = pi.orderBy("importance", ascending=False).first()
    assert top.feature == "x" and top.importance > 0.5


def test_permutation_keeps_every_row_once_when_positions_repeat(spark):
    from pyspark.sql import functions as F

    from tickforge.operators.model import permutation_importance

    seen = []

    class Linear:
        def transform(self, df):
            if "repeat" in df.columns:
                seen.append(df.groupBy("feature", "repeat").agg(F.count("*").alias("n"), F.countDistinct("_row").alias("rows"), F.sum("a").alias("a")).collect())
            return df.withColumn("prediction", 2.0 * F.col("a"))

    # Five groups, each with its own positions 0..39.
    rows = [(i, float(i * 5 + g), float(g), 2.0 * (i * 5 + g)) for g in range(5) for i in range(40)]
    sample = spark.createDataFrame(rows, "seq long, a double, b double, target_y double")
    out = {r["feature"]: r["importance"] for r in permutation_importance(Linear(), sample, ["a", "b"], repeats=3).collect()}
    assert all(r["n"] == r["rows"] == 200 and r["a"] == sum(x[1] for x in rows) for r in seen[0]) and len(seen[0]) == 6
    assert out["b"] == 0 and 1 < out["a"] < 3  # a random order leaves R^2 near -1


def test_permutation_scores_the_whole_sample(spark):
    """A feature that matters only beyond the first 1,000 positions of each group."""
    from pyspark.sql import functions as F

    seen = []

    class Linear:
        def transform(self, df):
            seen.append(df)
            return df.withColumn("prediction", F.col("a") + F.col("late"))

    rows = [(i, float(i % 7), float(i % 11) if i >= 1000 else 0.0) for _ in range(2) for i in range(1500)]  # rows repeat, too
    sample = spark.createDataFrame(rows, "seq long, a double, late double").withColumn("target_y", F.col("a") + F.col("late"))
    out = {r["feature"]: r["importance"] for r in mdl.permutation_importance(Linear(), sample, ["a", "late"]).collect()}
    assert out["late"] > 0.5 and out["a"] > 0.1
    perm = seen[-1].groupBy("feature", "repeat").agg(F.count("*").alias("n"), F.countDistinct("_row").alias("rows"), F.sum("late").alias("s")).collect()
    assert len(perm) == 6 and all((r["n"], r["rows"], r["s"]) == (3000, 3000, sum(x[2] for x in rows)) for r in perm)
    orders = {tuple(r["late"] for r in seen[-1].where(f"feature = 'late' AND repeat = {k}").orderBy("_row").collect()) for k in range(3)}
    assert len(orders) == 3  # another order each time


def test_fit_deals_rows_to_few_tasks(spark, monkeypatch):
    """A fit is hundreds of jobs, each with a task a partition: their number follows the rows and
    the cores, not the partitions that the rows come in."""
    assert [mdl.fit_tasks(n, 12) for n in (0, 1, 20_000, 20_001, 80_000, 5_000_000, 50_000_000)] == [1, 1, 1, 2, 4, 12, 50]
    seen = []
    fit = mdl.Pipeline.fit
    monkeypatch.setattr(mdl.Pipeline, "fit", lambda self, df, *a: seen.append((df.rdd.getNumPartitions(), df.count())) or fit(self, df, *a))
    df = spark.range(0, 400, 1, 40).selectExpr("cast(id % 20 as double) AS x", "cast(id AS double) AS other", "id % 20 * 2.0D AS target_y")
    model = mdl.fit_gbt(df, ["x"], maxIter=2, minInstancesPerNode=1)
    assert seen == [(1, 400)]
    assert model.stages[-1].numFeatures == 1


def test_matrix_input_is_read_as_often_however_many_jobs_use_it(spark):
    """Positions and targets are made once: the count, the knots and the codes read one copy."""
    from pyspark.sql import functions as F

    read = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = spark.range(0, 400, 1, 4).selectExpr("id AS trade_id", "id AS timestamp", "CAST(id % 17 AS DOUBLE) AS price", "CAST(id % 5 AS DOUBLE) AS x")
    matrix, knots = mdl.prepare_matrix(rows.mapInArrow(watch, rows.schema), ["x", "price"])
    before = read.value
    assert before <= 400 * 3  # the plan of the buckets, their counts and the numbering
    assert matrix.count() == 399 and matrix.agg(F.max("x")).first()[0] == 255 and set(knots) == {"x", "price"}
    assert read.value == before
