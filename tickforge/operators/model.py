"""Feature-matrix and forecast-model operators.

The matrix stays a wide DataFrame; ``VectorAssembler`` appears only at the Spark ML boundary.
Quantile knots are fitted exactly and in one distributed pass for all columns; the transform is
an Arrow ``pandas_udf`` (``np.interp``) with the knots of each column closed over by name.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.columns import code_trunc, code_u8
from tickforge.operators.sequence import approx_quantiles, content_hash, drop_helpers, exact_quantiles_wide, with_sequence

# Transform knots, model hyper-parameters, pruning and promotion defaults.
MAX_KNOTS = 1000
GBT_PARAMS = {"maxIter": 150, "stepSize": 0.08, "maxDepth": 5, "minInstancesPerNode": 20, "maxBins": 256, "seed": 42}
MIN_TRAIN_ROWS = 50
PERM_REPEATS = 3
PRUNE_SHARE_OF_MAX = 0.01
PRUNE_FALLBACK_TOP = 15
MIN_R2_PROMOTE = 0.20
BAND_PCT = 0.015
EPS = 1e-9
# Training rows of one task of a fit: below the first number a task costs more than its rows, and
# the second bounds what a task keeps in memory.
FIT_ROWS_PER_TASK, FIT_MAX_ROWS_PER_TASK = 20_000, 1_000_000


# --------------------------------------------------------------------------- M1 quantile transform


def fit_quantile_knots(
    df: DataFrame, columns: Sequence[str], n_quantiles: int | None = None, *, method: str = "exact",
    accuracy: int = 10_000, **seq_kw,
) -> DataFrame:
    """M1 fit: ``n_quantiles`` (default min(1000, rows)) linear-interpolation quantiles of every
    column, all columns in the same jobs; ``method="approx"`` uses one sketch aggregate instead of
    exact order statistics. Returns (feature, knots array<double>)."""
    cols = list(columns)
    if n_quantiles is None:
        n_quantiles = min(MAX_KNOTS, df.count())
    n_quantiles = max(int(n_quantiles), 2)
    probs = [float(p) for p in np.linspace(0.0, 1.0, n_quantiles)]
    if method == "approx":
        stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
        long = df.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, value)")
        knots = approx_quantiles(long, "value", probs, ["feature"], out_col="knots", accuracy=accuracy)
    elif method == "exact":
        knots = exact_quantiles_wide(df, cols, probs, out_col="knots", **seq_kw)
    else:
        raise ValueError(f"method must be 'exact' or 'approx', got {method!r}")
    # The fitted knots must be non-decreasing (guards interpolation rounding).
    return knots.select("feature", F.expr("transform(knots, (x, i) -> array_max(slice(knots, 1, i + 1)))").alias("knots"))


def collect_knots(knots: DataFrame) -> dict[str, list[float]]:
    """Knots are at most 1000 doubles per feature: a bounded table, safe to hold on the driver."""
    return {r["feature"]: list(r["knots"]) for r in knots.collect()}


def uniform_transform_np(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Uniform quantile transform of one column: mean of forward and reverse interpolation (so
    repeated knots map to their middle), 0 at the lowest and 1 at the highest knot."""
    refs = np.linspace(0.0, 1.0, len(knots))
    out = np.full(x.shape, np.nan)
    ok = ~np.isnan(x)
    xf = x[ok]
    out[ok] = 0.5 * (np.interp(xf, knots, refs) - np.interp(-xf, -knots[::-1], -refs[::-1]))
    out[x == knots[-1]] = 1.0
    out[x == knots[0]] = 0.0
    return out


def _transform_udf(knots: list[float]):
    arr = np.asarray(knots, dtype=float)

    @F.pandas_udf("double")
    def qt(s: pd.Series) -> pd.Series:
        return pd.Series(uniform_transform_np(s.to_numpy(dtype=float, na_value=np.nan), arr))

    return qt


def apply_quantile_transform(df: DataFrame, knots: dict[str, list[float]], suffix: str = "") -> DataFrame:
    """M1 apply by column name (so a pruned subset can be transformed, Q17)."""
    return df.withColumns({f"{c}{suffix}": _transform_udf(k)(F.col(c).cast("double")) for c, k in knots.items()})


def quantize(df: DataFrame, columns: Sequence[str], mode: str = "u8", suffix: str = "") -> DataFrame:
    """M2 (``u8``: clip(round-half-even(x*255)))/ M3 (``trunc``: int(x*255)) codes."""
    fn = code_u8 if mode == "u8" else code_trunc
    return df.withColumns({f"{c}{suffix}": fn(F.col(c)) for c in columns})


# --------------------------------------------------------------------------- M4 matrix, M10 metrics


def prepare_matrix(
    df: DataFrame,
    feature_cols: Sequence[str],
    *,
    target_col: str = "price",
    horizon: int = 1,
    order_cols: Sequence[str] = ("timestamp", "trade_id"),
    group_cols: Sequence[str] = (),
    n_quantiles: int | None = None,
    fit_on: str = "train",
    test_ratio: float = 0.2,
    min_rows: int = MIN_TRAIN_ROWS,
) -> tuple[DataFrame, dict[str, list[float]]]:
    """M4: drop rows with NULL features/target, target = next value (h = 1) or log return over
    ``h`` rows, temporal split, quantile transform fitted on ``fit_on`` rows, 8-bit codes.
    Returns (matrix with ``seq, split, target_y`` and coded features, knots)."""
    from tickforge.operators.sequence import ordered_windows

    feats = list(feature_cols)
    clean = df.na.drop(subset=[*feats, target_col])
    s = with_sequence(clean, order_cols, group_cols)

    def stage(w):
        lead = F.lead(target_col, horizon).over(w)
        y = lead if horizon == 1 else F.log(F.try_divide(lead, F.col(target_col)))
        return {"target_y": y}

    # Dropping the last ``horizon`` rows of a group keeps every other row's position.
    s2 = drop_helpers(ordered_windows(s, [stage], lookahead=horizon)).where(F.col("target_y").isNotNull())
    s2 = s2.withColumn("n_group", F.greatest(F.col("n_group") - F.lit(horizon), F.lit(0)))
    # Counted, fitted and coded from one copy: positions and targets are windows over wide rows.
    s2 = s2.checkpoint()
    n_total = s2.count()
    if n_total < min_rows:
        raise ValueError("Insufficient rows for model training after dropna.")
    bound = F.floor(F.col("n_group").cast("double") * F.lit(1.0 - test_ratio))
    m = s2.withColumn("split", F.when(F.col("seq") < bound, "train").otherwise("test"))
    fit_rows = m.where(F.col("split") == "train") if fit_on == "train" else m
    knots = collect_knots(fit_quantile_knots(fit_rows, feats, n_quantiles))
    coded = quantize(apply_quantile_transform(m, knots, suffix="__q"), [f"{c}__q" for c in feats], "u8")
    coded = coded.drop(*feats).withColumnsRenamed({f"{c}__q": c for c in feats})
    return coded, knots


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R^2 = 1 - SSE/SST (SST from the population variance), MAPE % with a
    1e-9 guard; all rounded to 4 digits. One aggregate; grouped by a model label it is the
    full-versus-pruned comparison (M15)."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = y - p
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("_sse"),
        F.avg(F.abs(e)).alias("_mae"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
        F.avg(F.abs(e / (y + F.lit(EPS)))).alias("_mape"),
    )
    r2 = F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, 1.0).otherwise(0.0)).otherwise(
        F.lit(1.0) - F.col("_sse") / F.col("_sst")
    )
    return agg.select(
        *group_cols,
        F.round(F.sqrt(F.col("_sse") / F.col("n")), 4).alias("rmse"),
        F.round("_mae", 4).alias("mae"),
        F.round(r2, 4).alias("r2"),
        F.round(F.col("_mape") * 100.0, 4).alias("mape_pct"),
    )


def prediction_errors(df: DataFrame, actual: str = "price", predicted: str = "predicted_price") -> DataFrame:
    """error = actual - predicted, absolute error, error % (4 digits)."""
    err = F.col(actual) - F.col(predicted)
    return df.withColumns(
        {
            "error": err,
            "abs_error": F.abs(err),
            "error_pct": F.round(F.try_divide(err, F.col(actual)) * 100.0, 4),
        }
    )


def prediction_band(pred: Column, band_pct: float = BAND_PCT) -> Column:
    """Fixed +-1.5% envelope (not a statistical interval), rounded to 2 digits."""
    return F.array(F.round(pred * (1.0 - band_pct), 2), F.round(pred * (1.0 + band_pct), 2))


# --------------------------------------------------------------------------- M5-M9 boosting


def fit_tasks(n_rows: int, cores: int) -> int:
    """Tasks of a boosting step over ``n_rows`` rows: one a core at most, unless their rows would be
    too many to keep, and fewer for few rows."""
    by_cores = min(max(1, cores), math.ceil(n_rows / FIT_ROWS_PER_TASK))
    return max(1, by_cores, math.ceil(n_rows / FIT_MAX_ROWS_PER_TASK))


def fit_gbt(train: DataFrame, feature_cols: Sequence[str], label: str = "target_y", **params) -> PipelineModel:
    """M5 / M9: gradient-boosted regression trees (Spark ML) on the given columns; the refit on
    the kept features after pruning is the same call on the pruned column list.

    Each level of each tree is a job of two stages (750 jobs for 150 trees of depth 5), and every
    task sends the histograms of all nodes and features: the rows are dealt evenly to as many tasks
    as they need, whatever partitions they come in."""
    p = {**GBT_PARAMS, **params}
    cols = list(feature_cols)
    tasks = fit_tasks(train.count(), train.sparkSession.sparkContext.defaultParallelism)
    rows = train.select(*dict.fromkeys([label, *cols])).repartition(tasks)
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", **p)
    return Pipeline(stages=[assembler, gbt]).fit(rows)


def tree_importances(model: PipelineModel, feature_cols: Sequence[str]) -> DataFrame:
    """Split-gain importances of the fitted trees as a (feature, importance) table."""
    from pyspark.sql import SparkSession

    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(feature_cols, [float(v) for v in imp])), "feature string, importance double")


def permutation_importance(
    model: PipelineModel,
    sample: DataFrame,
    feature_cols: Sequence[str],
    *,
    label: str = "target_y",
    seq_col: str = "seq",
    n_rows: int | None = None,
    repeats: int = PERM_REPEATS,
    seed: int = 42,
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """M6: R^2 drop when one feature is shuffled, mean over ``repeats``; all rows of ``sample``
    (``n_rows``: only the first positions). Returns (feature, importance).

    Boosted trees are scored by delta (:mod:`tickforge.operators.importance`): only the trees that
    split on the shuffled feature run again. Any other model with ``transform`` scores a copy of the
    rows a (feature, repeat): rows are numbered (by ``order_cols``, then content), in each repeat
    numbered again by a seeded hash, and the row at position i lends its values to row i."""
    from tickforge.operators import importance

    feats = list(feature_cols)
    rows = sample if n_rows is None else sample.where(F.col(seq_col) < n_rows)
    if isinstance(model, PipelineModel) and isinstance(model.stages[-1], GBTRegressionModel):
        return importance.delta_importance(
            importance.flatten(model), rows, feats, label=label, order_cols=order_cols, repeats=repeats, seed=seed
        )
    # Positions may repeat (one sequence a group): number the rows of the sample themselves.
    order = [f"_o{i}" for i in range(len(order_cols))]
    rows = rows.withColumn("_hash", content_hash(rows, rows.columns))
    rows = rows.select(*[F.col(c).alias(o) for c, o in zip(order_cols, order)], "_hash", label, *feats)
    base = drop_helpers(with_sequence(rows, [*order, "_hash"], seq_col="_row")).drop("n_group", "_hash", *order).checkpoint()
    lent = base.select(
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"), F.col("_row").alias("_src"),
        *[F.col(c).cast("double").alias(f"_lent_{i}") for i, c in enumerate(feats)],
    ).withColumn("_hash", F.xxhash64("_src", "repeat", F.lit(seed)))
    lent = drop_helpers(with_sequence(lent, ["_hash", "_src"], ["repeat"], seq_col="_row")).drop("n_group", "_hash", "_src")
    perm = base.join(lent, "_row").withColumn("feature", F.explode(F.array(*[F.lit(c) for c in feats])))
    perm = perm.select(
        "_row", "repeat", "feature", label,
        *[F.when(F.col("feature") == c, F.col(f"_lent_{i}")).otherwise(F.col(c)).alias(c) for i, c in enumerate(feats)],
    )
    base_r2 = _r2(model.transform(base), label).first()[0]
    per_copy = _r2(model.transform(perm), label, ["feature", "repeat"])
    return per_copy.groupBy("feature").agg((F.lit(base_r2) - F.avg("r2")).alias("importance"))


def _r2(scored: DataFrame, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Unrounded R^2 of ``prediction`` against ``label``."""
    sse = F.sum(F.pow(F.col(label) - F.col("prediction"), 2))
    sst = F.var_pop(label) * F.count(F.lit(1))
    return scored.groupBy(*group_cols).agg(F.when(sst == 0, F.lit(0.0)).otherwise(1 - sse / sst).alias("r2"))


def prune_by_max_share(importance: DataFrame, share: float = PRUNE_SHARE_OF_MAX, fallback_top: int = PRUNE_FALLBACK_TOP) -> DataFrame:
    """M7: keep features with importance >= share * max; if none, the best ``fallback_top``."""
    mx = importance.agg(F.max("importance")).first()[0]
    if mx is None:
        return importance.withColumn("keep", F.lit(False))
    tagged = importance.withColumn("keep", F.col("importance") >= F.lit(mx * share))
    if tagged.where("keep").limit(1).count() > 0:
        return tagged
    # The importance table has one row per feature: a bounded window.
    rank = F.row_number().over(Window.orderBy(F.col("importance").desc(), F.col("feature")))
    return tagged.withColumn("keep", rank <= fallback_top)


def prune_by_mean(importance: DataFrame) -> DataFrame:
    """M8 (+A9): keep features with importance >= the mean importance."""
    mean = importance.agg(F.avg("importance")).first()[0]
    return importance.select("feature", "importance", (F.col("importance") >= F.lit(mean)).alias("keep"))


def top_n(importance: DataFrame, n: int = 20) -> DataFrame:
    """Top-``n`` by importance (ties by name)."""
    return importance.orderBy(F.col("importance").desc(), F.col("feature")).limit(n)


# --------------------------------------------------------------------------- M17, M18


@dataclass
class FittedPipeline:
    model: PipelineModel
    knots: dict[str, list[float]]
    feature_cols: list[str]
    pruned_cols: list[str]
    metrics: dict[str, float] = field(default_factory=dict)

    def save(self, path: str) -> None:
        """Spark ML model + JSON metadata (knots by column name, column lists, metrics)."""
        from pyspark.sql import SparkSession

        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        meta = {"feature_cols": self.feature_cols, "pruned_cols": self.pruned_cols, "metrics": self.metrics,
                "knots": self.knots}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> FittedPipeline:
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        model = PipelineModel.load(f"{path}/model")
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(model, meta["knots"], meta["feature_cols"], meta["pruned_cols"], meta.get("metrics", {}))


def promotion(runs: DataFrame, min_r2: float = MIN_R2_PROMOTE, run_col: str = "run_id", time_col: str = "trained_at") -> DataFrame:
    """A run passes when r2 >= ``min_r2``; the newest passing run is 'Production', older
    passing runs 'Archived', failing runs 'None'."""
    ok = F.col("r2") >= min_r2
    newest = F.row_number().over(Window.partitionBy(ok).orderBy(F.col(time_col).desc(), F.col(run_col).desc()))
    return runs.withColumn("promoted", ok).withColumn(
        "stage", F.when(~ok, "None").when(newest == 1, "Production").otherwise("Archived")
    )


def score(
    features: DataFrame,
    fitted: FittedPipeline,
    *,
    id_col: str = "trade_id",
    version: str = "local",
    present: str | None = None,
) -> DataFrame:
    """Align to the pruned columns (missing -> 0.0, P10), transform by name,
    code, predict; price and band rounded to 2 digits. Raw trades go through the feature builder
    first (M11); vectors from the online table (J1) are scored as they are (M12). Where the flag
    column ``present`` is not true there is no vector, and neither price nor band."""
    from tickforge.operators.online import align_columns

    cols = fitted.pruned_cols
    aligned = align_columns(features, cols, keep=[id_col, *([present] if present else [])])
    knots = {c: fitted.knots[c] for c in cols if c in fitted.knots}
    coded = quantize(apply_quantile_transform(aligned, knots), list(knots), "u8")
    pred = fitted.model.transform(coded)
    there = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    return pred.select(
        F.col(id_col),
        F.when(there, F.round("prediction", 2)).alias("predicted_price"),
        F.when(there, prediction_band(F.col("prediction"))).alias("confidence_interval_95"),
        F.lit(version).alias("model_version"),
    )
