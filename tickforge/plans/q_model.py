"""Queries: quantile transform and codes, forecast metrics, pruning rules, promotion, online
table and lookup, and the model train/score flows (M1-M18, K7, J1, O2-O5, P9, P10)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators import features as feat
from tickforge.operators import model as mdl
from tickforge.operators import online
from tickforge.operators.sequence import drop_helpers, ordered_windows, rows_frame, with_sequence
from tickforge.plans.registry import register
from tickforge.plans.rounding import fround, sql_fround
from tickforge.plans.sql_tapes import E_TAPE, with_tapes
from tickforge.session import scratch_dir
from tickforge.sources import versions
from tickforge.sources.tapes import EVENTS_ORDER, tape_events

N_KNOTS = 11
_PROBS = [float(p) for p in np.linspace(0.0, 1.0, N_KNOTS)]
_PROB_LIST = "[" + ", ".join(f"CAST({p!r} AS DOUBLE)" for p in _PROBS) + "]"
_STEP = f"CAST(1.0 / {N_KNOTS - 1} AS DOUBLE)"


def _ref(i: str) -> str:
    """numpy ``linspace(0, 1, n)[i-1]`` (1-based ``i``): ``(i - 1) * step``, last exactly 1."""
    return f"(CASE WHEN ({i}) = {N_KNOTS} THEN 1.0 ELSE CAST(({i}) - 1 AS DOUBLE) * {_STEP} END)"


def _qt_sql(x: str, k: str) -> str:
    """Uniform quantile transform of ``x`` against knots list ``k`` (mean of the forward and the
    reverse ``np.interp``), 0 / 1 at the end knots."""
    n = N_KNOTS
    jf = f"len(list_filter({k}[1:{n - 1}], lambda e: e <= {x}))"
    fwd = (
        f"(({_ref(f'{jf} + 1')} - {_ref(jf)}) / ({k}[{jf} + 1] - {k}[{jf}]) * ({x} - {k}[{jf}]) + {_ref(jf)})"
    )
    jr = f"len(list_filter({k}[2:{n}], lambda e: e >= {x}))"
    # reversed arrays: xp'[i] = -k[n+1-i], fp'[i] = -ref(n+1-i)
    xp_j, xp_j1 = f"(-{k}[{n + 1} - {jr}])", f"(-{k}[{n} - {jr}])"
    fp_j, fp_j1 = f"(-{_ref(f'{n + 1} - {jr}')})", f"(-{_ref(f'{n} - {jr}')})"
    rev = f"(({fp_j1} - {fp_j}) / ({xp_j1} - {xp_j}) * ((-{x}) - {xp_j}) + {fp_j})"
    return f"(CASE WHEN {x} <= {k}[1] THEN 0.0 WHEN {x} >= {k}[{n}] THEN 1.0 ELSE 0.5 * ({fwd} - {rev}) END)"


_QT_BASE = (
    with_tapes(E_TAPE)
    + f"""
, k AS (SELECT quantile_cont(price, {_PROB_LIST}) AS kp, quantile_cont(quantity, {_PROB_LIST}) AS kq FROM e),
t AS (SELECT trade_id, {_qt_sql("price", "kp")} AS price_q, {_qt_sql("quantity", "kq")} AS quantity_q FROM e, k)"""
)


def _qt(spark, sf):
    t = tape_events(spark, sf)
    knots = mdl.collect_knots(mdl.fit_quantile_knots(t, ["price", "quantity"], n_quantiles=N_KNOTS))
    return mdl.apply_quantile_transform(t, knots, suffix="_q")


@register(
    "quantile_transform",
    "M1",
    _QT_BASE + f"\nSELECT trade_id, {sql_fround('price_q')} AS price_q, {sql_fround('quantity_q')} AS quantity_q FROM t",
)
def q_quantile_transform(spark, sf):
    return _qt(spark, sf).select("trade_id", fround("price_q").alias("price_q"), fround("quantity_q").alias("quantity_q"))


@register(
    "quantize_u8",
    "M2 E1",
    _QT_BASE
    + """
SELECT trade_id, CAST(least(greatest(round_even(price_q * 255.0, 0), 0), 255) AS BIGINT) AS price_code,
       CAST(least(greatest(round_even(quantity_q * 255.0, 0), 0), 255) AS BIGINT) AS quantity_code
FROM t""",
)
def q_quantize_u8(spark, sf):
    c = mdl.quantize(_qt(spark, sf), ["price_q", "quantity_q"], "u8")
    return c.select("trade_id", F.col("price_q").cast("bigint").alias("price_code"),
                    F.col("quantity_q").cast("bigint").alias("quantity_code"))


@register(
    "truncated_code",
    "M3",
    _QT_BASE
    + """
SELECT trade_id, CAST(trunc(price_q * 255.0) AS BIGINT) AS price_code, CAST(trunc(quantity_q * 255.0) AS BIGINT) AS quantity_code
FROM t""",
)
def q_truncated_code(spark, sf):
    c = mdl.quantize(_qt(spark, sf), ["price_q", "quantity_q"], "trunc")
    return c.select("trade_id", F.col("price_q").cast("bigint").alias("price_code"),
                    F.col("quantity_q").cast("bigint").alias("quantity_code"))


# --------------------------------------------------------------------------- forecasts and metrics


def _forecasts(spark, sf):
    """Naive forecasts per symbol: previous price, mean of the 5 previous prices, mean of the
    last 5 prices including the current one."""
    s = with_sequence(tape_events(spark, sf), EVENTS_ORDER, ["symbol"])

    def stage(w):
        return {
            "pred_lag1": F.lag("price", 1).over(w),
            "pred_mean5_prev": F.avg("price").over(w.rowsBetween(-5, -1)),
            "pred_mean5": F.avg("price").over(rows_frame(w, 5)),
        }

    return drop_helpers(ordered_windows(s, [stage], lookback=5))


_FC_SQL = (
    with_tapes(E_TAPE)
    + """
, f AS (SELECT *, lag(price, 1) OVER w AS pred_lag1,
               avg(price) OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS pred_mean5_prev,
               avg(price) OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS pred_mean5
        FROM e WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp", trade_id))"""
)


def _metrics_sql(y: str, p: str) -> str:
    return f"""round(sqrt(avg(({y} - {p}) * ({y} - {p}))), 4) AS rmse, round(avg(abs({y} - {p})), 4) AS mae,
       round(CASE WHEN var_pop({y}) = 0 THEN (CASE WHEN sum(({y} - {p}) * ({y} - {p})) = 0 THEN 1.0 ELSE 0.0 END)
                  ELSE 1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count(*)) END, 4) AS r2,
       round(avg(abs(({y} - {p}) / ({y} + 1e-9))) * 100.0, 4) AS mape_pct"""


@register(
    "regression_metrics",
    "M10",
    _FC_SQL + f"\nSELECT symbol, {_metrics_sql('price', 'pred_lag1')} FROM f WHERE pred_lag1 IS NOT NULL GROUP BY symbol",
)
def q_regression_metrics(spark, sf):
    f = _forecasts(spark, sf).where(F.col("pred_lag1").isNotNull())
    return mdl.regression_metrics(f, "price", "pred_lag1", ["symbol"])


@register(
    "prediction_errors",
    "M14 K8",
    _FC_SQL
    + """
SELECT trade_id, "timestamp", price, pred_lag1 AS predicted_price, price - pred_lag1 AS error, abs(price - pred_lag1) AS abs_error,
       round((price - pred_lag1) / price * 100.0, 4) AS error_pct
FROM f WHERE pred_lag1 IS NOT NULL""",
)
def q_prediction_errors(spark, sf):
    f = _forecasts(spark, sf).where(F.col("pred_lag1").isNotNull())
    f = f.select("trade_id", "timestamp", "price", F.col("pred_lag1").alias("predicted_price"))
    return mdl.prediction_errors(f)


@register(
    "model_comparison",
    "M15",
    _FC_SQL
    + f"""
, l AS (SELECT 'lag1' AS model, price AS y, pred_lag1 AS p FROM f WHERE pred_lag1 IS NOT NULL AND pred_mean5_prev IS NOT NULL
        UNION ALL
        SELECT 'mean5_prev', price, pred_mean5_prev FROM f WHERE pred_lag1 IS NOT NULL AND pred_mean5_prev IS NOT NULL)
SELECT model, {_metrics_sql('y', 'p')} FROM l GROUP BY model""",
)
def q_model_comparison(spark, sf):
    f = _forecasts(spark, sf).where(F.col("pred_lag1").isNotNull() & F.col("pred_mean5_prev").isNotNull())
    long = f.select("price", F.explode(F.array(
        F.struct(F.lit("lag1").alias("model"), F.col("pred_lag1").alias("p")),
        F.struct(F.lit("mean5_prev").alias("model"), F.col("pred_mean5_prev").alias("p")),
    )).alias("m")).select("price", "m.model", "m.p")
    return mdl.regression_metrics(long, "price", "p", ["model"])


@register(
    "promotion_rule",
    "M18",
    _FC_SQL
    + f"""
, runs AS (SELECT symbol AS run_id, max("timestamp") AS trained_at, {_metrics_sql('price', 'pred_mean5')} FROM f GROUP BY symbol)
SELECT run_id, trained_at, r2, r2 >= 0.2 AS promoted,
       CASE WHEN NOT (r2 >= 0.2) THEN 'None'
            WHEN row_number() OVER (PARTITION BY r2 >= 0.2 ORDER BY trained_at DESC, run_id DESC) = 1 THEN 'Production'
            ELSE 'Archived' END AS stage
FROM runs""",
)
def q_promotion_rule(spark, sf):
    f = _forecasts(spark, sf)
    m = mdl.regression_metrics(f, "price", "pred_mean5", ["symbol"])
    t = f.groupBy("symbol").agg(F.max("timestamp").alias("trained_at"))
    runs = m.join(t, "symbol").select(F.col("symbol").alias("run_id"), "trained_at", "r2")
    return mdl.promotion(runs, min_r2=0.2).select("run_id", "trained_at", "r2", "promoted", "stage")


# --------------------------------------------------------------------------- importance tables

_IMP_FEATURES = ["quantity", "quote_quantity", "buyer_maker_int", "hour_of_day", "minute_of_day", "second_sin",
                 "second_cos", "log_quantity", "log_quote_quantity", "implied_price", "signed_volume"]

_IMP_EXPR = {
    "quantity": "quantity",
    "quote_quantity": "quote_quantity",
    "buyer_maker_int": "CAST(is_buyer_maker AS DOUBLE)",
    "hour_of_day": 'CAST(("timestamp" // 1000 // 3600) % 24 AS DOUBLE)',
    "minute_of_day": 'CAST(("timestamp" // 1000 // 60) % 1440 AS DOUBLE)',
    "second_sin": 'sin(2 * pi() * (("timestamp" // 1000) % 60) / 60.0)',
    "second_cos": 'cos(2 * pi() * (("timestamp" // 1000) % 60) / 60.0)',
    "log_quantity": "ln(1 + quantity)",
    "log_quote_quantity": "ln(1 + quote_quantity)",
    "implied_price": "quote_quantity / (quantity + 1e-9)",
    "signed_volume": "CASE WHEN is_buyer_maker THEN -quantity ELSE quantity END",
}

_IMP_SQL = (
    with_tapes(E_TAPE)
    + ",\nimp AS ("
    + "\n  UNION ALL ".join(f"SELECT '{f}' AS feature, abs(corr({_IMP_EXPR[f]}, price)) AS raw FROM e" for f in _IMP_FEATURES)
    + ")"
)


def _importance(spark, sf):
    """Derived importance table: |corr(feature, price)| over the whole tape, all features in one
    aggregate (P9 numeric selection)."""
    t = feat.size_features(feat.time_features(tape_events(spark, sf)))
    cols = feat.numeric_feature_columns(t.select(*_IMP_FEATURES))
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = t.selectExpr("price", f"stack({len(cols)}, {stack}) AS (feature, value)")
    return long.groupBy("feature").agg(F.abs(F.corr("value", "price")).alias("raw"))


@register(
    "importance_prune_max",
    "M7",
    _IMP_SQL
    + f"""
, k AS (SELECT feature, raw, raw >= (SELECT max(raw) FROM imp) * 0.01 AS keep FROM imp)
SELECT feature, {sql_fround('raw')} AS importance,
       CASE WHEN (SELECT count_if(keep) FROM k) > 0 THEN keep
            ELSE row_number() OVER (ORDER BY raw DESC, feature) <= 15 END AS keep
FROM k""",
)
def q_importance_prune_max(spark, sf):
    imp = _importance(spark, sf).withColumnRenamed("raw", "importance")
    k = mdl.prune_by_max_share(imp)
    return k.select("feature", fround("importance").alias("importance"), "keep")


@register(
    "importance_prune_mean",
    "M8 A9",
    _IMP_SQL + f"\nSELECT feature, {sql_fround('raw')} AS importance, raw >= (SELECT avg(raw) FROM imp) AS keep FROM imp",
)
def q_importance_prune_mean(spark, sf):
    imp = _importance(spark, sf).withColumnRenamed("raw", "importance")
    k = mdl.prune_by_mean(imp)
    return k.select("feature", fround("importance").alias("importance"), "keep")


@register(
    "importance_top_n",
    "M16 O3 O5",
    _IMP_SQL
    + f"\nSELECT feature, {sql_fround('raw')} AS importance FROM imp ORDER BY raw DESC, feature LIMIT 5",
)
def q_importance_top_n(spark, sf):
    imp = _importance(spark, sf).withColumnRenamed("raw", "importance")
    return mdl.top_n(imp, 5).select("feature", fround("importance").alias("importance"))


@register(
    "numeric_columns_only",
    "P9",
    with_tapes(E_TAPE)
    + """
SELECT trade_id, price, quantity, quote_quantity, "timestamp", CAST(is_buyer_maker AS BIGINT) AS is_buyer_maker,
       CAST(is_best_match AS BIGINT) AS is_best_match
FROM e""",
)
def q_numeric_columns_only(spark, sf):
    t = tape_events(spark, sf)
    cols = feat.numeric_feature_columns(t, exclude=["symbol", "ds"])
    return t.select(*[F.col(c).cast("bigint").alias(c) if dict(t.dtypes)[c] == "boolean" else F.col(c) for c in cols])


@register(
    "fill_and_drop_nulls",
    "P8",
    with_tapes(E_TAPE)
    + """
, x AS (SELECT trade_id, symbol, lag(price, 3) OVER w AS price_lag_3, price / lag(price, 3) OVER w - 1 AS return_lag_3
        FROM e WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp", trade_id))
SELECT trade_id, symbol, coalesce(price_lag_3, 0.0) AS price_lag_3_filled,
       """
    + sql_fround("coalesce(return_lag_3, 0.0)")
    + """ AS return_lag_3_filled,
       price_lag_3 IS NOT NULL AND return_lag_3 IS NOT NULL AS kept_by_drop
FROM x""",
)
def q_fill_and_drop_nulls(spark, sf):
    f = feat.trade_features(tape_events(spark, sf), group_cols=["symbol"], order_cols=EVENTS_ORDER, windows=(),
                            lag_steps=(3,), vol_windows=(), derived=False, ofi=False, lag_mode="strict",
                            size_bucket=False).select("trade_id", "symbol", "price_lag_3", "return_lag_3")
    filled = feat._warmup(f, ["price_lag_3", "return_lag_3"], "fill").select(
        "trade_id", F.col("price_lag_3").alias("price_lag_3_filled"), fround("return_lag_3").alias("return_lag_3_filled")
    )
    kept = feat._warmup(f, ["price_lag_3", "return_lag_3"], "drop").select("trade_id", F.lit(True).alias("kept_by_drop"))
    return (
        f.select("trade_id", "symbol")
        .join(filled, "trade_id")
        .join(kept, "trade_id", "left")
        .select("trade_id", "symbol", "price_lag_3_filled", "return_lag_3_filled",
                F.coalesce("kept_by_drop", F.lit(False)).alias("kept_by_drop"))
    )


# --------------------------------------------------------------------------- online table

_ONLINE_SQL = (
    with_tapes(E_TAPE)
    + """
, asof_t AS (SELECT max("timestamp") AS t FROM e),
tail AS (SELECT * FROM e ORDER BY "timestamp" DESC, trade_id DESC LIMIT 1000),
latest AS (SELECT * FROM e ORDER BY "timestamp" DESC, trade_id DESC LIMIT 1)"""
)


@register(
    "online_topk_payload",
    "K7 O2 O4 E6 E7",
    _ONLINE_SQL
    + """
SELECT 'eth_feature:' || CAST(trade_id AS VARCHAR) AS key, trade_id, price, quantity, quote_quantity, "timestamp", is_buyer_maker, is_best_match, symbol, ds, CAST((SELECT t FROM asof_t) + 604800000 AS BIGINT) AS expires_at_ms
FROM tail
UNION ALL
SELECT 'eth_feature:latest', trade_id, price, quantity, quote_quantity, "timestamp", is_buyer_maker, is_best_match, symbol, ds, CAST((SELECT t FROM asof_t) + 604800000 AS BIGINT) FROM latest""",
)
def q_online_topk_payload(spark, sf):
    t = tape_events(spark, sf)
    as_of = t.agg(F.max("timestamp")).first()[0]
    kv = online.online_table(t, as_of)
    got = kv.withColumn("v", F.from_json("payload", t.schema))
    return got.select("key", "v.*", "expires_at_ms")


@register(
    "online_publish_versions",
    "K7 O2 U3",
    with_tapes(E_TAPE)
    + """
, older AS (SELECT * FROM e WHERE "timestamp" < (SELECT max("timestamp") - 86400000 FROM e)),
a AS (SELECT 1 AS version, * FROM older ORDER BY "timestamp" DESC, trade_id DESC LIMIT 1000),
b AS (SELECT 2 AS version, * FROM e ORDER BY "timestamp" DESC, trade_id DESC LIMIT 1000)
SELECT version, 'eth_feature:' || CAST(trade_id AS VARCHAR) AS key, price, "timestamp" FROM a
UNION ALL
SELECT version, 'eth_feature:' || CAST(trade_id AS VARCHAR), price, "timestamp" FROM b""",
)
def q_online_publish_versions(spark, sf):
    """The table of all days but the last 24 hours, then that of all: both versions read back."""
    t = tape_events(spark, sf)
    as_of = t.agg(F.max("timestamp")).first()[0]
    root = scratch_dir(spark, "online-versions")
    parts = []
    for version, rows in enumerate((t.where(F.col("timestamp") < as_of - 86_400_000), t), 1):
        versions.publish(online.online_table(rows, as_of), root)
        parts.append(versions.read_version(spark, root).withColumn("version", F.lit(version)))
    kv = parts[0].unionByName(parts[1]).where(F.col("key") != online.KEY_PREFIX + online.LATEST)
    kv = kv.withColumn("v", F.from_json("payload", "price double, timestamp bigint"))
    return kv.select("version", "key", "v.price", "v.timestamp")


@register(
    "online_lookup_outcomes",
    "J1 M12",
    _ONLINE_SQL
    + """
SELECT e.trade_id AS request_id, tail.trade_id IS NOT NULL AND e.trade_id % 10 <> 0 AS found,
       CASE WHEN e.trade_id % 10 <> 0 THEN tail.price END AS price
FROM e LEFT JOIN tail ON e.trade_id = tail.trade_id""",
)
def q_online_lookup_outcomes(spark, sf):
    """A table without its ``latest`` entry, every tenth payload broken: unknown keys and payloads
    that cannot be read give no vector."""
    t = tape_events(spark, sf)
    as_of = t.agg(F.max("timestamp")).first()[0]
    kv = online.online_table(t, as_of).where(F.col("key") != online.KEY_PREFIX + online.LATEST)
    broken = F.substring_index("key", ":", -1).try_cast("bigint") % 10 == 0
    kv = kv.withColumn("payload", F.when(broken, F.lit("{broken")).otherwise(F.col("payload")))
    got = online.lookup(t.select(F.col("trade_id").alias("request_id")), kv, "trade_id bigint, price double", as_of_ms=as_of)
    return got.select("request_id", online.has_vector(got).alias("found"), F.col("vector.price").alias("price"))


@register(
    "online_lookup_fallback",
    "J1 P10",
    _ONLINE_SQL
    + """
SELECT e.trade_id AS request_id, tail.trade_id IS NULL AS fallback,
       coalesce(tail.trade_id, (SELECT trade_id FROM latest)) AS trade_id,
       coalesce(tail.price, (SELECT price FROM latest)) AS price,
       coalesce(tail.quantity, (SELECT quantity FROM latest)) AS quantity,
       CAST(0.0 AS DOUBLE) AS missing_feature
FROM e LEFT JOIN tail ON e.trade_id = tail.trade_id""",
)
def q_online_lookup_fallback(spark, sf):
    t = tape_events(spark, sf)
    as_of = t.agg(F.max("timestamp")).first()[0]
    kv = online.online_table(t, as_of)
    req = t.select(F.col("trade_id").alias("request_id"))
    schema = "trade_id bigint, price double, quantity double, symbol string"
    got = online.lookup(req, kv, schema, as_of_ms=as_of).select("request_id", "fallback", "vector.*")
    aligned = online.align_columns(got, ["price", "quantity", "missing_feature"], keep=["request_id", "fallback", "trade_id"])
    return aligned


@register(
    "first_rows_sample",
    "O5 O1",
    with_tapes(E_TAPE) + '\nSELECT trade_id, "timestamp", price FROM e ORDER BY "timestamp", trade_id LIMIT 20',
)
def q_first_rows_sample(spark, sf):
    return online.first_rows(tape_events(spark, sf), 20).select("trade_id", "timestamp", "price")
