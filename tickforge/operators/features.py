"""Trade-tape features: time, size, order flow, rolling statistics, lags, targets.

All sequence features are evaluated by :mod:`tickforge.operators.sequence` (row positions plus
block-halo windows), so no group is ever sorted in a single task. Row-local features are plain
column expressions fused into the same stages.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.columns import TWO_PI, calendar_fields, epoch_to_ms, ln_pos
from tickforge.operators.joins import attach
from tickforge.operators.sequence import (
    DEFAULT_BLOCK_ROWS,
    approx_quantiles,
    DEFAULT_ROWS_PER_BUCKET,
    drop_helpers,
    exact_quantiles,
    ordered_windows,
    plan_buckets,
    rows_frame,
    with_sequence,
)
from tickforge.schema import DEFAULT_ORDER
from tickforge.session import compilable_methods

# Default window sizes, lag steps and volatility windows of the Gold feature set,
# the windows always added to it, and the training-script preset.
GOLD_WINDOWS = (5, 10, 20, 50)
GOLD_CORE_WINDOWS = (5, 10, 20)
GOLD_LAGS = (1, 2, 5, 10, 20)
VOL_WINDOWS = (10, 50, 100)
TRAIN_WINDOWS = (5, 10, 20, 50, 100)
TRAIN_LAGS = (1, 2, 3, 5, 10, 20)
TRAIN_DROP_COLS = ("trade_id", "price", "timestamp", "ts_ms", "ts_sec", "is_buyer_maker", "is_best_match")
EPS = 1e-9
SIZE_BUCKETS = 10
# Positional helper columns of ``trade_features`` that are not part of the published feature sets.
POSITION_COLS = ("seq", "n_group", "min_timestamp")


# --------------------------------------------------------------------------- row-local features


def time_features(df: DataFrame, ts_unit: str = "ms", first_ts_col: str | None = None) -> DataFrame:
    """P5 (+W15 when the group's first timestamp column is given)."""
    ms = epoch_to_ms(F.col("timestamp"), ts_unit)
    cal = calendar_fields(ms)
    cols = {
        "ts_ms": ms,
        "ts_sec": ms / F.lit(1000.0),
    }
    if first_ts_col is not None:
        cols["elapsed_sec"] = ms / F.lit(1000.0) - epoch_to_ms(F.col(first_ts_col), ts_unit) / F.lit(1000.0)
    cols.update(
        {
            "hour_of_day": cal["hour"].cast("bigint"),
            "minute_of_day": cal["minute_of_day"].cast("bigint"),
            "second_sin": F.sin(F.lit(TWO_PI) * cal["second"] / F.lit(60.0)),
            "second_cos": F.cos(F.lit(TWO_PI) * cal["second"] / F.lit(60.0)),
        }
    )
    return df.withColumns(cols)


def size_features(df: DataFrame) -> DataFrame:
    """P6 + P7: log sizes, maker flag as int, implied price, tick direction, signed volume."""
    maker = F.col("is_buyer_maker")
    tick = F.when(maker, F.lit(-1.0)).otherwise(F.lit(1.0))
    return df.withColumns(
        {
            "log_quantity": F.log1p(F.col("quantity")),
            "log_quote_quantity": F.log1p(F.col("quote_quantity")),
            "buyer_maker_int": maker.cast("bigint"),
            "implied_price": F.try_divide(F.col("quote_quantity"), F.col("quantity") + F.lit(EPS)),
            "tick_direction": tick,
            "signed_volume": tick * F.col("quantity"),
        }
    )


def size_bucket_expr(value: Column, edges: Column) -> Column:
    """Right-closed quantile bucket, lowest edge included, repeated edges dropped.

    Bucket = number of distinct inner edges strictly below the value; 0 when bucketing is
    impossible (one distinct edge, NULL value)."""
    below = F.size(F.filter(F.array_distinct(edges), lambda e: e < value))
    return F.when(value.isNull() | edges.isNull(), F.lit(0)).otherwise(F.greatest(below - 1, F.lit(0))).cast("bigint")


def size_bucket_knots(
    df: DataFrame, group_cols: Sequence[str] = (), value_col: str = "quantity", buckets: int = SIZE_BUCKETS,
    method: str = "exact", **seq_kw,
) -> DataFrame:
    """Quantile edges of trade size per group: exact distributed order statistics, or one sketch
    aggregate with ``method="approx"``."""
    probs = [i / buckets for i in range(buckets + 1)]
    if method == "approx":
        return approx_quantiles(df, value_col, probs, group_cols, out_col="size_edges").drop("n_values")
    return exact_quantiles(df, value_col, probs, group_cols, out_col="size_edges", **seq_kw).drop("n_values")


def with_size_bucket(
    df: DataFrame,
    group_cols: Sequence[str] = (),
    knots: DataFrame | None = None,
    value_col: str = "quantity",
    out_col: str = "trade_size_bucket",
    **seq_kw,
) -> DataFrame:
    """Attach per-group knots (computed here unless given, e.g. for scoring) and bucket."""
    group_cols = list(group_cols)
    if knots is None:
        knots = size_bucket_knots(df, group_cols, value_col, **seq_kw)
    if group_cols:
        out = attach(df, knots, group_cols)
    else:
        out = attach(df.withColumn("_tf_one", F.lit(1)), knots.withColumn("_tf_one", F.lit(1)), ["_tf_one"]).drop("_tf_one")
    return out.withColumn(out_col, size_bucket_expr(F.col(value_col), F.col("size_edges"))).drop("size_edges")


# --------------------------------------------------------------------------- sequence features


def _rolling_family(w: WindowSpec, windows: Iterable[int], ofi: bool) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for n in windows:
        f = rows_frame(w, n)
        out[f"price_roll_mean_{n}"] = F.avg("price").over(f)
        out[f"price_roll_std_{n}"] = F.coalesce(F.stddev_samp("price").over(f), F.lit(0.0))
        out[f"price_roll_max_{n}"] = F.max("price").over(f)
        out[f"price_roll_min_{n}"] = F.min("price").over(f)
        out[f"qty_roll_mean_{n}"] = F.avg("quantity").over(f)
        out[f"qty_roll_sum_{n}"] = F.sum("quantity").over(f)
        out[f"buyer_roll_sum_{n}"] = F.sum(F.col("buyer_maker_int").cast("double")).over(f)
        if ofi:
            out[f"ofi_roll_{n}"] = F.sum("signed_volume").over(f)
    return out


def trade_features(
    df: DataFrame,
    *,
    group_cols: Sequence[str] = (),
    order_cols: Sequence[str] = DEFAULT_ORDER,
    windows: Sequence[int] = GOLD_WINDOWS,
    lag_steps: Sequence[int] = GOLD_LAGS,
    vol_windows: Sequence[int] = VOL_WINDOWS,
    lag_mode: str = "backfill",
    ofi: bool = True,
    vwap_windows: Sequence[int] = (),
    derived: bool = True,
    size_bucket: bool = True,
    size_knots: DataFrame | None = None,
    targets: Sequence[int] = (),
    ts_unit: str = "ms",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
) -> DataFrame:
    """Compute the trade feature families in one positional pass: rolling mean / std / max / min /
    sums and order flow (W1-W5), tick log return and realized volatility (W6, W7), lags with
    back-fill or strict and returns (W8-W10), momentum and Bollinger (W11-W13), rolling VWAP
    (W14), elapsed time (W15), next / horizon targets (W16), size bucket (W17).

    ``lag_mode='backfill'``: the first ``k`` rows of a group take the group's first value and a
    group of at most ``k`` rows gets 0 (lag features), returns are 0 there. ``'strict'``: NULL.
    ``targets``: horizons ``h`` for ``target_next`` (h = 1, next price) and
    ``target_logret_<h>`` (log return over ``h`` rows); NULL on the last ``h`` rows.
    """
    compilable_methods(df.sparkSession)
    group_cols = list(group_cols)
    windows = sorted(set(int(w) for w in windows))
    lag_steps = sorted(set(int(k) for k in lag_steps))
    vol_windows = sorted(set(int(w) for w in vol_windows))
    vwap_windows = sorted(set(int(w) for w in vwap_windows))
    targets = sorted(set(int(h) for h in targets))

    if size_bucket:
        df = with_size_bucket(df, group_cols, knots=size_knots, rows_per_bucket=rows_per_bucket)

    # The first timestamp in (timestamp, ...) order is the group minimum (NULLs sort last).
    plan = plan_buckets(df, order_cols[0], rows_per_bucket)
    n_rows = plan.n
    s = with_sequence(df, order_cols, group_cols, min_cols=["timestamp"], plan=plan)
    s = time_features(s, ts_unit, first_ts_col="min_timestamp")
    s = size_features(s)

    lookback = max([*windows, *vwap_windows, *lag_steps, *[v + 1 for v in vol_windows], 1])
    lookahead = max([*targets, 0])
    seq, n = F.col("seq"), F.col("n_group")

    def stage1(w: WindowSpec) -> dict[str, Column]:
        out = _rolling_family(w, windows, ofi)
        # Back-fill only reaches rows with seq < k <= lookback, which sit in block 0, whose first
        # row is the group's first row.
        head = w.rowsBetween(Window.unboundedPreceding, 0)
        first_price, first_qty = F.first("price").over(head), F.first("quantity").over(head)
        prev = F.lag("price", 1).over(w)
        out["log_return_tick"] = F.when(seq == 0, F.lit(0.0)).otherwise(ln_pos(F.try_divide(F.col("price"), prev)))
        for k in lag_steps:
            lp = F.lag("price", k).over(w)
            lq = F.lag("quantity", k).over(w)
            if lag_mode == "backfill":
                short = n <= F.lit(k)
                out[f"price_lag_{k}"] = F.when(seq >= k, lp).when(short, F.lit(0.0)).otherwise(first_price)
                out[f"qty_lag_{k}"] = F.when(seq >= k, lq).when(short, F.lit(0.0)).otherwise(first_qty)
                out[f"return_lag_{k}"] = F.when(seq >= k, F.try_divide(F.col("price"), lp) - 1).otherwise(F.lit(0.0))
            elif lag_mode == "strict":
                out[f"price_lag_{k}"] = lp
                out[f"qty_lag_{k}"] = lq
                out[f"return_lag_{k}"] = F.try_divide(F.col("price"), lp) - 1
            else:
                raise ValueError(f"lag_mode must be 'backfill' or 'strict', got {lag_mode!r}")
        for v in vwap_windows:
            f = rows_frame(w, v)
            out[f"vwap_{v}"] = F.try_divide(F.sum(F.col("price") * F.col("quantity")).over(f), F.sum("quantity").over(f))
        for h in targets:
            lead = F.lead("price", h).over(w)
            if h == 1:
                out["target_next"] = lead
            out[f"target_logret_{h}"] = ln_pos(F.try_divide(lead, F.col("price")))
        return out

    def stage2(w: WindowSpec) -> dict[str, Column]:
        out = {"sq_return": F.pow(F.col("log_return_tick"), 2)}
        return out

    def stage3(w: WindowSpec) -> dict[str, Column]:
        return {f"realized_volatility_{v}": F.sqrt(F.sum("sq_return").over(rows_frame(w, v))) for v in vol_windows}

    stages = [stage1, stage2] + ([stage3] if vol_windows else [])
    out = ordered_windows(s, stages, lookback=lookback, lookahead=lookahead, block_rows=block_rows, n_rows=n_rows)
    if derived:
        out = derived_features(out, vwap_windows)
    return drop_helpers(out)


def derived_features(df: DataFrame, vwap_windows: Sequence[int] = ()) -> DataFrame:
    """W11-W13 (+ distance to rolling VWAP, W14): projections over rolling columns."""
    m5, m10, m20 = F.col("price_roll_mean_5"), F.col("price_roll_mean_10"), F.col("price_roll_mean_20")
    s10, s20 = F.col("price_roll_std_10"), F.col("price_roll_std_20")
    upper = m20 + F.lit(2.0) * s20
    lower = m20 - F.lit(2.0) * s20
    cols = {
        "price_momentum_5": F.col("price") - m5,
        "price_momentum_20": F.col("price") - m20,
        "volatility_ratio": F.try_divide(s10, m10 + F.lit(EPS)),
        "bollinger_upper_20": upper,
        "bollinger_lower_20": lower,
        "bollinger_band_pct": F.try_divide(F.col("price") - lower, upper - lower + F.lit(EPS)),
    }
    for v in vwap_windows:
        cols["price_vs_vwap" if v == 20 else f"price_vs_vwap_{v}"] = F.col("price") - F.col(f"vwap_{v}")
    return df.withColumns(cols)


# --------------------------------------------------------------------------- presets


def gold_feature_names(windows: Sequence[int] | None = None, lag_steps: Sequence[int] | None = None) -> list[str]:
    """F1 feature columns (the model's input list, in order) for the given parameters."""
    windows = _gold_windows(windows)
    lag_steps = list(GOLD_LAGS) if lag_steps is None else list(lag_steps)
    names = [
        "price", "quantity", "quote_quantity", "is_buyer_maker", "is_best_match",
        "elapsed_sec", "hour_of_day", "minute_of_day", "second_sin", "second_cos",
        "log_quantity", "log_quote_quantity", "buyer_maker_int", "implied_price", "trade_size_bucket",
        "tick_direction", "signed_volume",
    ]
    for w in windows:
        names += [f"price_roll_mean_{w}", f"price_roll_std_{w}", f"price_roll_max_{w}", f"price_roll_min_{w}",
                  f"qty_roll_mean_{w}", f"qty_roll_sum_{w}", f"buyer_roll_sum_{w}", f"ofi_roll_{w}"]
    names += ["log_return_tick", "sq_return"] + [f"realized_volatility_{v}" for v in VOL_WINDOWS]
    for k in lag_steps:
        names += [f"price_lag_{k}", f"qty_lag_{k}", f"return_lag_{k}"]
    names += ["price_momentum_5", "price_momentum_20", "volatility_ratio",
              "bollinger_upper_20", "bollinger_lower_20", "bollinger_band_pct"]
    return names


def _gold_windows(windows: Sequence[int] | None) -> list[int]:
    if windows is None:
        return list(GOLD_WINDOWS)
    return sorted(set(int(w) for w in windows) | set(GOLD_CORE_WINDOWS))


def gold_features(
    df: DataFrame,
    *,
    group_cols: Sequence[str] = (),
    order_cols: Sequence[str] = DEFAULT_ORDER,
    windows: Sequence[int] | None = None,
    lag_steps: Sequence[int] | None = None,
    ts_unit: str = "ms",
    warmup: str = "fill",
    **kw,
) -> DataFrame:
    """F1: the Gold feature set; NULL features are filled with 0.0 (``warmup='fill'``)."""
    wins = _gold_windows(windows)
    lags = list(GOLD_LAGS) if lag_steps is None else list(lag_steps)
    out = trade_features(
        df, group_cols=group_cols, order_cols=order_cols, windows=wins, lag_steps=lags,
        vol_windows=VOL_WINDOWS, lag_mode="backfill", ofi=True, ts_unit=ts_unit, **kw,
    )
    feats = [c for c in gold_feature_names(wins, lags) if c not in df.columns] + ["ts_ms", "ts_sec"]
    return _warmup(out.drop(*POSITION_COLS), feats, warmup)


def train_features(
    df: DataFrame,
    *,
    group_cols: Sequence[str] = (),
    order_cols: Sequence[str] = DEFAULT_ORDER,
    windows: Sequence[int] = TRAIN_WINDOWS,
    lag_steps: Sequence[int] = TRAIN_LAGS,
    ts_unit: str = "ms",
    warmup: str = "drop",
    **kw,
) -> DataFrame:
    """the training-script feature set (adds rolling VWAP 20, no order-flow or volatility)."""
    out = trade_features(
        df, group_cols=group_cols, order_cols=order_cols, windows=windows, lag_steps=lag_steps,
        vol_windows=(), lag_mode="strict", ofi=False, vwap_windows=(20,), ts_unit=ts_unit, **kw,
    )
    out = out.drop("log_return_tick", "sq_return", *POSITION_COLS)
    return _warmup(out, train_feature_names(windows, lag_steps), warmup)


def train_feature_names(windows: Sequence[int] = TRAIN_WINDOWS, lag_steps: Sequence[int] = TRAIN_LAGS) -> list[str]:
    names = ["quantity", "quote_quantity", "elapsed_sec", "hour_of_day", "minute_of_day", "second_sin", "second_cos",
             "log_quantity", "log_quote_quantity", "buyer_maker_int", "implied_price", "trade_size_bucket"]
    for w in sorted(set(windows)):
        names += [f"price_roll_mean_{w}", f"price_roll_std_{w}", f"price_roll_max_{w}", f"price_roll_min_{w}",
                  f"qty_roll_mean_{w}", f"qty_roll_sum_{w}", f"buyer_roll_sum_{w}"]
    for k in sorted(set(lag_steps)):
        names += [f"price_lag_{k}", f"qty_lag_{k}", f"return_lag_{k}"]
    names += ["price_momentum_5", "price_momentum_20", "volatility_ratio", "bollinger_upper_20",
              "bollinger_lower_20", "bollinger_band_pct", "vwap_20", "price_vs_vwap"]
    return names


def warmup(df: DataFrame, cols: Sequence[str], mode: str) -> DataFrame:
    """Fill NULL features with 0.0 (``mode='fill'``) or drop rows with a NULL feature."""
    return _warmup(df, cols, mode)


def _warmup(df: DataFrame, cols: Sequence[str], warmup: str) -> DataFrame:
    """Fill NULL features with 0.0, or drop rows with a NULL feature."""
    cols = [c for c in cols if c in df.columns]
    if warmup == "fill":
        numeric = [c for c in cols if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
        ints = [c for c in cols if isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType))]
        out = df.na.fill(0.0, subset=numeric) if numeric else df
        return out.na.fill(0, subset=ints) if ints else out
    if warmup == "drop":
        return df.na.drop(subset=cols)
    raise ValueError(f"warmup must be 'fill' or 'drop', got {warmup!r}")


def numeric_feature_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns (booleans count as numeric) minus exclusions, in schema order."""
    ex = set(exclude)
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if f.name not in ex and isinstance(f.dataType, kinds)]
