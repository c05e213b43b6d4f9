"""Time-bucket bars, mergeable partial aggregates and trailing summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.columns import epoch_to_ms, ln_pos
from tickforge.operators.sequence import drop_helpers, ordered_windows, with_sequence
from tickforge.schema import DEFAULT_ORDER

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def signed_quantity() -> Column:
    """P7 order-flow sign applied to quantity: sells initiated by takers (maker = buyer) count negative."""
    return F.when(F.col("is_buyer_maker"), -F.col("quantity")).otherwise(F.col("quantity"))


def order_key(df: DataFrame, order_cols: Sequence[str]) -> Column:
    """Ordering value for ``min_by``/``max_by`` over (time, id).

    For two integral columns it is the exact DECIMAL(38,0) ``t * 2e19 + (id + 1e19)``: order
    preserving for every long id and |t| < 5e18, and fixed-width, so the aggregate stays a hash
    aggregate (a struct ordering forces a sort-based aggregate, a full map-side sort at scale).
    Otherwise the struct of the columns."""
    from pyspark.sql import types as T

    cols = list(order_cols)
    integral = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    if len(cols) == 2 and all(isinstance(df.schema[c].dataType, integral) for c in cols):
        a, b = cols
        return F.expr(
            f"CAST(CAST(`{a}` AS DECIMAL(38,0)) * 20000000000000000000BD"
            f" + (CAST(`{b}` AS DECIMAL(38,0)) + 10000000000000000000BD) AS DECIMAL(38,0))"
        )
    return F.struct(*[F.col(c) for c in cols])


def bar_start(bar_ms: int, ts_unit: str = "ms") -> Column:
    ms = epoch_to_ms(F.col("timestamp"), ts_unit)
    return (F.floor(ms / F.lit(bar_ms)) * F.lit(bar_ms)).cast("bigint")


def ohlcv(
    df: DataFrame,
    bar_ms: int = MINUTE_MS,
    group_cols: Sequence[str] = (),
    order_cols: Sequence[str] = DEFAULT_ORDER,
    ts_unit: str = "ms",
) -> DataFrame:
    """A1: open/close = price of the first/last trade in the bar (by ``order_cols``), high, low,
    volume, quote volume, order-flow imbalance. ``window_start`` is epoch ms (UTC). All
    aggregates combine map-side in a hash aggregate (see :func:`order_key`)."""
    order = order_key(df, order_cols)
    return (
        df.withColumn("window_start", bar_start(bar_ms, ts_unit))
        .groupBy(*group_cols, "window_start")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("quantity").alias("volume"),
            F.sum("quote_quantity").alias("quote_volume"),
            F.sum(signed_quantity()).alias("order_flow_imbalance"),
        )
    )


def ohlcv_partials(
    df: DataFrame,
    bar_ms: int = MINUTE_MS,
    group_cols: Sequence[str] = (),
    order_cols: Sequence[str] = DEFAULT_ORDER,
    ts_unit: str = "ms",
) -> DataFrame:
    """A3 state table: per bar the order keys and prices of the first and last trade, high, low
    and the sums. States merge with ``min_by``/``max_by``/``min``/``max``/``sum``, so any coarser
    bar is a re-aggregation of this table; re-writing one ``ds`` of it with dynamic overwrite is
    idempotent."""
    key = order_key(df, order_cols)
    return (
        df.withColumn("window_start", bar_start(bar_ms, ts_unit))
        .withColumn("_tf_k", key)
        .groupBy(*group_cols, "window_start")
        .agg(
            F.min("_tf_k").alias("open_key"),
            F.min_by("price", "_tf_k").alias("open_price"),
            F.max("price").alias("high_state"),
            F.min("price").alias("low_state"),
            F.max("_tf_k").alias("close_key"),
            F.max_by("price", "_tf_k").alias("close_price"),
            F.sum("quantity").alias("volume_state"),
            F.sum("quote_quantity").alias("quote_volume_state"),
            F.sum(signed_quantity()).alias("ofi_state"),
        )
    )


def merge_partials(partials: DataFrame, bar_ms: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """A3 merge: roll partial states up to bars of ``bar_ms`` (a multiple of the partial bar)."""
    return (
        partials.withColumn("window_start", (F.floor(F.col("window_start") / F.lit(bar_ms)) * F.lit(bar_ms)).cast("bigint"))
        .groupBy(*group_cols, "window_start")
        .agg(
            F.min_by("open_price", "open_key").alias("open"),
            F.max("high_state").alias("high"),
            F.min("low_state").alias("low"),
            F.max_by("close_price", "close_key").alias("close"),
            F.sum("volume_state").alias("volume"),
            F.sum("quote_volume_state").alias("quote_volume"),
            F.sum("ofi_state").alias("order_flow_imbalance"),
        )
    )


def trailing_filter(df: DataFrame, as_of_ms: int, minutes: int = 60, ts_unit: str = "ms") -> DataFrame:
    """Rows at or after ``as_of - minutes`` (``as_of`` explicit, never wall-clock now)."""
    lower = as_of_ms - int(minutes) * MINUTE_MS
    if dict(df.dtypes).get("timestamp") == "bigint" and ts_unit in ("ms", "us"):
        # A bare integer comparison reaches the scan as a pushed filter.
        return df.where(F.col("timestamp") >= F.lit(lower * (1000 if ts_unit == "us" else 1)).cast("long"))
    return df.where(epoch_to_ms(F.col("timestamp"), ts_unit) >= F.lit(float(lower)))


def trailing_summary(
    df: DataFrame,
    as_of_ms: int,
    minutes: int = 60,
    group_cols: Sequence[str] = (),
    order_cols: Sequence[str] = DEFAULT_ORDER,
    ts_unit: str = "ms",
    **seq_kw,
) -> DataFrame:
    """A2: VWAP (2 digits), net order flow (4), realized volatility from consecutive prices (4)
    and tick count over the trailing window. Consecutive prices come from the positional
    engine (lag 1 inside each group), not from a single ordered partition."""
    recent = trailing_filter(df, as_of_ms, minutes, ts_unit).select(*group_cols, *order_cols, "price", "quantity",
                                                                     "is_buyer_maker")
    recent = recent.select(*dict.fromkeys(recent.columns))
    s = with_sequence(recent, order_cols, group_cols, **seq_kw)

    def stage(w):
        prev = F.lag("price", 1).over(w)
        return {"_tf_sq": F.pow(ln_pos(F.try_divide(F.col("price"), prev)), 2)}

    r = drop_helpers(ordered_windows(s, [stage], lookback=1))
    return r.groupBy(*group_cols).agg(
        F.round(F.try_divide(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity")), 2).alias("vwap"),
        F.round(F.sum(signed_quantity()), 4).alias("net_order_flow_imbalance"),
        F.round(F.coalesce(F.sqrt(F.sum("_tf_sq")), F.lit(0.0)), 4).alias("realized_volatility"),
        F.count(F.lit(1)).alias("total_ticks"),
    )
