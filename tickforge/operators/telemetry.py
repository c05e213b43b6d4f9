"""Service telemetry queries re-aimed as batch operators over a metric-sample table.

Samples are ``(series..., ts_ms, value)`` rows. Counters are cumulative; histograms are
cumulative ``le`` buckets (``le`` = +inf for the last one)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counter_rate(
    samples: DataFrame,
    series_cols: Sequence[str],
    window_ms: int = 300_000,
    by: Sequence[str] = (),
    ts_col: str = "ts_ms",
    value_col: str = "value",
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Per tumbling window, the reset-aware increase of each counter series (a drop in value
    is a reset: the new value counts as the increase) summed over series (grouped by ``by``), per
    minute: ``increase / window seconds * 60``.

    A segmented scan: one exchange of rows by (series, window), where each segment is summed up as
    (first value, last value, increase inside). The segments of a series, one row each, then combine
    in time order: what lies between two of them is the step from one's last to the next one's
    first. Samples of a series are ordered by time, then value (a counter only grows between
    resets); samples without time are left out."""
    order = [F.col(c).asc_nulls_last() for c in (order_cols or (ts_col, value_col))]
    win = (F.floor(F.col(ts_col) / F.lit(window_ms)) * F.lit(window_ms)).cast("bigint")
    keys = [*series_cols, "window_start"]
    rows = samples.where(F.col(ts_col).isNotNull()).withColumn("window_start", win)

    def step(value: Column, prev: Column) -> Column:
        return F.when(prev.isNull(), F.lit(0.0)).when(value >= prev, value - prev).otherwise(value).cast("double")

    # Windows and aggregate share the exchange on (series, window).
    w = Window.partitionBy(*keys).orderBy(*order)
    at = F.row_number().over(w)
    inside = step(F.col(value_col), F.lag(value_col).over(w))
    marked = rows.select(*keys, F.col(value_col).alias("_tf_v"), at.alias("_tf_at"), inside.alias("_tf_step"))
    parts = marked.groupBy(*keys).agg(
        F.min_by("_tf_v", "_tf_at").alias("_tf_first"), F.max_by("_tf_v", "_tf_at").alias("_tf_last"), F.sum("_tf_step").alias("_tf_inside")
    )
    series = Window.partitionBy(*series_cols).orderBy("window_start")
    whole = F.col("_tf_inside") + step(F.col("_tf_first"), F.lag("_tf_last").over(series))
    return (
        parts.withColumn("_tf_inc", whole)
        .groupBy(*by, "window_start")
        .agg(F.sum("_tf_inc").alias("increase"))
        .withColumn("rate_per_min", F.col("increase") / F.lit(window_ms / 1000.0) * F.lit(60.0))
    )


def bucket_quantile(buckets: DataFrame, q: float, group_cols: Sequence[str] = (), le_col: str = "le",
                    count_col: str = "count") -> DataFrame:
    """Quantile from cumulative buckets: rank = q * total (count of the +inf bucket); the first
    bucket whose cumulative count reaches the rank; linear interpolation inside it from the
    previous upper bound (0 for the first bucket); the +inf bucket returns the largest finite
    bound. One small aggregate per group (bucket lists are bounded by the bucket layout)."""
    agg = buckets.groupBy(*group_cols).agg(F.array_sort(F.collect_list(F.struct(F.col(le_col).alias("le"),
                                                                                F.col(count_col).cast("double").alias("c")))).alias("b"))
    total = F.element_at(F.col("b"), -1)["c"]
    rank = F.lit(float(q)) * total
    idx = F.array_position(F.transform(F.col("b"), lambda x: x["c"] >= rank), F.lit(True))
    cur = F.element_at(F.col("b"), idx.cast("int"))
    prev = F.when(idx > 1, F.element_at(F.col("b"), (idx - 1).cast("int")))
    lo_le = F.coalesce(prev["le"], F.lit(0.0))
    lo_c = F.coalesce(prev["c"], F.lit(0.0))
    finite_max = F.element_at(F.filter(F.col("b")["le"], lambda v: ~F.isnan(v) & (v < F.lit(math.inf))), -1)
    interp = lo_le + (cur["le"] - lo_le) * F.try_divide(rank - lo_c, cur["c"] - lo_c)
    value = F.when(total.isNull() | (total == 0), F.lit(None).cast("double")).when(
        cur["le"] == F.lit(math.inf), finite_max
    ).otherwise(F.coalesce(interp, cur["le"]))
    return agg.select(*group_cols, value.alias("quantile"))


def gauge_sum(samples: DataFrame, series_cols: Sequence[str], ts_col: str = "ts_ms", value_col: str = "value",
              default: float = 1.0, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sum over series of each series' latest value; ``default`` when there is no series."""
    order = F.struct(F.col(ts_col), *[F.col(c) for c in tiebreak])
    last = samples.groupBy(*series_cols).agg(F.max_by(value_col, order).alias("_v"))
    return last.agg(F.coalesce(F.sum("_v"), F.lit(default)).alias("value"))
