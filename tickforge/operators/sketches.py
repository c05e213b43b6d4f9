"""Mergeable quantile sketches of features by day, and drift between any day ranges from them
(A7, T1, T2, T4).

One pass over the rows stores a KLL sketch a (day, feature), a few kilobytes each. Quantiles, PSI
and the KS distance of any two ranges of days come from merging those of the days: no row is read
again. A sketch's ranks are off by at most ``rank_error(k)`` of its size (with the confidence of
99 % that KLL sketches state), whatever the number of sketches merged into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.operators.drift import EMPTY_SHARE, FEATURE, PSI_BUCKETS, VALUE

#: Size parameter of the sketches; and ranks at which a distribution is laid out.
SKETCH_K = 2_048
GRID = 512


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised rank error (two-sided) that a sketch of size ``k`` stays within."""
    return 2.446 / k**0.9433


def drift_error(k: int = SKETCH_K) -> float:
    """What the KS distance from sketches may differ by: both sketches' ranks, and the grid's."""
    return 2 * rank_error(k) + 3 / GRID


def day_sketches(df: DataFrame, features: Sequence[str], day_col: str = "ds", k: int = SKETCH_K) -> DataFrame:
    """(day, feature, n, sketch) of the non-NULL, non-NaN values: map-side sketches, merged by key."""
    stack = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in features)
    long = df.selectExpr(f"`{day_col}`", f"stack({len(features)}, {stack}) AS ({FEATURE}, {VALUE})")
    long = long.where(F.col(VALUE).isNotNull() & ~F.isnan(VALUE))
    return long.groupBy(day_col, FEATURE).agg(F.count(F.lit(1)).alias("n"), F.expr(f"kll_sketch_agg_double({VALUE}, {int(k)})").alias("sketch"))


def merged(sketches: DataFrame, group_cols: Sequence[str] = (FEATURE,), k: int = SKETCH_K) -> DataFrame:
    """One sketch (and count) a group, from those of its days."""
    return sketches.groupBy(*group_cols).agg(F.sum("n").alias("n"), F.expr(f"kll_merge_agg_double(sketch, {int(k)})").alias("sketch"))


def _quantiles(sketch: str, probs: Sequence[float]) -> Column:
    return F.call_function("kll_sketch_get_quantile_double", F.col(sketch), F.array(*[F.lit(float(p)) for p in probs]))


def _below(grid: Column, values: Column, inclusive: bool) -> Column:
    """Share of a distribution (its quantiles at evenly spaced ranks) below each of ``values``."""
    return F.transform(values, lambda v: F.size(F.filter(grid, lambda q: q <= v if inclusive else q < v)) / F.lit(float(GRID)))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], out_col: str = "quantiles") -> DataFrame:
    """Quantiles of merged sketches at ``probs``: values of the input, of about those ranks."""
    return sketches.withColumn(out_col, _quantiles("sketch", probs))


def sketch_drift(sketches: DataFrame, ref: Column, cur: Column, *, buckets: int = PSI_BUCKETS, k: int = SKETCH_K) -> DataFrame:
    """(feature, n_ref, n_cur, psi, ks_stat) between the days that ``ref`` and ``cur`` (conditions
    on the sketches' columns) select; a feature without values on one side gives 0 and 0."""
    side = sketches.select(FEATURE, "n", "sketch", F.explode(F.array_compact(F.array(F.when(ref, "ref"), F.when(cur, "cur")))).alias("side"))
    both = merged(side, [FEATURE, "side"], k)
    r, c = (both.where(F.col("side") == s).select(FEATURE, F.col("n").alias(f"n_{s}"), F.col("sketch").alias(s)) for s in ("ref", "cur"))
    met = r.join(c, FEATURE, "full").select(FEATURE, *[F.coalesce(f"n_{s}", F.lit(0)).alias(f"n_{s}") for s in ("ref", "cur")], "ref", "cur")

    whole = met.where(F.col("ref").isNotNull() & F.col("cur").isNotNull())
    # The rank functions take constant places only, so both sides are laid out as quantiles at the
    # same evenly spaced ranks, and compared where either has one.
    ranks = [(i + 0.5) / GRID for i in range(GRID)]
    whole = whole.withColumns({"edges": _quantiles("ref", [i / buckets for i in range(1, buckets)]), "gr": _quantiles("ref", ranks), "gc": _quantiles("cur", ranks)})
    places = F.array_distinct(F.concat("gr", "gc"))

    def shares(grid: str) -> Column:
        # Bins are left-closed: an edge's own value lies right of it.
        cuts = F.concat(F.array(F.lit(0.0)), _below(F.col(grid), F.col("edges"), False), F.array(F.lit(1.0)))
        return F.transform(F.sequence(F.lit(1), F.lit(buckets)), lambda i: F.get(cuts, i) - F.get(cuts, i - 1))

    def filled(share: Column) -> Column:
        return F.when(share <= 0, F.lit(EMPTY_SHARE)).otherwise(share)

    terms = F.zip_with(shares("gr"), shares("gc"), lambda a, b: (filled(b) - filled(a)) * F.log(filled(b) / filled(a)))
    gaps = F.zip_with(_below(F.col("gr"), places, True), _below(F.col("gc"), places, True), lambda a, b: F.abs(a - b))
    done = whole.select(FEATURE, F.abs(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)).alias("psi"), F.array_max(gaps).alias("ks_stat"))
    out = met.select(FEATURE, "n_ref", "n_cur").join(done, FEATURE, "left")
    return out.select(FEATURE, "n_ref", "n_cur", *[F.coalesce(x, F.lit(0.0)).alias(x) for x in ("psi", "ks_stat")])
