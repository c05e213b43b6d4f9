"""Distribution drift between a reference and a current sample.

Samples are a long DataFrame ``(feature, sample, value)`` with ``sample`` in {'ref', 'cur'};
every feature is processed in the same jobs (no per-feature loop on the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.operators.joins import attach
from tickforge.operators.materialize import hold, small_result
from tickforge.operators.sequence import drop_helpers, positional_slices, quantiles_from_counts, with_sequence

# Bucket count, empty-bin share, thresholds and the p-value cut-off of the drift check.
PSI_BUCKETS = 10
EMPTY_SHARE = 1e-4
PSI_THRESHOLD = 0.20
KS_ALPHA = 0.01
KS_TERMS = 100
KS_SMALL_LAMBDA = 0.2

FEATURE, SAMPLE, VALUE = "feature", "sample", "value"


def long_samples(ref: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """Stack wide reference/current frames into ``(feature, sample, value)``; features absent
    from the current frame are skipped."""
    feats = [f for f in features if f in ref.columns and f in cur.columns]
    if not feats:
        raise ValueError("no common feature columns")
    stack = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in feats)
    expr = f"stack({len(feats)}, {stack}) AS ({FEATURE}, {VALUE})"
    return ref.selectExpr(expr).withColumn(SAMPLE, F.lit("ref")).unionByName(
        cur.selectExpr(expr).withColumn(SAMPLE, F.lit("cur"))
    )


def _value_counts(samples: DataFrame) -> DataFrame:
    """Counts per (feature, distinct value): a partial aggregate."""
    return (
        samples.where(F.col(VALUE).isNotNull())
        .groupBy(FEATURE, VALUE)
        .agg(
            F.count_if(F.col(SAMPLE) == "ref").cast("double").alias("c_ref"),
            F.count_if(F.col(SAMPLE) == "cur").cast("double").alias("c_cur"),
        )
    )


def _ranked_values(dv: DataFrame, **seq_kw) -> DataFrame:
    """Value counts ranked in value order with running reference/current counts: ``cum_c_ref``,
    ``cum_c_cur``, ``total_c_ref``, ``total_c_cur``. Everything the drift statistics need
    comes from this one positional pass."""
    return drop_helpers(with_sequence(dv, [VALUE], [FEATURE], running_sums=["c_ref", "c_cur"], **seq_kw))


def _edges_from_ranked(ranked: DataFrame, buckets: int) -> DataFrame:
    """A7 from the ranked value counts: percentile edges of the reference sample."""
    probs = [i / buckets for i in range(buckets + 1)]
    return quantiles_from_counts(ranked, VALUE, "c_ref", probs, [FEATURE], "edges").drop("n_values")


def bin_index(value: Column, edges: Column, buckets: int = PSI_BUCKETS) -> Column:
    """Left-closed bins, last bin closed, open outer edges: number of inner edges <= value.
    Repeated edges give empty bins (values equal to them fall in the last bin of the run)."""
    inner = F.slice(edges, 2, buckets - 1)
    return F.aggregate(inner, F.lit(0), lambda acc, e: acc + F.when(value >= e, 1).otherwise(0))


def drift_statistics(samples: DataFrame, buckets: int = PSI_BUCKETS, **seq_kw) -> tuple[DataFrame, DataFrame]:
    """One positional pass for A7, A8, T1 and T2. Returns two small checkpointed tables:
    per (feature, sample, bin) counts (all bins present) and per feature
    (psi, ks_stat, n_ref, n_cur)."""
    dv, release_dv = hold(_value_counts(samples))  # read by the bucket plan and both numbering branches
    ranked, release = hold(_ranked_values(dv, **seq_kw))
    edges = small_result(_edges_from_ranked(ranked, buckets))  # materialises ``ranked``
    release_dv()
    binned = attach(ranked, edges, [FEATURE], how="left")
    gap = F.abs(
        F.try_divide(F.col("cum_c_ref"), F.col("total_c_ref")) - F.try_divide(F.col("cum_c_cur"), F.col("total_c_cur"))
    )
    per_bin = binned.groupBy(FEATURE, F.coalesce(bin_index(F.col(VALUE), F.col("edges"), buckets), F.lit(-1)).alias("bin")).agg(
        F.sum("c_ref").alias("c_ref"),
        F.sum("c_cur").alias("c_cur"),
        F.max(gap).alias("gap"),
        F.first("total_c_ref").alias("n_ref"),
        F.first("total_c_cur").alias("n_cur"),
    )
    per_bin = small_result(per_bin)
    release()
    sizes = per_bin.groupBy(FEATURE).agg(
        F.max("n_ref").cast("bigint").alias("n_ref"), F.max("n_cur").cast("bigint").alias("n_cur"),
        F.max("gap").alias("ks_stat"),
    )
    grid = (
        edges.select(FEATURE)
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
        .join(per_bin.where(F.col("bin") >= 0).select(FEATURE, "bin", "c_ref", "c_cur"), [FEATURE, "bin"], "left")
        .join(sizes, FEATURE)
        .select(FEATURE, "bin", F.coalesce("c_ref", F.lit(0.0)).alias("c_ref"), F.coalesce("c_cur", F.lit(0.0)).alias("c_cur"),
                "n_ref", "n_cur")
    )
    hist = grid.select(
        FEATURE, F.explode(F.array(
            F.struct(F.lit("ref").alias(SAMPLE), F.col("c_ref").alias("c")),
            F.struct(F.lit("cur").alias(SAMPLE), F.col("c_cur").alias("c")),
        )).alias("_h"), "bin",
    ).select(FEATURE, F.col("_h.sample").alias(SAMPLE), "bin", F.col("_h.c").cast("bigint").alias("count"))

    def share(c: str, n: str) -> Column:
        return F.when(F.col(c) == 0, F.lit(EMPTY_SHARE)).otherwise(F.col(c) / F.col(n))

    terms = grid.withColumns({"r": share("c_ref", "n_ref"), "c": share("c_cur", "n_cur")})
    psi_raw = terms.groupBy(FEATURE).agg(F.abs(F.sum((F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r")))).alias("psi"))
    small = (F.col("n_ref") < 2) | (F.col("n_cur") < 2)
    stats = sizes.join(psi_raw, FEATURE, "left").select(
        FEATURE,
        F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0) | F.col("psi").isNull(), F.lit(0.0)).otherwise(F.col("psi")).alias("psi"),
        F.when(small, F.lit(0.0)).otherwise(F.coalesce(F.col("ks_stat"), F.lit(0.0))).alias("ks_stat"),
        "n_ref",
        "n_cur",
    )
    return hist, stats


def histogram(samples: DataFrame, buckets: int = PSI_BUCKETS, **seq_kw) -> DataFrame:
    """Counts per (feature, sample, bin) over the reference's percentile edges, all bins present."""
    return drift_statistics(samples, buckets, **seq_kw)[0]


def psi(samples: DataFrame, buckets: int = PSI_BUCKETS, **seq_kw) -> DataFrame:
    """``|sum((c - r) * ln(c / r))|`` over bins, shares of empty bins set to 1e-4 (no
    re-normalising); 0 when either sample is empty. Returns (feature, psi)."""
    return drift_statistics(samples, buckets, **seq_kw)[1].select(FEATURE, "psi")


def ks_statistic(samples: DataFrame, **seq_kw) -> DataFrame:
    """Two-sample KS distance per feature: max |F_ref - F_cur| over distinct values, from the
    running counts. Returns (feature, ks_stat, n_ref, n_cur); fewer than 2 values -> 0."""
    return drift_statistics(samples, **seq_kw)[1].select(FEATURE, "ks_stat", "n_ref", "n_cur")


def ks_pvalue_expr(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value ``2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lambda^2)`` with
    ``lambda = D * sqrt(n m / (n + m))``, 100 terms, clamped to [0, 1]; 1 for lambda < 0.2 (the
    series does not converge there); 1 when a sample has fewer than 2 values."""
    nd, md = n.cast("double"), m.cast("double")
    lam = d * F.sqrt(nd * md / (nd + md))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return F.when((n < 2) | (m < 2), F.lit(1.0)).when(lam < KS_SMALL_LAMBDA, F.lit(1.0)).otherwise(p)


def ks_exact_pvalue(d: float, n: int, m: int) -> float:
    """Exact two-sided P(D >= d) for two samples of sizes ``n``, ``m`` under the null (continuous
    data): 1 - (monotone lattice paths from (0,0) to (n,m) that stay strictly inside the band
    |i*m - j*n| < h*gcd(n,m), with h = round(d * lcm(n,m))) / C(n+m, n). Each lattice row is a
    cumulative sum over one contiguous interval; rows are rescaled to stay in range."""
    import math

    import numpy as np

    if n < 1 or m < 1:
        return 1.0
    g = math.gcd(n, m)
    lcm = n // g * m
    h = int(round(d * lcm))
    if h <= 0:
        return 1.0
    bound = h * g
    row = np.zeros(m + 1)
    hi0 = min(m, -((-bound) // n) - 1)  # j * n < bound
    row[: hi0 + 1] = 1.0
    log_scale = 0.0
    for i in range(1, n + 1):
        lo = max(0, (i * m - bound) // n + 1)
        hi = min(m, -((-(i * m + bound)) // n) - 1)
        new = np.zeros(m + 1)
        if lo <= hi:
            new[lo : hi + 1] = np.cumsum(row[lo : hi + 1])
        top = new.max()
        if top <= 0:
            return 1.0
        row = new / top
        log_scale += math.log(top)
    if row[m] <= 0:
        return 1.0
    log_inside = log_scale + math.log(row[m]) - (math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1))
    return float(min(1.0, max(0.0, 1.0 - math.exp(log_inside))))


# The library's automatic choice uses the exact path up to this sample size.
KS_EXACT_MAX_N = 10_000


def _exact_udf():
    @F.pandas_udf("double")
    def exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) else ks_exact_pvalue(float(a), int(b), int(c)) for a, b, c in zip(d, n, m)], dtype="float64")

    return exact


def ks_test(samples: DataFrame, method: str = "asymptotic", **seq_kw) -> DataFrame:
    """T2 + T3: (feature, ks_stat, ks_pval, n_ref, n_cur).

    ``method``: ``asymptotic`` (the Kolmogorov series, SQL-expressible), ``exact`` (lattice-path
    count), or ``auto`` (exact when both samples have at most 10,000 values). The exact path runs
    on the per-feature statistics table (one row per feature), not on the data."""
    d = ks_statistic(samples, **seq_kw)
    return d.withColumn("ks_pval", ks_pvalue(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur"), method))


def ks_pvalue(d: Column, n: Column, m: Column, method: str = "asymptotic") -> Column:
    """T3 p-value column for the chosen ``method`` (see :func:`ks_test`)."""
    asym = ks_pvalue_expr(d, n, m)
    if method == "asymptotic":
        return asym
    exact = F.when((n < 1) | (m < 1), F.lit(1.0)).otherwise(_exact_udf()(d, n, m))
    if method == "exact":
        return exact
    if method == "auto":
        return F.coalesce(ks_small_exact(d, n, m), asym)
    raise ValueError(f"method must be 'asymptotic', 'exact' or 'auto', got {method!r}")


def ks_small_exact(d: Column, n: Column, m: Column, max_n: int = KS_EXACT_MAX_N) -> Column:
    """Exact p-value where both whole samples have at most ``max_n`` values, else NULL. A UDF is
    evaluated for every row, whatever condition stands around it: larger ones reach it as NULL."""
    return _exact_udf()(F.when(F.greatest(n, m) <= max_n, d), n, m)


def ks_test_exact(samples: DataFrame, max_n: int = KS_EXACT_MAX_N, **seq_kw) -> DataFrame:
    """T2 + T3 over whole samples: (feature, ks_stat, ks_pval_exact, ks_pval_asymptotic, n_ref,
    n_cur). ``ks_pval_exact`` is NULL where a sample has more than ``max_n`` values, the series is
    given for all. The features are dealt over the tasks, since each exact value costs n_ref * n_cur."""
    stats = ks_statistic(samples, **seq_kw)
    parts = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d, n, m = F.col("ks_stat"), F.col("n_ref"), F.col("n_cur")
    return stats.repartition(parts, FEATURE).select(
        FEATURE, "ks_stat", ks_small_exact(d, n, m, max_n).alias("ks_pval_exact"),
        ks_pvalue_expr(d, n, m).alias("ks_pval_asymptotic"), "n_ref", "n_cur",
    )


def drift_table(samples: DataFrame, method: str = "asymptotic", **seq_kw) -> DataFrame:
    """T1-T3 per feature in one pass: (feature, psi, ks_stat, ks_pval, n_ref, n_cur)."""
    stats = drift_statistics(samples, **seq_kw)[1]
    return stats.withColumn("ks_pval", ks_pvalue(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur"), method))


def drift_report(
    samples: DataFrame, psi_threshold: float = PSI_THRESHOLD, alpha: float = KS_ALPHA, method: str = "asymptotic",
    **seq_kw,
) -> DataFrame:
    """T4 per feature: psi, ks_stat, ks_pval rounded to 4 digits, ``drifted`` when
    psi >= threshold or p < alpha (raw values). Features without current values are skipped."""
    r = drift_table(samples, method, **seq_kw).where(F.col("n_cur") > 0)
    return r.select(
        FEATURE,
        F.round("psi", 4).alias("psi"),
        F.round("ks_stat", 4).alias("ks_stat"),
        F.round("ks_pval", 4).alias("ks_pval"),
        ((F.col("psi") >= psi_threshold) | (F.col("ks_pval") < alpha)).alias("drifted"),
    )


def drift_summary(report: DataFrame, psi_threshold: float = PSI_THRESHOLD, mode: str = "matrix") -> DataFrame:
    """T4/T5 verdict. ``matrix``: some feature drifted and max rounded psi >= threshold.
    ``any``: some feature drifted. Returns one row."""
    agg = report.agg(
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col(FEATURE)))).alias("drifted_features"),
        F.count(F.lit(1)).alias("n_features"),
    )
    any_drift = F.size("drifted_features") > 0
    if mode == "matrix":
        verdict = any_drift & (F.col("max_psi") >= psi_threshold)
    elif mode == "any":
        verdict = any_drift
    else:
        raise ValueError(f"mode must be 'matrix' or 'any', got {mode!r}")
    return agg.withColumn("is_drift_detected", verdict)


def retrain_decision(summary: DataFrame | None, has_baseline: bool = True) -> DataFrame:
    """(retrain, reason). Missing history or baseline -> retrain with a reason."""
    if summary is None or not has_baseline:
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        reason = "No baseline history exists" if summary is None else "Initial Model Setup"
        return spark.createDataFrame([(True, reason)], "retrain boolean, reason string")
    return summary.select(
        F.col("is_drift_detected").alias("retrain"),
        F.format_string("Max PSI: %.4f", F.col("max_psi")).alias("reason"),
    )


def positional_drift_samples(
    df: DataFrame,
    order_cols: Sequence[str],
    *,
    half_features: Sequence[str] = ("price",),
    head_tail_features: Sequence[str] = ("quantity",),
    head_tail: int = 1000,
    group_cols: Sequence[str] = (),
    **seq_kw,
) -> DataFrame:
    """Samples by row position (W18): first vs second half for ``half_features``, first vs
    last ``head_tail`` rows for ``head_tail_features``. Keeps ``group_cols``."""
    s = positional_slices(df, order_cols, group_cols, head=head_tail, tail=head_tail, **seq_kw)
    parts = []
    for f in half_features:
        parts.append(
            s.select(*group_cols, F.lit(f).alias(FEATURE),
                     F.when(F.col("half") == "first", "ref").otherwise("cur").alias(SAMPLE),
                     F.col(f).cast("double").alias(VALUE))
        )
    for f in head_tail_features:
        tag = F.filter(F.array(F.when(F.col("in_head"), F.lit("ref")), F.when(F.col("in_tail"), F.lit("cur"))),
                       lambda x: x.isNotNull())
        parts.append(
            s.where(F.col("in_head") | F.col("in_tail")).select(
                *group_cols, F.lit(f).alias(FEATURE), F.explode(tag).alias(SAMPLE), F.col(f).cast("double").alias(VALUE)
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
