"""Queries: histogram, PSI, KS, drift report and verdicts, drift request contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.operators import contracts, drift
from tickforge.plans.registry import register
from tickforge.plans.rounding import fround, sql_fround
from tickforge.plans.sql_tapes import E_TAPE, with_tapes
from tickforge.sources.tapes import EVENTS_ORDER, tape_events

_EDGES = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"

# Positional drift samples of the events tape: first and second half, for both features.
_SAMPLES = (
    with_tapes(E_TAPE)
    + """
, s AS (SELECT *, row_number() OVER (ORDER BY "timestamp", trade_id) - 1 AS seq, count(*) OVER () AS n FROM e),
smp AS (
  SELECT 'price' AS feature, CASE WHEN seq < n // 2 THEN 'ref' ELSE 'cur' END AS sample, price AS value FROM s
  UNION ALL SELECT 'quantity', CASE WHEN seq < n // 2 THEN 'ref' ELSE 'cur' END, quantity FROM s)"""
)

_HIST = f"""
, ed AS (SELECT feature, quantile_cont(value, {_EDGES}) AS edges FROM smp WHERE sample = 'ref' GROUP BY feature),
b AS (SELECT smp.feature, sample, len(list_filter(edges[2:10], lambda x: value >= x)) AS bin FROM smp JOIN ed USING (feature)),
grid AS (SELECT feature, v.sample, r.bin FROM ed, (VALUES ('ref'), ('cur')) v(sample), range(0, 10) r(bin)),
cnt AS (SELECT feature, sample, bin, count(*) AS c FROM b GROUP BY ALL),
hist AS (SELECT g.feature, g.sample, CAST(g.bin AS BIGINT) AS bin, CAST(coalesce(c, 0) AS BIGINT) AS count
         FROM grid g LEFT JOIN cnt ON g.feature = cnt.feature AND g.sample = cnt.sample AND g.bin = cnt.bin)"""

_PSI = """
, sz AS (SELECT feature, count_if(sample = 'ref') AS n_ref, count_if(sample = 'cur') AS n_cur FROM smp GROUP BY feature),
hw AS (SELECT feature, bin, sum(CASE WHEN sample = 'ref' THEN count END) AS c_ref, sum(CASE WHEN sample = 'cur' THEN count END) AS c_cur
       FROM hist GROUP BY feature, bin),
t AS (SELECT hw.feature, CASE WHEN c_ref = 0 THEN 1e-4 ELSE c_ref / n_ref END AS r,
             CASE WHEN c_cur = 0 THEN 1e-4 ELSE c_cur / n_cur END AS c FROM hw JOIN sz USING (feature)),
psi AS (SELECT feature, abs(sum((c - r) * ln(c / r))) AS psi FROM t GROUP BY feature)"""

_KS = """
, dv AS (SELECT feature, value, count_if(sample = 'ref') AS cr, count_if(sample = 'cur') AS cc FROM smp GROUP BY ALL),
cum AS (SELECT feature, sum(cr) OVER w / sum(cr) OVER (PARTITION BY feature) AS fr,
               sum(cc) OVER w / sum(cc) OVER (PARTITION BY feature) AS fc,
               sum(cr) OVER (PARTITION BY feature) AS n_ref, sum(cc) OVER (PARTITION BY feature) AS n_cur
        FROM dv WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks0 AS (SELECT feature, max(abs(fr - fc)) AS ks_stat, CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur
        FROM cum GROUP BY feature),
ks AS (SELECT feature, n_ref, n_cur, CASE WHEN n_ref < 2 OR n_cur < 2 THEN 0.0 ELSE ks_stat END AS ks_stat,
         CASE WHEN n_ref < 2 OR n_cur < 2 THEN 1.0
              WHEN ks_stat * sqrt(n_ref * n_cur / (n_ref + n_cur)) < 0.2 THEN 1.0
              ELSE least(greatest(2.0 * list_sum(list_transform(range(1, 101), lambda k:
                     (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END)
                     * exp(-2.0 * k * k * (ks_stat * sqrt(n_ref * n_cur / (n_ref + n_cur)))
                                         * (ks_stat * sqrt(n_ref * n_cur / (n_ref + n_cur)))))), 0.0), 1.0) END AS ks_pval
       FROM ks0)"""

_REPORT = """
, rep AS (SELECT psi.feature, round(psi, 4) AS psi, round(ks_stat, 4) AS ks_stat, round(ks_pval, 4) AS ks_pval,
                 psi >= 0.2 OR ks_pval < 0.01 AS drifted
          FROM psi JOIN ks USING (feature) WHERE n_cur > 0)"""


def _samples(spark, sf):
    return drift.positional_drift_samples(tape_events(spark, sf), EVENTS_ORDER, half_features=("price", "quantity"), head_tail_features=())


@register("histogram_bins", "A7 A8", _SAMPLES + _HIST + "\nSELECT * FROM hist")
def q_histogram_bins(spark, sf):
    h = drift.histogram(_samples(spark, sf))
    return h.withColumn("bin", F.col("bin").cast("bigint"))


@register("psi", "T1", _SAMPLES + _HIST + _PSI + f"\nSELECT feature, {sql_fround('psi')} AS psi FROM psi")
def q_psi(spark, sf):
    return drift.psi(_samples(spark, sf)).select("feature", fround("psi").alias("psi"))


@register("ks_statistic", "T2", _SAMPLES + _KS + "\nSELECT feature, ks_stat, n_ref, n_cur FROM ks")
def q_ks_statistic(spark, sf):
    return drift.ks_statistic(_samples(spark, sf)).select("feature", "ks_stat", "n_ref", "n_cur")


@register("ks_pvalue", "T3", _SAMPLES + _KS + f"\nSELECT feature, {sql_fround('ks_pval')} AS ks_pval FROM ks")
def q_ks_pvalue(spark, sf):
    return drift.ks_test(_samples(spark, sf)).select("feature", fround("ks_pval").alias("ks_pval"))


@register("drift_report_features", "T4", _SAMPLES + _HIST + _PSI + _KS + _REPORT + "\nSELECT * FROM rep")
def q_drift_report_features(spark, sf):
    return drift.drift_report(_samples(spark, sf))


@register(
    "drift_report_summary",
    "T4",
    _SAMPLES
    + _HIST
    + _PSI
    + _KS
    + _REPORT
    + """
SELECT coalesce(max(psi), 0.0) AS max_psi,
       coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE drifted)), ','), '') AS drifted_features,
       CAST(count(*) AS BIGINT) AS n_features,
       coalesce(len(list(feature) FILTER (WHERE drifted)), 0) > 0 AND coalesce(max(psi), 0.0) >= 0.2 AS is_drift_detected
FROM rep""",
)
def q_drift_report_summary(spark, sf):
    s = drift.drift_summary(drift.drift_report(_samples(spark, sf)), mode="matrix")
    return s.withColumn("drifted_features", F.array_join("drifted_features", ","))


@register(
    "retrain_decision",
    "T6",
    _SAMPLES
    + _HIST
    + _PSI
    + _KS
    + _REPORT
    + """
SELECT coalesce(len(list(feature) FILTER (WHERE drifted)), 0) > 0 AND coalesce(max(psi), 0.0) >= 0.2 AS retrain,
       printf('Max PSI: %.4f', coalesce(max(psi), 0.0)) AS reason
FROM rep""",
)
def q_retrain_decision(spark, sf):
    return drift.retrain_decision(drift.drift_summary(drift.drift_report(_samples(spark, sf))))


# Per-symbol two-vector checks (the scoring service's drift endpoint, verdict mode "any").
_SYM_SAMPLES = (
    with_tapes(E_TAPE)
    + """
, s AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id) - 1 AS seq,
               count(*) OVER (PARTITION BY symbol) AS n FROM e),
smp AS (SELECT symbol AS feature, CASE WHEN seq < n // 2 THEN 'ref' ELSE 'cur' END AS sample, price AS value FROM s)"""
)


def _sym_samples(spark, sf):
    s = drift.positional_drift_samples(
        tape_events(spark, sf), EVENTS_ORDER, head_tail_features=(), group_cols=["symbol"]
    )
    return s.select(F.col("symbol").alias("feature"), "sample", "value")


@register(
    "drift_check_any",
    "T5",
    _SYM_SAMPLES
    + _HIST
    + _PSI
    + _KS
    + """
SELECT psi.feature AS symbol, round(psi, 4) AS psi_score, round(ks_stat, 4) AS ks_statistic, round(ks_pval, 4) AS ks_pvalue,
       psi >= 0.2 OR ks_pval < 0.01 AS is_drift_detected
FROM psi JOIN ks USING (feature)""",
)
def q_drift_check_any(spark, sf):
    r = drift.drift_report(_sym_samples(spark, sf))
    return r.select(
        F.col("feature").alias("symbol"),
        F.col("psi").alias("psi_score"),
        F.col("ks_stat").alias("ks_statistic"),
        F.col("ks_pval").alias("ks_pvalue"),
        F.col("drifted").alias("is_drift_detected"),
    )


@register(
    "drift_request_check",
    "C4",
    _SYM_SAMPLES
    + """
SELECT feature AS symbol, CAST(count_if(sample = 'ref') AS BIGINT) AS n_ref, CAST(count_if(sample = 'cur') AS BIGINT) AS n_cur,
       count_if(sample = 'ref') >= 10 AND count_if(sample = 'cur') >= 10 AS is_valid
FROM smp GROUP BY feature""",
)
def q_drift_request_check(spark, sf):
    c = contracts.drift_request_check(_sym_samples(spark, sf), group_cols=["feature"], threshold=0.20)
    return c.withColumnRenamed("feature", "symbol")


@register("ks_pvalue_exact", "T3")
def q_ks_pvalue_exact(spark, sf):
    """First against second half of every row: of the whole table (scope ``table``), and of each
    symbol's day (scope ``symbol_day``). The exact p-value is given where both halves are small
    enough for its lattice, which has a point a pair of sample sizes; the series for all.
    No SQL oracle; the lattice count is tested against brute-force enumeration."""
    tape, parts = tape_events(spark, sf), []
    for scope, groups in (("table", []), ("symbol_day", ["symbol", "ds"])):
        s = drift.positional_drift_samples(tape, EVENTS_ORDER, half_features=("price", "quantity"), head_tail_features=(), group_cols=groups)
        key = F.struct(F.lit(scope).alias("scope"), "feature", *groups)
        parts.append(s.select(F.to_json(key).alias("feature"), "sample", "value"))
    key = F.from_json("feature", "scope string, feature string, symbol string, ds string")
    out = drift.ks_test_exact(parts[0].unionByName(parts[1])).withColumn("key", key)
    return out.select("key.*", "ks_stat", "ks_pval_exact", "ks_pval_asymptotic", "n_ref", "n_cur")
