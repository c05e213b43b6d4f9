"""Queries: day sketches, their quantiles against exact ranks, and drift between day ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.functions.columns import ds_from_ms
from tickforge.operators import drift, sketches
from tickforge.plans.registry import register
from tickforge.plans.sql_tapes import E_TAPE, with_tapes
from tickforge.session import scratch_dir
from tickforge.sources.tapes import tape_events

FEATURES = ("price", "quantity", "quote_quantity")
PROBS = tuple(i / 10 for i in range(1, 10))
_LONG = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, ds FROM e" for f in FEATURES)


def _stored(spark, tape):
    """The table of day sketches, written once and read back."""
    root = scratch_dir(spark, "day-sketches")
    sketches.day_sketches(tape, FEATURES).write.partitionBy("ds").parquet(root)
    return spark.read.parquet(root).withColumn("ds", F.col("ds").cast("string"))


def _long(tape):
    stack = ", ".join(f"'{f}', CAST({f} AS DOUBLE)" for f in FEATURES)
    return tape.selectExpr("ds", f"stack({len(FEATURES)}, {stack}) AS (feature, value)")


@register(
    "sketch_quantile_ranks",
    "A7 T4",
    with_tapes(E_TAPE)
    + f""", x AS ({_LONG})
SELECT feature, CAST(p AS DOUBLE) AS p, count(*) AS n, true AS within
FROM x, (SELECT unnest([{", ".join(map(str, PROBS))}]) AS p) GROUP BY ALL""",
)
def q_sketch_quantile_ranks(spark, sf):
    """Quantiles from the merged sketches of all days; ``within``: the exact rank of each lies within
    the stated bound of the one asked for."""
    tape = tape_events(spark, sf)
    asked = sketches.sketch_quantiles(sketches.merged(_stored(spark, tape)), PROBS)
    asked = asked.select("feature", F.posexplode("quantiles").alias("at", "q"))  # a row a (feature, p)
    met = _long(tape).join(F.broadcast(asked), "feature")
    ranks = met.groupBy("feature", "at").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") < F.col("q")).alias("lt"), F.count_if(F.col("value") <= F.col("q")).alias("le")
    )
    p = F.get(F.array(*[F.lit(x) for x in PROBS]), F.col("at"))
    bound = sketches.rank_error()
    return ranks.select("feature", p.alias("p"), "n", ((F.col("lt") / F.col("n") - bound <= p) & (p <= F.col("le") / F.col("n") + bound)).alias("within"))


@register(
    "sketch_drift_days",
    "A7 T1 T2 T4",
    with_tapes(E_TAPE)
    + f""", x AS ({_LONG}),
mid AS (SELECT strftime(make_timestamp((min("timestamp") + max("timestamp")) // 2 * 1000), '%Y-%m-%d') AS d FROM e)
SELECT feature, CAST(count_if(ds < d) AS BIGINT) AS n_ref, CAST(count_if(ds >= d) AS BIGINT) AS n_cur, true AS within FROM x, mid GROUP BY feature""",
)
def q_sketch_drift_days(spark, sf):
    """Drift of the later days against the earlier ones from stored sketches alone; ``within``: the
    KS distance is that of all rows but for the sketches' stated error and the comparison's grid."""
    tape = tape_events(spark, sf)
    lo, hi = tape.agg(F.min("timestamp"), F.max("timestamp")).first()
    day = spark.range(1).select(ds_from_ms(F.lit(((lo or 0) + (hi or 0)) // 2))).first()[0]
    got = sketches.sketch_drift(_stored(spark, tape), F.col("ds") < day, F.col("ds") >= day)
    rows = _long(tape).select("feature", F.when(F.col("ds") < day, "ref").otherwise("cur").alias("sample"), "value")
    exact = drift.ks_statistic(rows).select("feature", F.col("ks_stat").alias("exact"))
    return got.join(exact, "feature").select("feature", "n_ref", "n_cur", (F.abs(F.col("ks_stat") - F.col("exact")) <= sketches.drift_error()).alias("within"))
