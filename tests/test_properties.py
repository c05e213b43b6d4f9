"""Property tests (hypothesis) on small random frames; few examples, since each runs Spark jobs."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickforge.operators import drift, silver
from tickforge.operators.sequence import drop_helpers, exact_quantiles, with_sequence
from tickforge.schema import TRADE_SCHEMA

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 20), st.integers(0, 10_000)),
    min_size=1,
    max_size=60,
    unique_by=lambda r: r[2],
)


@SETTINGS
@given(data=rows, per_bucket=st.integers(1, 25))
def test_seq_matches_pandas_rank(spark, data, per_bucket):
    pdf = pd.DataFrame(data, columns=["g", "t", "id"])
    s = drop_helpers(with_sequence(spark.createDataFrame(pdf), ["t", "id"], ["g"], rows_per_bucket=per_bucket)).toPandas()
    exp = pdf.sort_values(["g", "t", "id"]).assign(seq=lambda d: d.groupby("g").cumcount())
    m = s.merge(exp, on="id", suffixes=("", "_exp"))
    assert len(m) == len(pdf) and (m["seq"] == m["seq_exp"]).all()


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(1, 8), st.integers(0, 5), st.integers(1, 9)), min_size=1, max_size=40))
def test_dedupe_idempotent_and_newest(spark, data):
    recs = [(tid, float(p), 1.0, float(p), ts, True, True) for tid, ts, p in data]
    df = spark.createDataFrame(recs, TRADE_SCHEMA)
    once = silver.dedupe_latest(df, ["trade_id"])
    assert once.exceptAll(silver.dedupe_latest(once, ["trade_id"])).count() == 0
    got = {r.trade_id: (r.timestamp, r.price) for r in once.collect()}
    for tid in {d[0] for d in data}:
        assert got[tid] == max((ts, float(p)) for t, ts, p in data if t == tid)


@SETTINGS
@given(
    values=st.lists(st.integers(-5, 5), min_size=2, max_size=50),
    probs=st.lists(st.floats(0, 1), min_size=1, max_size=5, unique=True),
)
def test_exact_quantiles_property(spark, values, probs):
    probs = sorted(probs)
    df = spark.createDataFrame(pd.DataFrame({"v": np.asarray(values, float)}))
    got = exact_quantiles(df, "v", probs, rows_per_bucket=7).collect()[0]["edges"]
    assert np.allclose(got, np.percentile(np.asarray(values, float), np.asarray(probs) * 100), atol=1e-12)


@SETTINGS
@given(ref=st.lists(st.integers(0, 9), min_size=2, max_size=40), cur=st.lists(st.integers(0, 9), min_size=2, max_size=40))
def test_ks_matches_definition(spark, ref, cur):
    a, b = np.sort(np.asarray(ref, float)), np.sort(np.asarray(cur, float))
    allv = np.concatenate([a, b])
    exp = np.max(np.abs(np.searchsorted(a, allv, "right") / len(a) - np.searchsorted(b, allv, "right") / len(b)))
    pdf = pd.concat([pd.DataFrame({"feature": "f", "sample": "ref", "value": a}),
                     pd.DataFrame({"feature": "f", "sample": "cur", "value": b})])
    got = drift.ks_statistic(spark.createDataFrame(pdf), rows_per_bucket=5).collect()[0]["ks_stat"]
    assert abs(got - exp) < 1e-12
