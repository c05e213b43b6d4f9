"""Driver contract: entry runs, every oracle has a query, names are aliased."""

import __spark_entry__ as entry_mod


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 80


def test_catalogue_keys():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70


def test_small_queries_run(spark):
    from conftest import SF001

    q = entry_mod.queries()
    for name in ["silver_dedupe", "ohlcv_1m", "psi", "gold_features_global", "online_lookup_fallback"]:
        assert q[name](spark, SF001).count() >= 0


def test_cluster_conf_sizes_partitions():
    from tickforge.session import cluster_conf

    c = cluster_conf(100 * 2**40, 1000, 8)
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600  # ~256 MB of input per partition
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(1, 2, 4)["spark.sql.shuffle.partitions"]) == 16  # at least 2 per core


def test_catalogue_needs_no_session():
    """queries() and oracle_sql() may be asked for before any session exists."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])
