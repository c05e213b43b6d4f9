"""Scale guard: properties of the physical plans (checked on the smallest tables)."""

from conftest import SF001
from tickforge.operators import bars, drift, features
from tickforge.sources.tapes import EVENTS_ORDER, tape_events


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_grouped_features_have_no_single_partition(spark):
    plan = executed(features.gold_features(tape_events(spark, SF001), group_cols=["symbol"], order_cols=EVENTS_ORDER))
    assert "SinglePartition" not in plan
    assert "_tf_block" in plan  # windows run per (group, block)


def test_grouped_ks_has_no_single_partition(spark):
    from pyspark.sql import functions as F

    s = drift.positional_drift_samples(tape_events(spark, SF001), EVENTS_ORDER, head_tail_features=(),
                                       group_cols=["symbol"])
    plan = executed(drift.ks_test(s.select(F.col("symbol").alias("feature"), "sample", "value")))
    assert "SinglePartition" not in plan


def test_bars_are_hash_aggregated(spark):
    t = tape_events(spark, SF001)
    for df in (bars.ohlcv(t, bars.HOUR_MS, ["symbol"]), bars.merge_partials(bars.ohlcv_partials(t), bars.DAY_MS)):
        plan = executed(df)
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_archive_listing_reads_paths_only(spark):
    df = spark.read.format("binaryFile").load(SF001).select("path")
    assert "ReadSchema: struct<path:string>" in executed(df)


def test_trade_columns_are_pruned(spark):
    plan = executed(tape_events(spark, SF001).select("trade_id", "price"))
    assert "props" not in plan and "ReadSchema: struct<event_id:bigint,value:double>" in plan
