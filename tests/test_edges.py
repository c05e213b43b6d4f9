"""Edge cases: grouped contracts, latest-wins keys, positional slices and splits on odd/small sizes."""

from pyspark.sql import functions as F

from conftest import tick_ramp
from tickforge.operators import contracts, silver
from tickforge.operators.sequence import positional_slices, temporal_split
from tickforge.schema import TRADE_SCHEMA


def test_dataset_contract_per_day(spark):
    t = tick_ramp(spark, 30).withColumn("ds", F.when(F.col("trade_id") <= 10, "d1").otherwise("d2"))
    r = {row.ds: row for row in contracts.dataset_contract(t, min_rows=15, group_cols=["ds"]).collect()}
    assert r["d1"].total_rows == 10 and not r["d1"].checks_passed
    assert r["d2"].total_rows == 20 and r["d2"].checks_passed


def test_latest_wins_keeps_one_row_per_key(spark):
    rows = [(1, 10.0, 1.0, 10.0, 5, True, True), (1, 12.0, 1.0, 12.0, 5, True, True), (1, 9.0, 1.0, 9.0, 6, True, True)]
    df = spark.createDataFrame(rows, TRADE_SCHEMA).withColumn("partition_date", F.lit("d"))
    out = silver.olap_projection(silver.latest_wins(df)).orderBy("timestamp").collect()
    assert [(r.timestamp, r.price) for r in out] == [(5, 12.0), (6, 9.0)]
    assert out[0].is_buyer_maker == 1 and isinstance(out[0].is_buyer_maker, int)


def test_slices_and_split_small_and_odd(spark):
    t = tick_ramp(spark, 7)
    s = positional_slices(t, ["timestamp", "trade_id"], head=3, tail=3).orderBy("seq").collect()
    assert [r.half for r in s] == ["first"] * 3 + ["second"] * 4  # iloc[:7 // 2]
    assert [r.in_head for r in s] == [True] * 3 + [False] * 4
    assert [r.in_tail for r in s] == [False] * 4 + [True] * 3
    sp = temporal_split(t, ["timestamp", "trade_id"], test_ratio=0.2).orderBy("seq").collect()
    assert [r.split for r in sp] == ["train"] * 5 + ["test"] * 2  # int(7 * 0.8) = 5
    one = temporal_split(tick_ramp(spark, 1), ["timestamp", "trade_id"]).collect()
    assert [r.split for r in one] == ["test"]  # int(1 * 0.8) = 0
