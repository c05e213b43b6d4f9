"""Row and dataset contracts (the reference's cases plus NULL handling)."""

from pyspark.sql import functions as F

from tickforge.operators import contracts
from tickforge.schema import TRADE_SCHEMA


def test_valid_row(spark):
    df = spark.createDataFrame([(101, 3500.50, 1.2, 4200.60, 1718265600000, True, True)], TRADE_SCHEMA)
    r = contracts.row_contract(df).collect()[0]
    assert r["is_valid"] and r["violations"] == []


def test_invalid_row(spark):
    df = spark.createDataFrame([(102, -50.0, 1.0, -50.0, 1718265600000, False, None)], TRADE_SCHEMA)
    r = contracts.row_contract(df).collect()[0]
    assert not r["is_valid"] and "price" in r["violations"] and "quote_quantity" in r["violations"]
    assert r["is_best_match"] is True  # default applied
    ok, bad = contracts.split_by_contract(df)
    assert ok.count() == 0 and bad.count() == 1


def test_quote_mismatch_and_api_variant(spark):
    df = spark.createDataFrame([(1, 100.0, 1.0, 120.0, 1_200_000_000_000, None, None)], TRADE_SCHEMA)
    r = contracts.row_contract(df).collect()[0]
    assert set(r["violations"]) == {"quote_mismatch", "timestamp", "is_buyer_maker"}
    a = contracts.row_contract(df, "api").collect()[0]
    assert a["is_valid"] and a["is_buyer_maker"] is False


def frame(spark, n):
    return spark.createDataFrame([(i + 1, 3500.0, 0.1, 350.0, 1718265600000, True, True) for i in range(n)], TRADE_SCHEMA)


def test_dataset_contract_passes(spark):
    r = contracts.dataset_contract(frame(spark, 149), min_rows=100).collect()[0]
    assert r["checks_passed"] and r["errors"] == [] and r["total_rows"] == 149


def test_dataset_contract_short(spark):
    r = contracts.dataset_contract(frame(spark, 10), min_rows=100).collect()[0]
    assert not r["checks_passed"] and "below minimum threshold" in r["errors"][0]


def test_duplicates_nulls_and_empty(spark):
    df = frame(spark, 20).withColumn("trade_id", F.when(F.col("trade_id") <= 4, F.lit(None)).otherwise(F.col("trade_id") % 8))
    r = contracts.dataset_contract(df, min_rows=1).collect()[0]
    # 4 NULL ids count as one value: 20 rows, 8 distinct ids + 1 NULL value -> 11 duplicates
    assert r["duplicate_trades"] == 11 and r["max_null_pct"] == 0.2
    e = contracts.dataset_contract(frame(spark, 0), min_rows=1).collect()
    assert e[0]["total_rows"] == 0 and e[0]["max_null_pct"] == 0.0 and len(e[0]["errors"]) == 1


def test_null_rates_and_duplicate_count(spark):
    df = frame(spark, 10).withColumn("price", F.when(F.col("trade_id") <= 3, F.lit(None)).otherwise(F.col("price")))
    rates = {r.column_name: r.null_pct for r in contracts.null_rates(df, ["price", "quantity"]).collect()}
    assert rates == {"price": 0.3, "quantity": 0.0}
    dup = df.withColumn("trade_id", F.col("trade_id") % 4)  # values 0..3 over 10 rows
    assert contracts.duplicate_count(dup).collect()[0].duplicate_count == 6


def test_one_pass_quarantine(spark, tmp_path):
    rows = [(i, 10.0 if i % 3 else -1.0, 2.0, 20.0, 1718265600000, True if i % 5 else None, None) for i in range(1, 61)]
    df = spark.createDataFrame(rows, TRADE_SCHEMA)
    evaluated = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            evaluated.add(len(pdf))
            yield pdf

    good, bad, seen = contracts.write_by_contract(df.mapInPandas(counted, TRADE_SCHEMA), str(tmp_path / "q"))
    ok, not_ok = contracts.split_by_contract(df)
    assert good.exceptAll(ok).isEmpty() and good.count() == ok.count() == 32
    assert bad.exceptAll(not_ok).isEmpty() and bad.count() == not_ok.count() == 28
    assert evaluated.value == 60  # neither the measures nor the second side read the input again
    assert seen == {"total_rows": 60, "accepted_rows": 32, "invalid_prices": 20, "invalid_quantities": 0, "max_null_pct": 1 / 5}
    good, bad, seen = contracts.write_by_contract(df.limit(0), str(tmp_path / "empty"))
    assert good.count() == bad.count() == seen["total_rows"] == 0 and seen["max_null_pct"] == 0.0
