"""Sources and sinks: CSV typing, header sniffing, archives, partitions, JSON, records."""

import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tickforge.schema import TRADE_COLS
from tickforge.sources import files, sinks


def _tmp():
    return tempfile.mkdtemp(prefix="tf-io-")


def test_malformed_values_become_null(spark):
    d = _tmp()
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("1,10.5,2,21,1718265600000,true,false\n2,abc,1,x,1718265600001,maybe,1\n3,0,1,0,17e11,False,t\n")
    df = files.coerce_trades(files.read_trades_csv(spark, d)).orderBy("trade_id").collect()
    assert df[0].price == 10.5 and df[0].quote_quantity == 21.0 and df[0].is_buyer_maker is True
    assert df[1].price is None and df[1].is_buyer_maker is None and df[1].is_best_match is True
    assert df[2].price == 0.0 and df[2].timestamp is None


def test_header_sniff_mixed(spark):
    d = _tmp()
    with open(os.path.join(d, "h.csv"), "w") as fh:
        fh.write(",".join(TRADE_COLS) + "\n1,1,1,1,1,true,true\n")
    with open(os.path.join(d, "n.csv"), "w") as fh:
        fh.write("2,1,1,1,1,true,true\n")
    assert files.read_trades_csv_sniffed(spark, d).count() == 2


def test_zip_roundtrip_and_missing_member(spark):
    d = _tmp()
    df = files.from_records(spark, [{"trade_id": i, "price": 1.5, "quantity": 2.0, "quote_quantity": 3.0,
                                     "timestamp": 1_718_265_600_000 + i, "is_buyer_maker": i % 2 == 0,
                                     "is_best_match": True} for i in range(1, 101)])
    written = sinks.write_zip_archives(df.repartition(3), d).collect()
    assert sum(r.rows for r in written) == 100
    back = files.coerce_trades(files.read_trades_zip(spark, d), recompute_quote=False)
    assert back.exceptAll(df).count() == 0 and back.count() == 100
    bad = _tmp()
    with zipfile.ZipFile(os.path.join(bad, "x.zip"), "w") as zf:
        zf.writestr("readme.txt", "nothing")
    with pytest.raises(Exception, match="No CSV"):
        files.read_trades_zip(spark, bad).count()


def test_partitions_prune_and_replace(spark):
    root = _tmp() + "/t"
    t = spark.range(100).select(F.col("id").alias("trade_id"), (F.col("id") % 3).cast("string").alias("ds"),
                                F.col("id").alias("timestamp"))
    sinks.write_partitions(t, root, "ds")
    one = files.read_partition(spark, root, "1")
    assert one.count() == 33
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan or "PartitionFilters" in plan
    sinks.write_partitions(t.where("ds = '1'").limit(5), root, "ds")  # replaces only ds=1
    assert files.read_partition(spark, root).count() == 67 + 5
    with pytest.raises(FileNotFoundError):
        files.read_partition(spark, root, "9")
    with pytest.raises(ValueError):
        sinks.write_partitions(t.limit(0), root, "ds")


def test_macro_json_multiline(spark):
    d = _tmp()
    with open(os.path.join(d, "2024-06-13.json"), "w") as fh:
        fh.write('{\n "partition_date": "2024-06-13",\n "us_10y_treasury_yield": 4.2,\n "dxy_dollar_index": 104.1,\n'
                 ' "global_m2_liquidity_index": 1.0,\n "market_regime_sentiment": -1\n}\n')  # fmt: skip
    r = files.read_macro_json(spark, d).collect()
    assert len(r) == 1 and r[0].market_regime_sentiment == -1


def test_csv_days(spark):
    root = _tmp() + "/c"
    t = files.from_records(spark, [{"trade_id": 1, "price": 1.0}]).withColumn("day", F.lit("2024-06-13"))
    sinks.write_csv_days(t, root)
    assert os.path.isdir(os.path.join(root, "day=2024-06-13"))


def test_archives_are_dealt_by_size(spark):
    sizes = [(f"a{i}", s) for i, s in enumerate([900, 10, 20, 400, 30, 500, 40, 450, 50, 60, 300, 600])]
    plan = files.plan_archives(sizes, 4)
    loads = [sum(dict(sizes)[p] for p in part) for part in plan]
    assert sorted(p for part in plan for p in part) == sorted(p for p, _ in sizes)
    assert max(loads) <= 4 / 3 * max(900, sum(loads) / 4)
    assert len(files.plan_archives(sizes[:2], 4)) == 2

    d = _tmp()
    for i in range(12):
        with zipfile.ZipFile(os.path.join(d, f"{i}.zip"), "w") as zf:
            zf.writestr("t.csv", "".join(f"{i * 1000 + k},1,1,1,1,true,true\n" for k in range(5 * (i + 1) ** 2)))
    df = files.read_trades_zip(spark, d, tasks=4)
    per_task = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) == 4 and sum(per_task) == sum(5 * (i + 1) ** 2 for i in range(12))
    assert df.select("trade_id").distinct().count() == sum(per_task)
    assert files.read_trades_zip(spark, _tmp()).count() == 0


def test_one_day_reads_its_own_files_only(spark):
    root = _tmp()
    df = spark.range(90).select("id", F.format_string("2024-06-%02d", F.col("id") % 9 + 1).alias("ds"))
    df.write.mode("overwrite").partitionBy("ds").parquet(root)
    day = files.read_partition(spark, root, "2024-06-03")
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert "ds" in filters and "2024-06-03" in filters, filters
    touched = {r["f"] for r in day.select(F.input_file_name().alias("f")).collect()}
    assert day.count() == 10 and all("ds=2024-06-03" in f for f in touched)
    with pytest.raises(FileNotFoundError):
        files.read_partition(spark, root, "2024-06-30")
