"""Queries: file round trips through the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.operators import features as feat
from tickforge.operators import silver
from tickforge.plans.q_features import gold_all, gold_sql
from tickforge.plans.registry import register
from tickforge.plans.rounding import fround, sql_fround
from tickforge.plans.sql_tapes import E_TAPE, with_tapes
from tickforge.schema import RAW_TRADE_SCHEMA, TRADE_COLS
from tickforge.session import scratch_dir
from tickforge.sources import files, sinks
from tickforge.sources.tapes import EVENTS_ORDER, tape_events

_E7 = with_tapes(E_TAPE) + '\nSELECT trade_id, price, quantity, quote_quantity, "timestamp", is_buyer_maker, is_best_match FROM e'


def _e7(spark, sf):
    return tape_events(spark, sf).select(*TRADE_COLS)


@register("zip_csv_roundtrip", "S4 S1 S2", _E7)
def q_zip_csv_roundtrip(spark, sf):
    root = scratch_dir(spark, "zip")
    sinks.write_zip_archives(_e7(spark, sf), root).count()
    return files.coerce_trades(files.read_trades_zip(spark, root), recompute_quote=False).select(*TRADE_COLS)


@register("csv_header_sniff", "S3 S1 S2", _E7)
def q_csv_header_sniff(spark, sf):
    root = scratch_dir(spark, "csvh")
    _e7(spark, sf).write.option("header", True).csv(root)
    return files.coerce_trades(files.read_trades_csv_sniffed(spark, root), recompute_quote=False).select(*TRADE_COLS)


@register(
    "csv_sink_roundtrip",
    "K4 S1",
    with_tapes(E_TAPE)
    + '\nSELECT trade_id, price, quantity, quote_quantity, "timestamp", is_buyer_maker, is_best_match, ds AS day FROM e',
)
def q_csv_sink_roundtrip(spark, sf):
    root = scratch_dir(spark, "csvday")
    sinks.write_csv_days(tape_events(spark, sf).select(*TRADE_COLS, F.col("ds").alias("day")), root)
    back = spark.read.schema(RAW_TRADE_SCHEMA.add("day", "string")).csv(root)
    return files.coerce_trades(back, recompute_quote=False).select(*TRADE_COLS, "day")


def _macro(df):
    """A daily macro-style snapshot derived from the tape (one row per day)."""
    signed = F.sum(F.when(F.col("is_buyer_maker"), -F.col("quantity")).otherwise(F.col("quantity")))
    return df.groupBy(F.col("ds").alias("partition_date")).agg(
        fround(F.avg("price") / 100.0, 4).alias("us_10y_treasury_yield"),
        fround(F.avg("quantity") * 10.0, 4).alias("dxy_dollar_index"),
        fround(F.sum("quote_quantity") / 1000.0, 4).alias("global_m2_liquidity_index"),
        F.signum(signed).cast("int").alias("market_regime_sentiment"),
    )


@register(
    "json_macro_roundtrip",
    "S9",
    with_tapes(E_TAPE)
    + f"""
SELECT ds AS partition_date, {sql_fround('avg(price) / 100.0', 4)} AS us_10y_treasury_yield,
       {sql_fround('avg(quantity) * 10.0', 4)} AS dxy_dollar_index,
       {sql_fround('sum(quote_quantity) / 1000.0', 4)} AS global_m2_liquidity_index,
       CAST(sign(sum(CASE WHEN is_buyer_maker THEN -quantity ELSE quantity END)) AS INTEGER) AS market_regime_sentiment
FROM e GROUP BY ds""",
)
def q_json_macro_roundtrip(spark, sf):
    root = scratch_dir(spark, "macro")
    sinks.write_json(_macro(tape_events(spark, sf)), root)
    return files.read_macro_json(spark, root, multi_line=False)


@register(
    "silver_write_read_prune",
    "K1 K2 S5 S7 X1 O1",
    with_tapes(E_TAPE)
    + """
, d AS (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY "timestamp" DESC, price DESC, quantity DESC,
                                     quote_quantity DESC) AS rn FROM e WHERE price > 0 AND quantity > 0)
SELECT trade_id, price, quantity, quote_quantity, "timestamp", is_buyer_maker, is_best_match, ds AS partition_date
FROM d WHERE rn = 1""",
)
def q_silver_write_read_prune(spark, sf):
    root = scratch_dir(spark, "lake")
    t = tape_events(spark, sf)
    # Bronze: capped chunk files (K1); their path list is read back as one scan.
    sinks.write_chunks(t.drop("symbol"), f"{root}/bronze", max_rows=sinks.CHUNK_ROWS)
    chunks = files.read_parquet_chunks(spark, spark.read.parquet(f"{root}/bronze").inputFiles())
    # Silver: filter, newest-wins dedupe, typed projection, written by day (K2, O1).
    sinks.write_partitions(silver.silver(chunks), f"{root}/silver", "partition_date")
    back = files.read_partition(spark, f"{root}/silver", None, "partition_date")  # all days (S7)
    return back.select(*TRADE_COLS, "partition_date")


@register(
    "silver_one_day",
    "S6 K2",
    with_tapes(E_TAPE)
    + """
, d AS (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY "timestamp" DESC, price DESC, quantity DESC,
                                     quote_quantity DESC) AS rn FROM e WHERE price > 0 AND quantity > 0)
SELECT trade_id, price, quantity, quote_quantity, "timestamp", is_buyer_maker, is_best_match, ds AS partition_date
FROM d WHERE rn = 1 AND ds = (SELECT max(ds) FROM d WHERE rn = 1)""",
)
def q_silver_one_day(spark, sf):
    """The newest day of the lake alone: a partition filter, no file of another day is read."""
    root = scratch_dir(spark, "lake-day")
    sinks.write_partitions(silver.silver(tape_events(spark, sf)), root, "partition_date")
    day = spark.read.parquet(root).agg(F.max(F.col("partition_date").cast("string"))).first()[0]
    return files.read_partition(spark, root, day, "partition_date").select(*TRADE_COLS, "partition_date")


@register("gold_write_read", "K3 S7 F1", gold_sql("ds"))
def q_gold_write_read(spark, sf):
    root = scratch_dir(spark, "gold")
    g = feat.gold_features(tape_events(spark, sf), group_cols=["ds"], order_cols=EVENTS_ORDER)
    sinks.write_partitions(g, root, "ds")
    back = files.read_partition(spark, root)
    return gold_all(back)


@register(
    "coerced_dirty_strings",
    "S2 S10 P3 E5",
    with_tapes(E_TAPE)
    + """
, d AS (SELECT trade_id,
               CASE WHEN trade_id % 97 = 0 THEN NULL ELSE price END AS price,
               CASE WHEN trade_id % 83 = 0 THEN NULL ELSE quantity END AS quantity,
               "timestamp",
               CASE WHEN trade_id % 89 = 0 THEN NULL ELSE is_buyer_maker END AS is_buyer_maker,
               is_best_match
        FROM e)
SELECT trade_id, price, quantity, price * quantity AS quote_quantity, "timestamp", is_buyer_maker, is_best_match FROM d""",
)
def q_coerced_dirty_strings(spark, sf):
    t = _e7(spark, sf)
    tid = F.col("trade_id")
    s = t.select(*[F.col(c).cast("string").alias(c) for c in TRADE_COLS])
    s = s.withColumns(
        {
            "price": F.when(tid % 97 == 0, F.lit("n/a")).otherwise(F.col("price")),
            "quantity": F.when(tid % 83 == 0, F.lit("")).otherwise(F.col("quantity")),
            "is_buyer_maker": F.when(tid % 89 == 0, F.lit("maybe")).otherwise(F.col("is_buyer_maker")),
        }
    )
    return files.coerce_trades(s, recompute_quote=True).select(*TRADE_COLS)
