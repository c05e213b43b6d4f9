"""Trade tapes built from the driver's tables (same expressions as the DuckDB oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.columns import ds_from_ms, epoch_ms

# Offset that lifts line-item ship dates above the contract's time floor.
LINEITEM_TIME_SHIFT_MS = 800_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tape_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean tape: one trade per event, symbol = event type."""
    return events_to_tape(table(spark, sf_dir, "events"))


def events_to_tape(ev: DataFrame) -> DataFrame:
    """The events -> trade tape projection (batch or streaming input)."""
    ts = epoch_ms(ev, "ts")
    qty = (F.col("user_id") % 7 + 1).cast("double")
    return ev.select(
        (F.col("event_id") + 1).alias("trade_id"),
        F.col("value").alias("price"),
        qty.alias("quantity"),
        (F.col("value") * qty).alias("quote_quantity"),
        ts.alias("timestamp"),
        F.col("event_type").isin("click", "error").alias("is_buyer_maker"),
        (F.col("event_type") != F.lit("signup")).alias("is_best_match"),
        F.col("event_type").alias("symbol"),
        ds_from_ms(ts).alias("ds"),
    )


def tape_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty tape: repeated trade ids, many time ties, 50 distinct quantities."""
    return lineitem_to_tape(table(spark, sf_dir, "lineitem"))


def lineitem_to_tape(li: DataFrame) -> DataFrame:
    """The line items -> trade tape projection (batch or streaming input)."""
    ts = epoch_ms(li, "l_shipdate") + F.lit(LINEITEM_TIME_SHIFT_MS)
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("quote_quantity"),
        ts.alias("timestamp"),
        (F.col("l_returnflag") == F.lit("R")).alias("is_buyer_maker"),
        (F.col("l_linestatus") == F.lit("O")).alias("is_best_match"),
        F.col("l_suppkey").cast("string").alias("symbol"),
        ds_from_ms(ts).alias("ds"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
    )


# Moduli that break rows of the line-item tape for the row-contract check.
BREAK_PRICE_MOD, BREAK_QUOTE_MOD, BREAK_TIME_MOD = 101, 103, 107


def tape_lineitem_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item tape with some rows broken by an expression on the id (all rows kept)."""
    t = tape_lineitem(spark, sf_dir)
    tid = F.col("trade_id")
    return t.withColumns(
        {
            "price": F.when(tid % BREAK_PRICE_MOD == 0, -F.col("price")).otherwise(F.col("price")),
            "quote_quantity": F.when(tid % BREAK_QUOTE_MOD == 0, F.col("quote_quantity") * 1.10).otherwise(
                F.col("quote_quantity")
            ),
            "timestamp": F.when(tid % BREAK_TIME_MOD == 0, F.col("timestamp") - F.lit(LINEITEM_TIME_SHIFT_MS)).otherwise(
                F.col("timestamp")
            ),
        }
    )


LINEITEM_ORDER = ("timestamp", "trade_id", "l_partkey", "l_suppkey")
EVENTS_ORDER = ("timestamp", "trade_id")
