"""Schemas of the trade tape, its raw string form and the macro snapshot."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the raw trade file (headerless CSV).
TRADE_COLS = ["trade_id", "price", "quantity", "quote_quantity", "timestamp", "is_buyer_maker", "is_best_match"]

TRADE_SCHEMA = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("quote_quantity", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
        T.StructField("is_best_match", T.BooleanType()),
    ]
)

RAW_TRADE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRADE_COLS])

MACRO_SCHEMA = T.StructType(
    [
        T.StructField("partition_date", T.StringType()),
        T.StructField("us_10y_treasury_yield", T.DoubleType()),
        T.StructField("dxy_dollar_index", T.DoubleType()),
        T.StructField("global_m2_liquidity_index", T.DoubleType()),
        T.StructField("market_regime_sentiment", T.IntegerType()),
    ]
)

# Default total order of a tape: time, then id (ties in time are common).
DEFAULT_ORDER = ("timestamp", "trade_id")
