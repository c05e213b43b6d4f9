"""Bronze -> Silver: positive filter, newest-wins dedupe, typed projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.columns import ds_from_ms, epoch_to_ms
from tickforge.operators.joins import attach
from tickforge.operators.sequence import content_hash
from tickforge.schema import TRADE_COLS

# Tie-breakers after the timestamp when two rows share an id ("larger wins").
DEDUPE_ORDER = ("timestamp", "price", "quantity", "quote_quantity")


def positive_filter(df: DataFrame) -> DataFrame:
    """Keep rows with price > 0 and quantity > 0 (NULLs are dropped by 3-valued logic)."""
    return df.where((F.col("price") > 0) & (F.col("quantity") > 0))


def recompute_quote(df: DataFrame) -> DataFrame:
    """Quote amount = price * quantity."""
    return df.withColumn("quote_quantity", F.col("price") * F.col("quantity"))


def quote_fallback(df: DataFrame, batch_cols: Sequence[str] = ()) -> DataFrame:
    """If the quote column is missing, or sums to 0 within a batch, recompute it for all
    rows of that batch. The per-batch sum is an aggregate attached back (no group window)."""
    if "quote_quantity" not in df.columns:
        return recompute_quote(df)
    batch_cols = list(batch_cols)
    key = batch_cols or ["_tf_batch"]
    base = df if batch_cols else df.withColumn("_tf_batch", F.lit(1))
    sums = base.groupBy(*key).agg(F.coalesce(F.sum("quote_quantity"), F.lit(0.0)).alias("_tf_qsum"))
    out = attach(base, sums, key)
    out = out.withColumn(
        "quote_quantity",
        F.when(F.col("_tf_qsum") == 0, F.col("price") * F.col("quantity")).otherwise(F.col("quote_quantity")),
    ).drop("_tf_qsum")
    return out if batch_cols else out.drop("_tf_batch")


def dedupe_latest(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str] = DEDUPE_ORDER) -> DataFrame:
    """One row per key, the one with the largest ``order_cols`` (newest first).

    Written as ``max_by`` in a hash aggregate rather than ``row_number`` in a window: the
    aggregate combines map-side, so a key that holds a large share of the rows is reduced
    on every mapper before the shuffle."""
    key_cols = list(key_cols)
    payload = [c for c in df.columns if c not in key_cols]
    # A content hash closes remaining ties, so the kept row never depends on processing order.
    order = F.struct(*[F.col(c) for c in order_cols], content_hash(df, payload).alias("_tf_h"))
    picked = df.groupBy(*key_cols).agg(F.max_by(F.struct(*[F.col(c) for c in payload]), order).alias("_tf_row"))
    return picked.select(*key_cols, *[F.col(f"_tf_row.{c}").alias(c) for c in payload]).select(*df.columns)


def silver(
    df: DataFrame,
    ds: str | None = None,
    *,
    order_cols: Sequence[str] = DEDUPE_ORDER,
    ts_unit: str = "ms",
) -> DataFrame:
    """P1 -> D1 -> P2: filter first (a newer bad row does not shadow an older good one),
    keep the newest row per ``trade_id``, cast, add ``partition_date`` (given ``ds`` or the
    UTC date of each row)."""
    kept = dedupe_latest(positive_filter(df), ["trade_id"], order_cols)
    part = F.lit(ds) if ds is not None else ds_from_ms(epoch_to_ms(F.col("timestamp"), ts_unit))
    return kept.select(
        F.col("trade_id").cast("bigint").alias("trade_id"),
        F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"),
        F.col("quote_quantity").cast("double").alias("quote_quantity"),
        F.col("timestamp").cast("bigint").alias("timestamp"),
        F.col("is_buyer_maker").cast("boolean").alias("is_buyer_maker"),
        F.col("is_best_match").cast("boolean").alias("is_best_match"),
        part.alias("partition_date"),
    )


def partition_counts(df: DataFrame, partition_col: str = "partition_date") -> DataFrame:
    """K6: rows per partition after a load (a grouped count; pruned when filtered on one day)."""
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n_rows"))


def olap_projection(df: DataFrame) -> DataFrame:
    """K5 type mapping: flags as 0/1 integers, partition column as string."""
    return df.select(
        *[c for c in TRADE_COLS if c not in ("is_buyer_maker", "is_best_match")],
        F.when(F.col("is_buyer_maker"), 1).otherwise(0).cast("tinyint").alias("is_buyer_maker"),
        F.when(F.col("is_best_match"), 1).otherwise(0).cast("tinyint").alias("is_best_match"),
        F.col("partition_date").cast("string").alias("partition_date"),
    )


def latest_wins(
    df: DataFrame,
    key_cols: Sequence[str] = ("partition_date", "trade_id", "timestamp"),
    order_cols: Sequence[str] = ("price", "quantity", "quote_quantity"),
) -> DataFrame:
    """Replacing-merge semantics, one row per sorting key inside each partition."""
    return dedupe_latest(df, key_cols, order_cols)


def union_chunks(*frames: DataFrame) -> DataFrame:
    """UNION ALL of chunks by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
