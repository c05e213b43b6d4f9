"""Structured Streaming forms of the incremental operators.

* U1 ``stream_ohlcv``: watermark + tumbling window + the A1 aggregates.
* U2 ``first_wins_dedupe`` (``dropDuplicatesWithinWatermark``) and ``newest_wins_upsert``
  (``foreachBatch`` merge with D2 semantics into a partitioned table; only touched partitions
  are rewritten).
* U3 ``refresh_gold``: per micro-batch, upsert Silver, recompute Gold for the touched days from
  the whole Silver partition, publish the online table.
* U4 ``rolling_features_upsert``: row-frame windows are not allowed on streams, so each batch is
  featurised together with the last rows already seen, kept as a side table.
Runs use ``trigger(availableNow=True)`` for batch-like catch-up; checkpoints live under the
shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators import features as feat
from tickforge.operators import online, silver
from tickforge.schema import DEFAULT_ORDER
from tickforge.session import compilable_methods, scratch_dir
from tickforge.sources import sinks, versions

# Up to this many touched days a micro-batch names them in a partition filter.
MAX_LISTED_DAYS = 10_000


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A driver table (one parquet file in ``sf_dir``) as a file stream."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(sf_dir)


def event_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Watermarks need a TIMESTAMP: epoch ms -> instant (time-zone independent)."""
    return df.withColumn("event_time", F.timestamp_millis(F.col(col)))


def stream_ohlcv(
    tape: DataFrame,
    bar: str = "1 minute",
    watermark: str = "10 minutes",
    group_cols: Sequence[str] = (),
    order_cols: Sequence[str] = DEFAULT_ORDER,
) -> DataFrame:
    """Tumbling-window bars on a stream (append mode emits a bar once the watermark passes
    its end; update/complete re-emit changed bars)."""
    from tickforge.operators.bars import order_key

    order = order_key(tape, order_cols)
    signed = F.when(F.col("is_buyer_maker"), -F.col("quantity")).otherwise(F.col("quantity"))
    return (
        event_time(tape)
        .withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", bar).alias("w"), *group_cols)
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("quantity").alias("volume"),
            F.sum("quote_quantity").alias("quote_volume"),
            F.sum(signed).alias("order_flow_imbalance"),
        )
        .select(F.unix_millis(F.col("w.start")).alias("window_start"), *group_cols, "open", "high", "low", "close",
                "volume", "quote_volume", "order_flow_imbalance")
    )


def first_wins_dedupe(tape: DataFrame, key_cols: Sequence[str] = ("trade_id",), watermark: str = "1 hour") -> DataFrame:
    """U2 (first wins): drop later copies of a key seen within the watermark delay."""
    return event_time(tape).withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(list(key_cols))


def run_available_now(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
) -> None:
    """Process everything available, micro-batch by micro-batch, then stop."""
    q = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def _table_exists(spark: SparkSession, root: str) -> bool:
    """Whether the folder exists. Only its absence means a first batch: any other error of the
    store is raised, since an upsert that took it for absence would drop the old rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def newest_wins_upsert(
    batch: DataFrame,
    root: str,
    key_cols: Sequence[str],
    order_cols: Sequence[str],
    partition_col: str = "ds",
) -> DataFrame:
    """U2 (newest wins): merge a micro-batch into a partitioned table with D2 semantics.

    Only partitions present in the batch are read, merged (``max_by`` per key) and rewritten
    (dynamic overwrite). The merged rows are checkpointed to the shared folder first, so the
    write never reads the files it replaces. Returns the merged rows of the touched partitions."""
    spark = batch.sparkSession
    merged = batch
    if _table_exists(spark, root):
        days = batch.select(F.col(partition_col).cast("string").alias(partition_col)).distinct()
        old = spark.read.parquet(root).withColumn(partition_col, F.col(partition_col).cast("string"))
        touched = days.limit(MAX_LISTED_DAYS + 1).collect()
        if len(touched) <= MAX_LISTED_DAYS:
            # A literal list of touched days is a static partition filter: only they are read.
            old = old.where(F.col(partition_col).isin([r[0] for r in touched]))
        else:
            old = old.join(days, partition_col, "left_semi")
        merged = old.unionByName(batch.select(*old.columns))
    merged = silver.dedupe_latest(merged, [partition_col, *key_cols], order_cols).checkpoint(eager=True)
    sinks.write_partitions(merged, root, partition_col, sort_cols=[c for c in ("timestamp", *key_cols) if c in merged.columns],
                           allow_empty=True)
    return merged


def stream_dedupe_table(
    spark: SparkSession,
    stream_tape: DataFrame,
    key_cols: Sequence[str],
    order_cols: Sequence[str],
    partition_col: str = "ds",
    root: str | None = None,
) -> DataFrame:
    """U2 driver: run the newest-wins upsert over the whole stream and return the table."""
    root = root or scratch_dir(spark, "stream-dedupe")
    run_available_now(
        stream_tape,
        lambda b, _eid: newest_wins_upsert(b, root, key_cols, order_cols, partition_col),
        scratch_dir(spark, "ckpt-dedupe"),
    )
    return spark.read.parquet(root).withColumn(partition_col, F.col(partition_col).cast("string"))


def refresh_gold(
    batch: DataFrame,
    silver_root: str,
    gold_root: str,
    online_root: str | None = None,
    order_cols: Sequence[str] = DEFAULT_ORDER,
) -> None:
    """U3 micro-batch: Silver upsert of the touched days, Gold recomputed for those days from the
    full Silver partitions (so batch boundaries never change a feature), online table refresh."""
    spark = batch.sparkSession
    rows = silver.silver(batch)
    merged = newest_wins_upsert(rows, silver_root, ["trade_id"], ("timestamp", "price", "quantity", "quote_quantity"),
                                "partition_date")
    gold = feat.gold_features(merged, group_cols=["partition_date"], order_cols=order_cols)
    sinks.write_partitions(gold.checkpoint(eager=True), gold_root, "partition_date", allow_empty=True)
    if online_root is not None:
        g = spark.read.parquet(gold_root)
        # Two columns (at most LAST_N rows of them) tell since when the published rows are: all
        # columns are then read of those files and row groups only, not of the whole table.
        newest = [r["timestamp"] for r in online.last_rows(g.select("timestamp", "trade_id")).collect()]
        if newest and newest[0] is not None:
            recent = g if newest[-1] is None else g.where(F.col("timestamp") >= newest[-1])
            versions.publish(online.online_table(recent, newest[0]), online_root)
            versions.retire(spark, online_root)


def stream_gold_table(spark: SparkSession, stream_tape: DataFrame, root: str | None = None) -> DataFrame:
    """U3 driver: run the Silver -> Gold -> online refresh over the stream; return Gold."""
    root = root or scratch_dir(spark, "stream-gold")
    silver_root, gold_root, online_root = f"{root}/silver", f"{root}/gold", f"{root}/online"
    run_available_now(
        stream_tape,
        lambda b, _eid: refresh_gold(b, silver_root, gold_root, online_root),
        scratch_dir(spark, "ckpt-gold"),
    )
    compilable_methods(spark)  # batches run in a session of their own; the rows are wide here, too
    return spark.read.parquet(gold_root).withColumn("partition_date", F.col("partition_date").cast("string"))


def stream_ohlcv_table(spark: SparkSession, bars_stream: DataFrame, root: str | None = None) -> DataFrame:
    """U1 driver in complete mode: every micro-batch carries the full result; keep the last."""
    root = root or scratch_dir(spark, "stream-ohlcv")

    def write(b: DataFrame, _eid: int) -> None:
        b.write.mode("overwrite").parquet(root)

    run_available_now(bars_stream, write, scratch_dir(spark, "ckpt-ohlcv"), output_mode="complete")
    return spark.read.parquet(root)


def rolling_features_upsert(
    batch: DataFrame,
    epoch_id: int,
    root: str,
    *,
    group_cols: Sequence[str] = ("symbol",),
    order_cols: Sequence[str] = DEFAULT_ORDER,
    keep_rows: int = 101,
    **feature_kw,
) -> None:
    """U4: featurise a micro-batch together with the last ``keep_rows`` rows per group seen before
    it (a side table); only the batch's own rows are emitted. Row-frame windows are not allowed
    on streams, so this runs inside ``foreachBatch``.

    Replay-safe: the side table is versioned by epoch (batch ``e`` reads version ``e-1`` and
    writes version ``e``) and features are written to ``features/epoch=e`` with dynamic
    overwrite, so re-running a batch after a failure gives the same files. ``keep_rows`` must
    cover the longest look-back; group-relative features (elapsed time, lag back-fill, size
    buckets) are relative to the carried window, not to the start of the stream."""
    from tickforge.operators.sequence import drop_helpers, with_sequence

    spark = batch.sparkSession
    fresh = batch.withColumn("_tf_new", F.lit(True))
    prev = f"{root}/state/epoch={epoch_id - 1}"
    if _table_exists(spark, prev):
        carried = spark.read.parquet(prev).withColumn("_tf_new", F.lit(False))
        fresh = carried.unionByName(fresh.select(*carried.columns))
    fresh = fresh.checkpoint(eager=True)
    feats = feat.trade_features(fresh, group_cols=group_cols, order_cols=order_cols, **feature_kw)
    (
        feats.where("_tf_new").drop("_tf_new").withColumn("epoch", F.lit(int(epoch_id)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch")
        .parquet(f"{root}/features")
    )
    tail = drop_helpers(with_sequence(fresh, order_cols, group_cols))
    keep = tail.where(F.col("seq") >= F.col("n_group") - keep_rows).drop("seq", "n_group", "_tf_new")
    keep.write.mode("overwrite").parquet(f"{root}/state/epoch={epoch_id}")


def stream_rolling_features(spark: SparkSession, stream_tape: DataFrame, root: str | None = None, **kw) -> DataFrame:
    """U4 driver: rolling features over a stream, micro-batch by micro-batch."""
    root = root or scratch_dir(spark, "stream-rolling")
    run_available_now(stream_tape, lambda b, eid: rolling_features_upsert(b, eid, root, **kw),
                      scratch_dir(spark, "ckpt-rolling"))
    return spark.read.parquet(f"{root}/features")
