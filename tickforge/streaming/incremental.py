"""Incremental streams whose state the engine keeps and bounds.

* ``stream_bar_states`` / ``append_bar_states`` / ``bars_from_states`` (U1): the mergeable bar states
  of A3 in update mode. A micro-batch emits the states of the windows it changed, whole; they are
  appended to the day they belong to under their epoch, and a reader takes the newest state of each
  window. Days without news are neither read nor written, and the watermark bounds the windows that
  the state store holds.
* ``first_wins`` (U2): the first row of a key passes; its copies do not as long as the key is
  remembered, which is until the watermark passes the row's time plus the delay.
* ``stream_rolling`` (U4): row-frame features over a key's stream, with the last rows of each key as
  a ring buffer in the state store.

A run that stops goes on from its checkpoint with the state it had; a replayed epoch writes the
same files again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickforge.functions.columns import ds_from_ms
from tickforge.operators.bars import merge_partials, order_key, signed_quantity
from tickforge.schema import DEFAULT_ORDER
from tickforge.session import scratch_dir
from tickforge.streaming.streams import event_time, run_available_now

# --------------------------------------------------------------------------- arrivals


def run_in_arrivals(spark: SparkSession, arrivals: Sequence[DataFrame], start: Callable[[DataFrame, str], None]) -> None:
    """Land the frames one after the other in one folder and run ``start(stream, checkpoint)`` after
    each: every run is a restart from the checkpoint that reads what has arrived since."""
    root, checkpoint = scratch_dir(spark, "arrivals"), scratch_dir(spark, "ckpt-arrivals")
    for frame in arrivals:
        frame.write.mode("append").parquet(root)
        start(spark.readStream.schema(frame.schema).parquet(root), checkpoint)


# --------------------------------------------------------------------------- U1 bars


def stream_bar_states(
    tape: DataFrame,
    bar: str = "1 minute",
    watermark: str = "10 minutes",
    group_cols: Sequence[str] = (),
    order_cols: Sequence[str] = DEFAULT_ORDER,
) -> DataFrame:
    """Streaming A3 states: per window (and group) the keys and prices of its first and last trade,
    extremes and sums; rows older than the watermark are left out by the engine."""
    keyed = event_time(tape).withColumn("_tf_k", order_key(tape, order_cols)).withWatermark("event_time", watermark)
    return (
        keyed.groupBy(F.window("event_time", bar).alias("w"), *group_cols)
        .agg(
            F.min("_tf_k").alias("open_key"),
            F.min_by("price", "_tf_k").alias("open_price"),
            F.max("price").alias("high_state"),
            F.min("price").alias("low_state"),
            F.max("_tf_k").alias("close_key"),
            F.max_by("price", "_tf_k").alias("close_price"),
            F.sum("quantity").alias("volume_state"),
            F.sum("quote_quantity").alias("quote_volume_state"),
            F.sum(signed_quantity()).alias("ofi_state"),
        )
        .withColumn("window_start", F.unix_millis(F.col("w.start")))
        .withColumn("ds", ds_from_ms(F.col("window_start")))
        .drop("w")
    )


def append_bar_states(changed: DataFrame, epoch: int, root: str) -> None:
    """The changed windows of a micro-batch, under their days and epoch (a replay overwrites them)."""
    (
        changed.withColumn("epoch", F.lit(int(epoch)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ds", "epoch").parquet(root)
    )


def newest_states(states: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """The newest state of each window."""
    keys = ["ds", *group_cols, "window_start"]
    rest = [c for c in states.columns if c not in (*keys, "epoch")]
    newest = states.groupBy(*keys).agg(*[F.max_by(c, "epoch").alias(c) for c in rest])
    return newest.withColumn("ds", F.col("ds").cast("string"))


def bars_from_states(states: DataFrame, bar_ms: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """Bars of ``bar_ms`` from the appended states."""
    return merge_partials(newest_states(states, group_cols), bar_ms, group_cols)


def compact_day(spark: SparkSession, root: str, ds: str, group_cols: Sequence[str] = ()) -> None:
    """One file set, under the newest epoch, for a day whose windows were written by many epochs.
    The merged rows are written aside first; older epochs go only then."""
    day = spark.read.option("basePath", root).parquet(f"{root}/ds={ds}")
    aside = scratch_dir(spark, "compact")
    last = day.agg(F.max("epoch")).first()[0]
    newest_states(day, group_cols).write.parquet(aside)
    append_bar_states(spark.read.parquet(aside), last, root)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/ds={ds}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("epoch=") and int(name[6:]) < last:
            fs.delete(status.getPath(), True)


def run_bar_states(stream: DataFrame, root: str, checkpoint: str) -> None:
    """Update-mode run of :func:`stream_bar_states` into the table of states."""
    run_available_now(stream, lambda b, epoch: append_bar_states(b, epoch, root), checkpoint, output_mode="update")


# --------------------------------------------------------------------------- U2 first wins


def first_wins(tape: DataFrame, key_cols: Sequence[str] = ("trade_id",), delay: str = "1 hour") -> DataFrame:
    """The first row of each key; copies are dropped while the key is remembered. A key is
    forgotten once the watermark (largest time seen, less ``delay``) passes its row's time plus
    ``delay``, so the state holds the keys of about two delays, however long the stream."""
    return event_time(tape).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(key_cols)).drop("event_time")


def append_rows(batch: DataFrame, epoch: int, root: str) -> None:
    (
        batch.withColumn("epoch", F.lit(int(epoch)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(root)
    )


# --------------------------------------------------------------------------- U4 rolling features


def _frames(x: np.ndarray, size: int, own: int) -> np.ndarray:
    """For each of the last ``own`` values the frame of up to ``size`` values that ends there (NaN
    where the sequence had not begun)."""
    padded = np.concatenate([np.full(size - 1, np.nan), x])
    return np.lib.stride_tricks.sliding_window_view(padded, size)[len(x) - own :]


def rolling_columns(price: np.ndarray, first: bool, own: int, mean_window: int, vol_window: int) -> dict[str, np.ndarray]:
    """Rolling mean, sample deviation (0 for one value) and realized volatility of the last ``own``
    prices; ``first``: the sequence starts with ``price[0]``."""
    frames = _frames(price, mean_window, own)
    n = (~np.isnan(frames)).sum(axis=1)
    mean = np.nansum(frames, axis=1) / n
    gap = np.where(np.isnan(frames), 0.0, frames - mean[:, None])
    std = np.sqrt((gap**2).sum(axis=1) / np.maximum(n - 1, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        back = np.log(price / np.concatenate([[price[0] if first else np.nan], price[:-1]]))
    vol = np.sqrt(np.nansum(_frames(back, vol_window, own) ** 2, axis=1))
    return {f"price_roll_mean_{mean_window}": mean, f"price_roll_std_{mean_window}": std, f"realized_volatility_{vol_window}": vol}


def stream_rolling(
    tape: DataFrame,
    *,
    key_col: str = "symbol",
    mean_window: int = 20,
    vol_window: int = 10,
) -> DataFrame:
    """U4: trade_id, key and rolling features of every trade of the stream.

    State of a key: its last prices (a ring buffer as long as the longest look-back) and how many
    trades it has had. Within a micro-batch a key's trades are taken in the order of (timestamp,
    trade_id); they follow those of earlier batches. What a key can bring at once is bounded by the
    trigger's batch size; nothing older than the buffer is kept."""
    keep = max(mean_window - 1, vol_window)
    names = [f"price_roll_mean_{mean_window}", f"price_roll_std_{mean_window}", f"realized_volatility_{vol_window}"]

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, buffer = state.get if state.exists else (0, [])
        rows = pd.concat(list(frames), ignore_index=True).sort_values(["timestamp", "trade_id"], ignore_index=True)
        if len(rows):
            price = np.concatenate([np.array(buffer, dtype=float), rows["price"].to_numpy(dtype=float)])
            out = rolling_columns(price, seen == len(buffer), len(rows), mean_window, vol_window)
            state.update((seen + len(rows), price[-keep:].tolist()))
            yield pd.DataFrame({"trade_id": rows["trade_id"], key_col: [key[0]] * len(rows), **out})

    schema = f"trade_id long, {key_col} string, " + ", ".join(f"{n} double" for n in names)
    rows = tape.select(key_col, "timestamp", "trade_id", "price")
    return rows.groupBy(key_col).applyInPandasWithState(advance, schema, "seen long, prices array<double>", "append", GroupStateTimeout.NoTimeout)
