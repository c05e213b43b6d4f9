"""Reuse without recomputation, and lineage cuts for small results.

* :func:`hold` persists a frame that an operator reads several times (memory, spilling to local
  disk). If an executor is lost its blocks are rebuilt from lineage, so results stay correct.
* :func:`small_result` evaluates a small result table (one row per feature, per group, per
  bucket...) and checkpoints it to the shared checkpoint folder named by the session, cutting
  its lineage before the held inputs are released.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tickforge.session import ensure_checkpoint_dir


def hold(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """Persist ``df`` unless the caller already did; returns (frame, release)."""
    if df.is_cached:
        return df, lambda: None
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    return held, lambda: held.unpersist(blocking=False)


def small_result(df: DataFrame) -> DataFrame:
    """Evaluate and checkpoint a small table (reliable storage, lineage cut)."""
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)  # the checkpoint write reuses the computed blocks
    out = held.checkpoint(eager=True)
    held.unpersist(blocking=False)
    return out
