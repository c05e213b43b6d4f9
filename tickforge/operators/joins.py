"""Attaching a small per-key table (group stats, knots, offsets) to a large frame.

A shuffle join on a group key would send a hot group to one task, so the small side is
broadcast when its row count is checked to be under a bound; above it the join is salted:
the small side is replicated ``salts`` times and each big-side row picks a salt from a hash
of its own columns, so one key is spread over ``salts`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_SALTS = 64


def attach(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    *,
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    salts: int = DEFAULT_SALTS,
    small_rows: int | None = None,
) -> DataFrame:
    """Join ``small`` (one row per key) onto ``big`` on ``on``; skew-safe and size-checked."""
    on = list(on)
    n_small = small.count() if small_rows is None else small_rows
    if n_small <= max_broadcast_rows:
        return big.join(F.broadcast(small), on=on, how=how)
    if salts <= 1:
        return big.join(small, on=on, how=how)
    salt = "_tf_salt"
    big_s = big.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(salts)))
    small_s = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return big_s.join(small_s, on=[*on, salt], how=how).drop(salt)
