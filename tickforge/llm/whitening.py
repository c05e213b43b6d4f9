"""Embedding whitening by a bidiagonal qd solver.

Entries become integers (``floor(64 * entry) + 1000000``), so counts and sums are exact. The rows,
centred, are reduced block by block to triangular factors (QR), and those in rounds of
``FAN_IN`` to one, whose order is the vectors' length; ``bidiagonal.right_directions`` finds its
singular values and vectors. A second scan projects each row on the directions and divides by the
deviation along them; a third one of the same rows measures how far the covariance of the result
is from the identity, its blocks' means and products merged without cancellation.

Defined cases: vectors that are NULL, empty, or hold a NULL or non-finite entry take no part; of
vectors of several lengths those of the most frequent length do (the longer one, if two are as
frequent); ties and rows that repeat (NULL ids included) give rows each; extra columns, whatever
their names, play no part; directions without variance (below the rounding of the largest) are left
out, so one vector, equal vectors or an empty table give no rows. An integer beyond the range of a
long is held at its end. Texts play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.bidiagonal import EPS, right_directions
from tickforge.llm.common import written

COMPONENTS = 32
#: How an entry becomes an integer.
STEPS, OFFSET = 64, 1_000_000
FAN_IN = 16
#: Vectors that one Python step holds at a time.
BLOCK_ROWS = 4_096
_LIMIT = 2.0**62


@dataclass
class Whitener:
    rows: int
    sums: list[int]
    directions: np.ndarray  # a column a component
    values: np.ndarray  # variances along them, falling
    trace: float


def usable(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & fine)
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("vector") == (most["length"] if most else 0))


def _blocks(batches, column: int = 1):
    """(batch, matrix of integers) of the usable rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            flat = part.column(column).flatten().to_numpy(zero_copy_only=False)
            whole = np.clip(np.floor(STEPS * flat), -_LIMIT, _LIMIT).astype(np.int64) + OFFSET
            yield part, whole.reshape(part.num_rows, -1)


def _scaled(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exactly (Python integers where 64 bits could overflow)."""
    if (np.abs(x.astype(np.float64)).max(initial=0.0) + 1) * n < _LIMIT and max(map(abs, sums), default=0) < _LIMIT:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_scaled(x, n, sums) / n).astype(np.float64)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over the dimensions of (n * x - sums) squared, exactly."""
    apart = _scaled(x, n, sums)
    if apart.dtype != object and float(np.abs(apart.astype(np.float64)).max(initial=0.0)) ** 2 * x.shape[1] < _LIMIT:
        return (apart * apart).sum(axis=1)
    apart = apart.astype(object)
    return np.array([min(int(v), 2**63 - 1) for v in (apart * apart).sum(axis=1)], dtype=np.int64)


def _sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Rows and the exact sum of each dimension."""

    def run(batches):
        n, total = 0, 0
        for _, x in _blocks(batches):
            n, total = n + len(x), total + x.astype(object if np.abs(x).max(initial=0) > 2**40 else np.int64).sum(axis=0)
        if n:
            at = np.arange(len(total) + 1, dtype=np.int32)
            texts = [str(int(v)) for v in [n, *total]]
            yield pa.RecordBatch.from_arrays([pa.array(at - 1), pa.array(texts)], ["at", "value"])

    parts = rows.mapInArrow(run, "at int, value string")
    totals = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()  # one row a dimension
    ordered = [int(r["total"]) for r in sorted(totals, key=lambda r: r["at"])]
    return (ordered[0], np.array(ordered[1:], dtype=object)) if ordered else (0, np.zeros(0, dtype=object))


def _reduced(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray | None:
    """The triangular factor of all centred rows: of blocks first, then of factors."""
    d = len(sums)

    def pack(r: np.ndarray) -> bytes:
        return np.ascontiguousarray(r).tobytes()

    def first(batches):
        factor = np.zeros((0, d))
        for _, x in _blocks(batches):
            factor = np.linalg.qr(np.vstack([factor, _centred(x, n, sums)]), mode="r")
        if len(factor):
            yield pa.RecordBatch.from_arrays([pa.array([pack(factor)], pa.binary())], ["factor"])

    def merged(_, table):
        factor = np.zeros((0, d))
        for raw in sorted(table.column("factor").to_pylist()):  # the order of rows must not matter
            factor = np.linalg.qr(np.vstack([factor, np.frombuffer(raw).reshape(-1, d)]), mode="r")
        return pa.table({"factor": pa.array([pack(factor)], pa.binary())})

    factors = written(rows.mapInArrow(first, "factor binary"), "whitening-factors")
    count = factors.count()
    while count > 1:
        groups = -(-count // FAN_IN)
        dealt = factors.groupBy(F.pmod(F.xxhash64("factor"), F.lit(groups)).alias("group"))
        factors = written(dealt.applyInArrow(merged, "factor binary"), "whitening-factors")
        count = factors.count() if groups > 1 else 1
    row = factors.first()
    return None if row is None else np.frombuffer(row["factor"]).reshape(-1, d)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitening of ``rows`` (as ``usable`` gives them); None without variance."""
    n, sums = _sums(rows)
    factor = _reduced(rows, n, sums) if n else None
    if factor is None:
        return None
    d = len(sums)
    square = np.zeros((d, d))
    square[: len(factor)] = factor[:d]
    values, directions = right_directions(square, min(components, d))
    kept = values > values.max(initial=0.0) * (d * EPS) ** 2 * 16
    if not kept.any():
        return None
    return Whitener(n, [int(s) for s in sums], directions[:, kept], values[kept] / n, float((square**2).sum()) / n)


def _whiten(x: np.ndarray, w: Whitener, sums: np.ndarray) -> np.ndarray:
    return _centred(x, w.rows, sums) @ w.directions / np.sqrt(w.values)


def identity_error(rows: DataFrame, w: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    sums, k = np.array(w.sums, dtype=object), len(w.values)

    def join(a, b):
        """(rows, mean, centred products) of two sets of rows together."""
        if not a[0]:
            return b
        n, gap = a[0] + b[0], b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def part(batches):
        state = (0, np.zeros(k), np.zeros((k, k)))
        for _, x in _blocks(batches):
            y = _whiten(x, w, sums)
            mean = y.mean(axis=0)
            state = join(state, (len(y), mean, (y - mean).T @ (y - mean)))
        if state[0]:
            yield pack(state)

    names = ["n", "mean", "products"]

    def pack(state):
        arrays = [pa.array([state[0]], pa.int64()), *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in state[1:])]
        return pa.RecordBatch.from_arrays(arrays, names)

    def merged(_, table):
        state = (0, np.zeros(k), np.zeros((k, k)))
        for n, mean, products in sorted(zip(*(table.column(c).to_pylist() for c in names))):
            state = join(state, (n, np.frombuffer(mean), np.frombuffer(products).reshape(k, k)))
        return pa.Table.from_batches([pack(state)])

    schema = "n long, mean binary, products binary"
    states = written(rows.mapInArrow(part, schema), "whitening-states")
    count = states.count()
    while count > 1:
        groups = -(-count // FAN_IN)
        dealt = states.groupBy(F.pmod(F.xxhash64("mean", "products"), F.lit(groups)).alias("group"))
        states = written(dealt.applyInArrow(merged, schema), "whitening-states")
        count = states.count() if groups > 1 else 1
    row = states.first()
    return float(np.abs(np.frombuffer(row["products"]).reshape(k, k) / row["n"] - np.eye(k)).max())


def whitened(rows: DataFrame, w: Whitener) -> DataFrame:
    """vec_id, deviation and whitened (an entry a component) of every row."""
    sums = np.array(w.sums, dtype=object)

    def run(batches):
        for part, x in _blocks(batches):
            y = _whiten(x, w, sums)
            ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1])
            lists = pa.ListArray.from_arrays(ends, pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_deviation(x, w.rows, sums), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whiten_table(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row a usable vector and component, with the figures of the whole fit."""
    rows = usable(table)
    w = fit(rows, components)
    if w is None:
        return rows.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(rows, w)
    share = F.array(*[F.lit(float(v / w.trace)) for v in w.values])
    out = whitened(rows, w).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(w.rows).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
