"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.session import scratch_dir

#: Characters of text that one Python step holds at a time (a longer single text is one step).
CHUNK_CHARS = 400_000
#: Bytes of an Arrow batch on its way to a Python worker (a longer single row is one batch).
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows (of a bounded width) that one task of a ``written`` table of known size takes.
TASK_ROWS = 25_000


def written(df: DataFrame, name: str, rows: int | None = None, *, watch: dict[str, "F.Column"] | None = None) -> DataFrame:
    """``df`` written to the shared folder named by ``spark.checkpoint.dir`` and read back: its
    lineage is cut, its size is known to the optimizer, and a lost executor costs nothing.

    ``rows`` is a bound of its rows, if the caller knows one: a small table is then written by a
    task for each ``TASK_ROWS`` of them, not by one for each, nearly empty, shuffle partition.

    ``watch`` names aggregates over the rows that the write itself takes (read by ``watched``): a
    later ``count()`` would be a query of its own, which the driver plans, compiles and keeps."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // TASK_ROWS)))
    path = scratch_dir(spark, name)
    seen = Observation()
    (df.observe(seen, *[c.alias(k) for k, c in watch.items()]) if watch else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tf_path = path
    out._tf_watched = seen.get if watch else {}
    return out


def watched(df: DataFrame, name: str = "rows") -> int:
    """What the write of a table found for ``watch``."""
    return df._tf_watched[name]


def free_broadcasts(spark: SparkSession) -> None:
    """Have the driver's garbage collector run. Spark drops a broadcast (two copies of the table in
    the driver) when that finds its join gone; a heap with room to grow first grows to its limit, so
    a loop of many small joins calls this once a round."""
    spark.sparkContext._jvm.System.gc()


def release(*tables: DataFrame) -> None:
    """Delete ``written`` tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._tf_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows up to which a written table with columns of fixed size is broadcast (some 16 to 500 bytes
#: each, so 50 MB at most); a larger one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def beside(df: DataFrame, rows: int) -> DataFrame:
    """A written table of ``rows`` rows for the small side of a join: broadcast if they are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fold(doc_id: str, mod: int) -> "F.Column":
    """crc32(doc_id as text) mod ``mod``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


def hash_below(col: "F.Column", share: "F.Column | float", seed: str) -> "F.Column":
    """Deterministic sampling: true for about ``share`` of the distinct values of ``col``."""
    unit = F.pmod(F.xxhash64(F.lit(seed), col), F.lit(1 << 30)) / float(1 << 30)
    return unit < share


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece hold about ``CHUNK_CHARS`` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        arr = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(arr), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        part = np.cumsum(sizes) // CHUNK_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; NULL counts as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def bounded_batches(spark: SparkSession) -> None:
    """Have Arrow batches end at ``BATCH_BYTES``, unless the caller chose a limit.

    By rows alone (10,000) a batch of whole texts takes tens of MB, which the JVM and the worker of
    every running task hold several times over, and more the longer the texts are."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """``fn`` over bounded Arrow pieces of ``df`` (which has a ``text`` column)."""
    bounded_batches(df.sparkSession)

    def run(batches):
        import pyarrow.compute  # noqa: F401  (pa.compute)

        for piece in chunks(batches):
            out = fn(piece)
            if out.num_rows:
                yield out
            # Freed buffers go back to the system: workers live on from stage to stage.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def by_id(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` alone: extra columns, whatever their names, play no part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambling (the public splitmix64 finaliser), on uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def crc(value: object) -> int:
    return zlib.crc32(str(value).encode())


_ODD = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(int(_ODD), -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _ODD))])
                self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, np.uint64(inverse)))])
        return self.up, self.down
