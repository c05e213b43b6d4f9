"""Scans: raw trade CSV (headerless / sniffed / zipped), parquet chunks, partitioned tables,
JSON snapshots, in-memory records (S1-S10). S8 (object store) is just a path: credentials
are Spark/Hadoop configuration."""

from __future__ import annotations

import csv
import heapq
import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.schema import MACRO_SCHEMA, RAW_TRADE_SCHEMA, TRADE_COLS, TRADE_SCHEMA

_TYPES = {f.name: f.dataType.simpleString() for f in TRADE_SCHEMA.fields}


def coerce_trades(raw: DataFrame, recompute_quote: bool = True) -> DataFrame:
    """S2 (+P3): lenient typing, a malformed value becomes NULL (``try_cast``; ANSI ``cast``
    would raise). Booleans accept true/false, t/f, yes/no, 1/0 in any case; anything else is
    NULL and counted by the contract. ``recompute_quote`` overwrites quote = price * quantity."""
    cols = {}
    for c in TRADE_COLS:
        cols[c] = F.expr(f"try_cast(trim(`{c}`) AS {_TYPES[c]})") if c in raw.columns else F.lit(None).cast(_TYPES[c])
    out = raw.select(*[cols[c].alias(c) for c in TRADE_COLS], *[c for c in raw.columns if c not in TRADE_COLS])
    if recompute_quote:
        out = out.withColumn("quote_quantity", F.col("price") * F.col("quantity"))
    return out


def read_trades_csv(spark: SparkSession, path: str | Sequence[str], header: bool = False) -> DataFrame:
    """Headerless CSV with the seven fixed column names, read as strings (typing is S2)."""
    return spark.read.schema(RAW_TRADE_SCHEMA).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_trades_csv_sniffed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """S3: a header line is present iff its first cell equals ``trade_id``; reading as strings
    and dropping such lines handles files with and without header (also mixed)."""
    raw = read_trades_csv(spark, path, header=False)
    return raw.where(F.lower(F.trim(F.col("trade_id"))) != F.lit("trade_id"))


def _unzip_first_csv(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: open each archive by path (seekable stream, never the whole file in one value),
    read the first ``.csv`` member line by line and yield 50k-row string batches."""
    from tickforge.sources.sinks import _filesystem

    for pdf in batches:
        for path in pdf["path"]:
            fs, local = _filesystem(path)
            with fs.open_input_file(local) as raw, zipfile.ZipFile(raw) as zf:
                members = [m for m in zf.namelist() if m.lower().endswith(".csv")]
                if not members:
                    raise ValueError(f"No CSV file found inside archive {path}")
                with zf.open(members[0]) as fh:
                    reader = csv.reader(io.TextIOWrapper(fh, encoding="utf-8"))
                    chunk: list[list[str]] = []
                    for row in reader:
                        chunk.append((row + [None] * 7)[:7])
                        if len(chunk) >= 50_000:
                            yield pd.DataFrame(chunk, columns=TRADE_COLS)
                            chunk = []
                    if chunk:
                        yield pd.DataFrame(chunk, columns=TRADE_COLS)


def plan_archives(sizes: Sequence[tuple[str, int]], tasks: int) -> list[list[str]]:
    """Archives dealt to at most ``tasks`` tasks, the largest first, each to the task with the
    fewest bytes so far (the fullest task holds at most 4/3 of the least possible)."""
    load = [(0, i) for i in range(max(1, min(tasks, len(sizes))))]
    plan: list[list[str]] = [[] for _ in load]
    for path, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        held, i = heapq.heappop(load)
        plan[i].append(path)
        heapq.heappush(load, (held + size, i))
    return plan


def read_trades_zip(spark: SparkSession, path: str, glob: str = "*.zip", tasks: int | None = None) -> DataFrame:
    """Zipped daily CSV archives; the first ``.csv`` member of each archive is read, an
    archive without one is an error. Archives are listed with the ``binaryFile`` source reading
    only their paths and sizes (the content column is pruned, so no archive becomes one in-memory
    value; the driver's file index holds this list anyway). They are dealt by size to ``tasks``
    tasks (default: four a core, at most one an archive, since zip is not splittable), whose number
    no adaptive re-planning changes. Each archive is opened as a stream and rows leave in 50k-row
    batches, so memory stays bounded. Returns raw strings."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")
    sizes = [(r["path"], r["length"]) for r in found.collect()]
    if not sizes:
        return spark.createDataFrame([], RAW_TRADE_SCHEMA)
    bins = plan_archives(sizes, tasks or 4 * spark.sparkContext.defaultParallelism)
    shared = spark.sparkContext.broadcast(bins)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in pdf["id"]:
                yield from _unzip_first_csv(iter([pd.DataFrame({"path": shared.value[i]})]))

    return spark.range(0, len(bins), 1, len(bins)).mapInPandas(run, RAW_TRADE_SCHEMA)


def read_parquet_chunks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A list of chunk files is one scan (UNION ALL by construction)."""
    return spark.read.parquet(*paths)


def read_partition(spark: SparkSession, root: str, ds: str | None = None, partition_col: str = "ds") -> DataFrame:
    """Partitioned table scan; ``ds`` prunes to one partition (a partition filter on
    the scan). A requested partition that holds no rows is an error. ``root`` is any Hadoop path:
    an object store (``s3a://bucket/...``) works the same, with credentials in the Spark conf."""
    df = spark.read.option("basePath", root).parquet(root)
    # Partition values are day strings; keep them strings (inference would make them dates).
    df = df.withColumn(partition_col, F.col(partition_col).cast("string"))
    if ds is None:
        return df
    part = df.where(F.col(partition_col) == F.lit(ds))
    if part.isEmpty():
        raise FileNotFoundError(f"partition {partition_col}={ds} not found under {root}")
    return part


def read_macro_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Macro snapshot, one JSON object per daily file (``multi_line``) or JSON lines."""
    return spark.read.schema(MACRO_SCHEMA).option("multiLine", multi_line).json(path)


def from_records(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """A request's list of trade dicts as a typed frame (missing keys are NULL)."""
    return spark.createDataFrame([tuple(r.get(c) for c in TRADE_COLS) for r in rows], TRADE_SCHEMA)
