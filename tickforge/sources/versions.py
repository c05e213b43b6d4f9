"""Versioned publication of a table that readers look up while it is refreshed.

A version is written whole into a folder of its own under ``data`` and becomes visible by one empty
marker of the same name under ``committed``, made after the write has succeeded. Readers take the
largest marker, so they see one whole version, never a mixture or an empty folder; a failed or
repeated write leaves no marker and changes nothing. Names start with a running number and end with
a random part: of two publishers that met, both versions are whole and the larger name is current.
``retire`` removes the markers of old versions before their data. Any Hadoop path will do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession, root: str, part: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{part}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the committed versions, the oldest first (one marker each; ``retire`` bounds them)."""
    fs, path = _folder(spark, root, "committed")
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def publish(df: DataFrame, root: str) -> str:
    """Write ``df`` as the next version and make it current; its name."""
    spark = df.sparkSession
    last = versions(spark, root)
    name = f"{int(last[-1].split('-')[0]) + 1 if last else 1:012d}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/data/{name}")
    fs, marker = _folder(spark, root, f"committed/{name}")
    fs.create(marker, False).close()
    return name


def read_version(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """The named version, or the current one; without any version it is an error."""
    if name is None:
        known = versions(spark, root)
        if not known:
            raise FileNotFoundError(f"no version published under {root}")
        name = known[-1]
    return spark.read.parquet(f"{root.rstrip('/')}/data/{name}")


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the ``keep`` newest versions (readers of those go on); the names removed."""
    if keep < 1:
        raise ValueError("at least the current version has to stay")
    gone = versions(spark, root)[:-keep]
    for part in ("committed", "data"):
        for name in gone:
            fs, path = _folder(spark, root, f"{part}/{name}")
            fs.delete(path, True)
    return gone
