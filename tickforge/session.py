"""Session helpers: a local session for tests/bench and checkpoint-folder lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tickforge") -> SparkSession:
    """Local session used by tests and the bench; clusters pass their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TICKFORGE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset (tests on a
    laptop) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tickforge-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compilable_methods(spark: SparkSession) -> None:
    """Have wide projections run as methods that HotSpot compiles, unless the caller chose a limit.

    Whole-stage code puts all columns of a projection into one method. HotSpot compiles none above
    8,000 bytes, so some 80 feature columns run interpreted, which takes longer than the windows
    that make them. With this limit Spark evaluates such a stage by small methods instead."""
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, "8000")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written intermediate tables."""
    import uuid

    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tickforge-{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int, *,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at one per ~256 MB of input (at least 2 per core); AQE coalesces
    the small ones and splits skewed join partitions at run time. File splits match."""
    cores = max(1, executors * cores_per_executor)
    partitions = max(2 * cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        METHOD_LIMIT: "8000",
    }
