"""Session helpers: pinned time zone, shared scratch folder, a local builder for tests."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Codec of the files that jobs write: about a third smaller than Spark's default.
CODEC = "zstd"


def pin_utc(spark: SparkSession) -> SparkSession:
    """All timestamps are interpreted and rendered in UTC (runtime conf)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Jobs that cut lineage or stage outputs write under this folder, which on a
    cluster is a shared filesystem every executor can reach. Only when the
    session has none (local tests) is a fresh temporary folder set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: jobs need a folder shared by all executors "
            "(e.g. an HDFS or object-store path), never a machine-local temporary folder"
        )
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/ledgerline/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage: later plans read the written files instead of
    recomputing ``df``, and a lost executor costs a re-read, not a recompute.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, advisory_partition_size: str = "64m"
) -> SparkSession:
    """A local session for tests and the bench: UTC, AQE on, no UI.

    ``advisory_partition_size`` is AQE's post-shuffle target; small local data
    needs a small target to spread reduce work over the local cores (a cluster
    keeps 128-256 MB).
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_size)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "4g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
