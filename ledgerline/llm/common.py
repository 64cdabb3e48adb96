"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: ASCII white space, the only characters that separate words or are stripped from lines.
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Bytes of text of one block, the unit that texts are grouped in for block-wise operators.
BLOCK_BYTES = 8 << 20
#: Bytes of one Arrow batch on its way to a Python worker (a longer row is a batch of its own).
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch grow beyond ``BATCH_BYTES``: the default, 64 MB, is held several times over by each task.

    The session's own limit stays if it is lower. Called by operators that send texts to Python workers.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back with its own schema.

    Later plans read the files, so a lost executor costs a re-read. Afterwards
    the driver collects its garbage, which lets Spark remove the shuffle files
    of the plan that has just run.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    free_finished(spark)
    return out


def free_finished(spark: SparkSession) -> None:
    """Collect garbage on the driver, so that Spark removes the shuffle files of plans that are done with."""
    for pause in (0.2, 0):  # listeners hold the last plan for a moment
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def discard(staged: DataFrame) -> None:
    """Delete the files of a result of ``stage`` that no later plan reads."""
    jvm = staged.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(staged._staged)
    path.getFileSystem(staged.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of UTF-8 in a text column (one pass, one row to the driver)."""
    row = df.agg(F.sum(F.octet_length(F.col(column))).alias("n")).first()
    return int(row["n"] or 0)


def with_block(df: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """Deal rows into ``n_blocks`` blocks by the hash of a key; a null key counts as -1."""
    return df.withColumn(
        "block", F.pmod(F.xxhash64(F.coalesce(F.col(key), F.lit(-1).cast("long"))), F.lit(n_blocks)).cast("int")
    )


def text_bytes(value: str | None) -> bytes:
    """UTF-8 of a text, a null text being empty."""
    return value.encode("utf-8", "surrogatepass") if value else b""


def ascii_lower(value: bytes) -> bytes:
    """A-Z to a-z; every other byte stays (``bytes.lower`` touches ASCII only)."""
    return value.lower()


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes over the links ``a[i] - b[i]``.

    Vectorised hooking and pointer jumping; memory is linear in nodes and links.
    """
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        open_ = low != high
        if not open_.any():
            return root
        np.minimum.at(root, high[open_], low[open_])
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
