"""Database adapter for gold tables (for warehouses that serve gold over JDBC).

The lake's own gold is the versioned Parquet layout of :mod:`ledgerline.sources.lake`;
these functions copy a published table to a database table and read one back.
They need the database's JDBC driver on the classpath and are not exercised by
the tests (no database runs here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str], num_partitions: int = 8) -> None:
    """Replace the rows of ``table`` with ``df``.

    Truncation keeps the table's DDL (keys, checks, indexes); ``cascadeTruncate``
    lets a referenced dimension be truncated, which is why tables are loaded in
    :data:`GOLD_LOAD_ORDER`.

    At most ``num_partitions`` concurrent connections write, each in batches;
    the upstream plan keeps its own parallelism (repartition, not coalesce).
    """
    (
        df.repartition(num_partitions)
        .write.mode("overwrite")
        .option("truncate", "true")
        .option("cascadeTruncate", "true")
        .option("batchsize", "10000")
        .jdbc(url, table, properties=properties)
    )


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int = 8,
) -> DataFrame:
    """Read ``table``; with a numeric ``partition_column`` the scan is split into
    ``num_partitions`` parallel range queries instead of one connection."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=properties,
    )


# Dimensions before the fact before the marts, so foreign keys always resolve.
GOLD_LOAD_ORDER = ["dim_customer", "dim_merchant", "dim_date", "fct_payments", "agg_daily_kpis", "agg_cohort_ltv"]


def copy_gold(tables, url: str, properties: dict[str, str]) -> None:
    """Copy a published gold version (``Gold.tables``) into database tables.

    The lake-only partition column is dropped. The lake's version stays the
    source of truth; a failed copy is repeated from the same version.
    """
    for name in GOLD_LOAD_ORDER:
        df = tables[name]
        if "date_month" in df.columns:
            df = df.drop("date_month")
        write_table(df, url, name, properties)
