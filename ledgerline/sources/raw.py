"""Readers for the raw landing formats: CSV, JSON lines and the denylist document.

Schemas are always pinned, never inferred. CSV headers are validated against
the pinned schema (``enforceSchema=false``) so that a file whose columns were
reordered fails instead of being read by position into the wrong fields; bad
cells still become NULL (PERMISSIVE). The readers can also keep the text of
each line that does not fit the schema, in the column ``_rescued``: a bad cell, too
few or too many columns, or broken JSON. Such a line stays a row of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.operators.clean import explode_denylist
from ledgerline.schemas import DENYLIST_DOCUMENT


RESCUED = "_rescued"


def _with_rescued(schema: StructType, rescue: bool) -> StructType:
    return StructType([*schema.fields, StructField(RESCUED, StringType(), True)]) if rescue else schema


def read_csv_raw(spark: SparkSession, path: str, schema: StructType, rescue: bool = False) -> DataFrame:
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUED)
        .schema(_with_rescued(schema, rescue))
        .csv(path)
    )


# Timestamps inside JSON files keep microseconds and an explicit offset.
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_jsonl_raw(spark: SparkSession, path: str, schema: StructType, rescue: bool = False) -> DataFrame:
    reader = spark.read.option("timestampFormat", JSON_TIMESTAMP).option("columnNameOfCorruptRecord", RESCUED)
    return reader.schema(_with_rescued(schema, rescue)).json(path)


def read_denylist(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Denylist document(s) -> rows ``(customer_id, blacklist_updated_at)``.

    ``multi_line=True`` reads files that each hold one (pretty-printed) JSON
    document, as the denylist service publishes it; ``False`` reads JSON lines,
    one document per line.
    """
    docs = spark.read.option("multiLine", multi_line).schema(DENYLIST_DOCUMENT).json(path)
    return explode_denylist(docs)


def write_csv(df: DataFrame, path: str) -> None:
    """Land a raw table as CSV with a header (test fixtures and examples)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("timestampFormat", JSON_TIMESTAMP).json(path)


# ---- A raw landing folder --------------------------------------------------------

# File (or folder) names of the seven raw datasets inside a landing folder.
LANDING_FILES = {
    "customers": "customers.csv",
    "merchants": "merchants.csv",
    "payments": "payments.csv",
    "chargebacks": "chargebacks.csv",
    "fx_rates": "fx_rates.csv",
    "events": "events.jsonl",
    "blacklist": "denylist.json",
}


def read_landing(
    spark: SparkSession, raw_dir: str, multi_line_denylist: bool = True, rescue: bool = False
) -> dict[str, DataFrame]:
    """The seven raw datasets of one run from a landing folder, schemas pinned.

    With ``rescue``, all but the denylist have the column ``_rescued``, which bronze stores.
    The denylist is one pretty-printed JSON document as the service serves it
    (``multi_line_denylist=True``) or JSON lines of documents.
    """
    from ledgerline.schemas import RAW_SCHEMAS

    root = raw_dir.rstrip("/")
    out = {}
    for table, name in LANDING_FILES.items():
        path = f"{root}/{name}"
        if table == "events":
            out[table] = read_jsonl_raw(spark, path, RAW_SCHEMAS[table], rescue)
        elif table == "blacklist":
            out[table] = read_denylist(spark, path, multi_line=multi_line_denylist)
        else:
            out[table] = read_csv_raw(spark, path, RAW_SCHEMAS[table], rescue)
    return out


def write_landing(raw: dict[str, DataFrame], denylist_documents: DataFrame, raw_dir: str) -> None:
    """Land raw datasets in the layout :func:`read_landing` reads (one folder per file name)."""
    root = raw_dir.rstrip("/")
    for table, name in LANDING_FILES.items():
        path = f"{root}/{name}"
        if table == "events":
            write_jsonl(raw[table], path)
        elif table == "blacklist":
            denylist_documents.write.mode("overwrite").json(path)
        else:
            write_csv(raw[table], path)
