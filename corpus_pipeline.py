"""The training-data pipeline: quality classifier, line dedup, SimHash dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all documents its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, line_dedup, mixing, quality, simhash
from ledgerline.llm.common import stage, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    judged = quality.classify(docs, table(spark, sf_dir, "labels"))
    return judged.where(~F.col("rejected")).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; ``n_chars`` follows the text."""
    out = line_dedup.line_dedup(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def simhash_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that of the smallest id; documents without one come after all others.

    Documents that share an id but not a group each stand for their own group; of equal ones, one stays.
    """
    return simhash.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights, each with its topic, tokens, probability and weight."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", simhash_deduplication),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
]

#: The classifier, the SimHash fingerprints and the MinHash search are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
