"""The registered query of each operator: its whole table, production parameters, full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    chat_format,
    conversation_repair,
    ctw,
    decontaminate,
    embeddings,
    licenses,
    line_dedup,
    mixing,
    periodic_runs,
    quality,
    simhash,
    substring_dedup,
    url_templates,
)
from ledgerline.llm.common import ASCII_SPACE, stage, table
from ledgerline.llm.oracle import ORACLE_SQL as ORACLE_SQL


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules and path templates; labels are those of equal id."""
    return url_templates.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree code length of every document, beside a unigram base."""
    return ctw.ctw_scores(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines of at least 40 code points in at least 5 documents."""
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return out.select("doc_id", "n_lines", "n_dropped", kept)


def op5_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near-equal embeddings within a label."""
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document to be low in quality or toxic, and whether it is rejected."""
    out = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "p_bad", "rejected")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: four-word shingles, links at four differing bits or fewer."""
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 0.8 of the five-word shingles of a benchmark item."""
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the corpus's tokens, raked to smoothed source, language and topic shares."""
    out = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "source", "lang", "topic", "n_tokens",
        F.round("probability", 6).alias("probability"), F.round("weight", 6).alias("weight"),
    )


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 50-byte strings that start in an earlier document."""
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults planted by the CRC-32 of ``conv_id:turn`` modulo 20; nulls become a space.

    0: the row is missing, 1: its text is empty, 2: without ``.!?``, 3: it comes twice, 4: its role is user.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    rows = conversations.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), space).alias(c) for c in ("role", "text")),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    )
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where(fault != 0).select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of every conversation, after planted damage."""
    conversations = table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    report = conversation_repair.repair_report(rows).withColumnRenamed("conv_id", "c")
    ids = conversations.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    full = stage(
        ids.join(report, ids["conv_id"].eqNullSafe(report["c"]), "left").drop("c").fillna(0, numbers).fillna("", ["audit"]),
        "repair-report",
    )
    digests = conversation_repair.repaired_digests(rows, full).withColumnRenamed("conv_id", "c")
    out = full.join(digests, full["conv_id"].eqNullSafe(digests["c"]))
    return out.select("conv_id", *numbers, "audit", "repaired_sha256")


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted as prefix-target examples and read back."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    controls = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    seen = chat_format.read_back(chat_format.chat_examples(conversations.unionByName(controls)))
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    losses = F.array_join("losses", "")
    return seen.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(losses).cast("long").alias("loss_chars"),
        F.sha2(losses.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Texts of every tenth ``crc32(doc_id)``, their words from some place on replaced by a repeated stretch.

    With h the CRC-32 of the decimal id, g = h // 10 and n words, word i >= a = g % n becomes word
    a + (i - a) % p of the text, p = 1 + (n - a) // (3 + g % 8), if h % 10 = 0. A null id is left alone.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", f"[{ASCII_SPACE}]+"), lambda w: w != "")
    g = F.floor(h / 10).cast("long")
    planted = F.transform(
        "words",
        lambda w, i: F.when(i < F.col("a"), w).otherwise(
            F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        ),
    )
    chosen = docs.withColumn("words", F.when(h % 10 == 0, words)).withColumn("n", F.size("words").cast("long"))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, g % F.col("n")))
    chosen = chosen.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)).cast("long"))
    return chosen.select(
        "doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated word stretches in every document, after planted ones, and the text with each run cut to one period."""
    out = periodic_runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.try_element_at(
        F.array_sort(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("n")))), F.lit(1)
    )
    listed = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), ""
    )
    return out.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.n").alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(1000 * F.col("longest.n") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_url_templates": op1_url_templates,
    "op2_ctw": op2_ctw,
    "op3_licenses": op3_licenses,
    "op4_line_dedup": op4_line_dedup,
    "op5_pivots": op5_pivots,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_decontaminate": op8_decontaminate,
    "op9_mixing": op9_mixing,
    "op10_suffix_array": op10_suffix_array,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_chat_format": op12_chat_format,
    "op13_periodic_runs": op13_periodic_runs,
}
