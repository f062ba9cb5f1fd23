"""One query for each operator over its whole table, and checking SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.llm import chat, collocations, decontaminate, html_extract, language, line_dedup, merkle, mixing, quality_rules
from sheetloom.llm import simhash, token_counts, token_shards, toxicity
from sheetloom.llm.common import crc_mod, read

Run = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labels of rows that aren't held out; every fifth row by crc32 is."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = crc_mod("doc_id", 5) == 0
    model = toxicity.train_toxicity(docs, labels.filter(~held_out))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents")).drop("host", "host_rate")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like marks of the template."""
    text = r"\### Assistant: </turn> ok"
    tables = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(chat.format_turns(tables.unionByName(marks)))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract_main_text(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from rows that aren't held out; every third row by crc32 is."""
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    model = language.train_languages(docs.filter(~held_out))
    return language.detect_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.write_training_order(read(spark, sf_dir, "documents"), token_shards.new_folder(spark))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's crc32 is divisible by 7 are folded with one character more than they have."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns]
    marked = F.col("doc_id").isNotNull() & (crc_mod("doc_id", 7) == 0)
    return merkle.dataset_manifest(read(spark, sf_dir, "documents"), columns=columns, tampered=tampered, tampered_rows=marked)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.count_tokens(read(spark, sf_dir, "documents"))
    return found.withColumn("over_limit", F.col("n_tokens") > 1024)


QUERIES: dict[str, Run] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_quality_rules,
        op3_chat,
        op4_html_extraction,
        op5_simhash,
        op6_decontamination,
        op7_mixing,
        op8_language,
        op9_token_shards,
        op10_line_dedup,
        op11_merkle,
        op12_collocations,
        op13_token_counts,
    )
}

CHECKS: dict[str, str] = {
    "op2_quality_rules": quality_rules.CHECK,
    "op3_chat": chat.CHECK,
    "op7_mixing": mixing.CHECK,
    "op10_line_dedup": line_dedup.CHECK,
    "op11_merkle": merkle.CHECK,
    "op12_collocations": collocations.CHECK,
}
