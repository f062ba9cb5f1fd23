"""The corpus pipeline: from raw documents to shards of token ids in training order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheetloom.llm import stages
from sheetloom.sources.staging import collected, release, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", stages.quality_rules),
    ("SimHash near-dedup", stages.simhash_dedup),
    ("benchmark decontamination", stages.decontamination),
    ("mixing sources to target weights", stages.mixing),
    ("token-ID / binary output", stages.token_output),
]

#: Fingerprints, the latent space and tokenization have no SQL; tests hold the
#: pipeline against a version in plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the shards; tables in between are deleted once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, apply in STAGES[:-1]:
        with collected() as folders:
            docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "_"))
        release(spark, before + folders[:-1])
        before = folders[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
