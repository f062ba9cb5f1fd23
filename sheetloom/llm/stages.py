"""The stages of the corpus pipeline: each calls one operator and lets its decisions take effect."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sheetloom.llm import decontaminate
from sheetloom.llm import mixing as mix
from sheetloom.llm import quality_rules as rules
from sheetloom.llm import simhash, token_shards
from sheetloom.llm.common import read
from sheetloom.sources.staging import collected, release

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders that stages of a run over one data folder have left, by the order of stages.
_left: dict[str, list[tuple[int, str]]] = {}


def _step(order: int) -> Callable[[Stage], Stage]:
    """A stage that first deletes what stages before it have staged for the same data folder.

    The result of a stage has to be written before the next stage is called on what was
    written; then nothing reads the tables that led to it.  Tables that the stage's own
    documents read, those of the same and later stages, and those of runs over other data
    are left alone.
    """

    def wrap(run: Stage) -> Stage:
        @wraps(run)
        def step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            before = _left.get(sf_dir, [])
            files = docs.inputFiles() if before else []
            read = {f for _, f in before if any(f.rpartition("/")[2] in file for file in files)}
            gone = [f for number, f in before if number < order and f not in read]
            release(spark, gone)
            with collected() as folders:
                out = run(spark, docs, sf_dir)
            _left[sf_dir] = [(n, f) for n, f in before if f not in gone] + [(order, f) for f in folders]
            return out

        return step

    return wrap


@_step(0)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return rules.quality_rules(docs, with_rows=True).filter("kept").select("row.*")


@_step(1)
def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.simhash_dedup(docs)


@_step(2)
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


@_step(3)
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it."""
    return mix.sample_mix(docs)


@_step(4)
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest of the shards: a row per sequence, with its place and documents."""
    return token_shards.write_training_order(docs, token_shards.new_folder(spark))
