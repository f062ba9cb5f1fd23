"""Token counts: lengths of frequent pre-tokens from a broadcast table, the rest from worker caches."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.heavy import heavy_hitters
from sheetloom.llm.pretokens import blocks, character_classes, special_strings, split
from sheetloom.llm.tokens import TOKENIZERS

VOCABULARY = os.path.join(TOKENIZERS, "byte_bpe_50k.json")

#: Pre-tokens in the broadcast table, and the longest one that it or a cache takes.
FREQUENT = 1 << 16
LONGEST = 64
#: Pre-tokens in a worker's cache.
CACHED = 1 << 17


def count_tokens(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    frequent: int = FREQUENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per input row: ``id_col, n_bytes, n_tokens`` of the whole text, as the vocabulary's library counts.

    Two narrow passes.  The first finds the most frequent pre-tokens of all texts in
    bounded summaries; their lengths become a table of at most ``frequent`` entries of
    ``LONGEST`` characters, which is broadcast with the vocabulary.  In the second a
    task looks up the distinct pre-tokens of about two million characters at a time
    and encodes what the table lacks through a cache of its worker.  No pre-token is
    shuffled, and what the table holds changes the speed alone, never a count.

    Special strings of the vocabulary count as the one token that they are.  Null
    texts are empty and have no token; equal texts count alike; a text is read whole
    and worked on in parts that end where a pre-token must.  Ids may be null or
    repeated.  Extra columns are ignored; an empty table gives an empty result.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        content = file.read()
    codec = Tokenizer.from_buffer(content)
    rules = {"vocabulary": content, "specials": special_strings(content), "classes": character_classes(codec).tobytes()}
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = heavy_hitters(rows.select("text"), _counted(spark.sparkContext.broadcast(rules)), frequent)
    table = sorted(found, key=lambda t: (-found[t], t))
    lengths = [len(codec.encode(t, add_special_tokens=False).ids) for t in table]
    known = spark.sparkContext.broadcast(rules | {"table": table, "lengths": lengths})
    id_type = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(_lengths(known), f"id {id_type}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col)


def _classes(rules: dict) -> np.ndarray:
    return np.frombuffer(rules["classes"], np.uint8)


def _counted(shared: Broadcast):
    """Distinct pre-tokens of a batch that are not too long, with their counts."""

    def counted(batch: pa.RecordBatch) -> Iterator[tuple[list[str], list[int]]]:
        rules = shared.value
        for texts, _ in blocks(batch["text"].to_pylist()):
            found = split(texts, _classes(rules), rules["specials"])
            coded = found.tokens.dictionary_encode()
            times = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            times -= np.bincount(coded.indices.to_numpy()[found.special], minlength=len(times))
            usual = np.flatnonzero((pc.utf8_length(coded.dictionary).to_numpy() <= LONGEST) & (times > 0))
            yield coded.dictionary.take(pa.array(usual)).to_pylist(), times[usual].tolist()

    return counted


def _encoder(rules: dict):
    """Tokens of one pre-token, by the library; kept with the broadcast value for the worker's later tasks."""
    if "encoder" not in rules:
        from tokenizers import Tokenizer

        codec = Tokenizer.from_buffer(rules["vocabulary"])

        def length(token: str) -> int:
            return len(codec.encode(token, add_special_tokens=False).ids)

        cached = lru_cache(CACHED)(length)
        rules["encoder"] = lambda token: cached(token) if len(token) <= LONGEST else length(token)
    return rules["encoder"]


def _lengths(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = shared.value
        classes, encode = _classes(rules), _encoder(rules)
        table = pa.array(rules["table"], pa.string())
        known = np.append(np.array(rules["lengths"], np.int64), -1)
        for batch in batches:
            total = np.zeros(batch.num_rows, np.int64)
            for texts, owner in blocks(batch["text"].to_pylist()):
                found = split(texts, classes, rules["specials"])
                coded = found.tokens.dictionary_encode()
                place = pc.fill_null(pc.index_in(coded.dictionary, value_set=table), len(table))
                length = known[place.to_numpy(zero_copy_only=False)]
                missing = np.flatnonzero(length < 0)
                length[missing] = [encode(t) for t in coded.dictionary.take(pa.array(missing)).to_pylist()]
                each = length[coded.indices.to_numpy()]
                each[found.special] = 1
                sums = np.concatenate([[0], np.cumsum(each)])[found.first]
                np.add.at(total, owner, np.diff(sums))
            n_bytes = pc.cast(pc.binary_length(batch["text"]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["id"], n_bytes, pa.array(total)], names=["id", "n_bytes", "n_tokens"])

    return run
