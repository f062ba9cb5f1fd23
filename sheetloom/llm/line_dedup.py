"""Line dedup: lines that many documents share stay in one document only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import SPACE_CHARS, lower_ascii
from sheetloom.sources.staging import stage


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id_col, n_lines, n_dropped, text`` (the kept lines).

    Texts are split at ``\\n``.  A line's key is the line without white space at
    its ends, A-Z in lower case.  Keys of ``min_chars`` code points or more that
    occur in ``min_docs`` or more documents lose their lines everywhere but in
    the document with the largest id.

    Only 128 bits of hash, the position and the id of long lines are shuffled to
    count; the count combines before the shuffle, so a line of every third
    document is no hot spot.  The shared lines are written first: the join back is
    a broadcast where their size allows, and else one whose skewed partitions Spark
    splits.  Dropped positions then meet the texts again.

    A null text is one empty line.  Rows with a null id count as one document
    below all others.  Rows that repeat an id count once and get the same verdict.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    key = lower_ascii(F.btrim("line", F.lit(SPACE_CHARS)))
    lines = stage(
        rows.select("id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("id", "text_hash", "pos", key.alias("key"))
        .filter(F.length("key") >= min_chars)
        .select(
            "id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
        ),
        "lines",
    )
    shared = stage(
        lines.groupBy("h1", "h2")
        .agg(
            (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("n_docs"),
            F.max("id").alias("keeper"),
        )
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper"),
        "shared",
    )
    drops = stage(
        lines.join(shared, ["h1", "h2"])
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias("drop_id"), F.col("text_hash").alias("drop_hash"))
        .agg(F.collect_set("pos").alias("positions")),
        "drops",
    )
    same = F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("text_hash") == F.col("drop_hash"))
    id_type = rows.schema["id"].dataType.simpleString()
    out = rows.join(drops, same, "left").select("id", "text", "positions").mapInArrow(
        _without_lines, f"id {id_type}, n_lines long, n_dropped long, text string"
    )
    return out.withColumnRenamed("id", id_col)


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, texts = [], [], []
        for text, positions in zip(batch["text"].to_pylist(), batch["positions"].to_pylist()):
            dropped = frozenset(positions or ())
            n_dropped.append(len(dropped))
            n_lines.append(text.count("\n") + 1)
            if dropped:
                text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in dropped)
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
            names=["id", "n_lines", "n_dropped", "text"],
        )


CHECK = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
