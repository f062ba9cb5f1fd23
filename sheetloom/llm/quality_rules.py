"""Quality rules with host verdicts, in native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import SPACE_CHARS, WORD, words
from sheetloom.sources.staging import stage

#: Document-level rules: share of symbols in the characters, share of repeated lines.
MAX_SYMBOLS, MAX_DUP_LINES = 0.1, 0.5


#: Up to so many windows a text's positions ride in the low 14 bits of their hashes.
PACKED, BITS = 1 << 14, 14


def _repeated_positions() -> Column:
    """Sorted positions of windows whose hash ``h`` occurs twice in the row.

    Equal hashes are neighbours once sorted.  Longs sort fastest, so short texts
    sort the high 50 bits of the hash with the position below them; longer ones
    sort pairs of whole hash and position.
    """
    packed, pairs = F.col("packed"), F.col("pairs")

    def high(v: Column) -> Column:
        return F.shiftright(v, BITS)

    short = F.transform(
        F.filter(
            packed,
            lambda v, i: F.coalesce(high(v) == high(F.get(packed, i - 1)), F.lit(False))
            | F.coalesce(high(v) == high(F.get(packed, i + 1)), F.lit(False)),
        ),
        lambda v: v.bitwiseAND(F.lit(PACKED - 1)),
    )
    long = F.transform(
        F.filter(
            pairs,
            lambda v, i: F.coalesce(v["h"] == F.get(pairs, i - 1)["h"], F.lit(False))
            | F.coalesce(v["h"] == F.get(pairs, i + 1)["h"], F.lit(False)),
        ),
        lambda v: v["i"].cast("long"),
    )
    return F.sort_array(F.when(packed.isNotNull(), short).otherwise(long))


def document_features(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", with_rows: bool = False
) -> DataFrame:
    """``id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, a row per input row.

    With ``with_rows`` also ``row``, the whole input row as a struct.

    Everything is computed within the row: three-word windows are hashed, and one
    sort brings equal ones together, however long the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.length(F.btrim(line, F.lit(SPACE_CHARS))) > 0)
    w = F.col("words")
    rows = ["row"] if with_rows else []
    windows = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    base = (
        docs.select(
            F.col(id_col).alias("id"),
            F.col(host_col).alias("host"),
            text.alias("text"),
            *([F.struct(*docs.columns).alias("row")] if with_rows else []),
        )
        .select(
            "id",
            "host",
            *rows,
            words(F.col("text")).alias("words"),
            F.length(F.translate("text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            lines.alias("lines"),
        )
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("h", windows)
        .drop("lines", "words")
        .withColumn(
            "packed",
            F.when(
                F.size("h") <= PACKED,
                F.sort_array(F.transform("h", lambda v, i: F.shiftleft(v, BITS).bitwiseOR(i.cast("long")))),
            ),
        )
        .withColumn(
            "pairs",
            F.when(
                F.size("h") > PACKED,
                F.sort_array(F.transform("h", lambda v, i: F.struct(v.alias("h"), i.alias("i")))),
            ),
        )
    )
    p = F.col("repeated")
    covered = F.aggregate(
        F.transform(p, lambda v, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - v, F.lit(3))).cast("long")),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return (
        base.withColumn("repeated", _repeated_positions())
        .select("id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), *rows)
    )


def host_verdicts(features: DataFrame, max_rate: float = 0.8) -> DataFrame:
    """``host, n_docs, n_base, n_symbol, n_lines, n_failed, rate, host_rejected``.

    Failures of each rule are counted by host (combined before the shuffle, so a
    host with a third of all rows is no hot spot).  The share of documents that fail
    any rule is shrunk towards all hosts' with a beta prior fitted to the hosts by
    moments; hosts whose shrunk rate is above ``max_rate`` are rejected.
    """
    hosts = features.groupBy("host").agg(
        F.count("*").alias("n_docs"),
        F.count(F.when(F.col("base_failed"), 1)).alias("n_base"),
        F.count(F.when(F.col("symbols_failed"), 1)).alias("n_symbol"),
        F.count(F.when(F.col("lines_failed"), 1)).alias("n_lines"),
        F.count(F.when(F.col("base_failed") | F.col("symbols_failed") | F.col("lines_failed"), 1)).alias("n_failed"),
    )
    hosts = stage(hosts, "hosts")
    p = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(
        (F.sum("n_failed") / F.sum("n_docs")).alias("mean"),
        F.avg(p).alias("host_mean"),
        F.avg(p * p).alias("square"),
        F.avg(F.lit(1.0) / F.col("n_docs")).alias("inverse"),
    ).first()
    mean = min(max(prior["mean"] or 0.0, 1e-6), 1 - 1e-6)
    spread = (prior["square"] or 0.0) - (prior["host_mean"] or 0.0) ** 2 - mean * (1 - mean) * (prior["inverse"] or 0.0)
    strength = min(max(mean * (1 - mean) / max(spread, 1e-6) - 1, 1.0), 1e6)
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("host_rejected", F.col("rate") > max_rate)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_rate: float = 0.8,
    with_rows: bool = False,
) -> DataFrame:
    """A row per input row: ``id_col, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, host, host_rate``; with ``with_rows`` also
    ``row``, the whole input row as a struct.

    A document fails the base rules with fewer than 50 words or when more than half
    of its words lie in repeated three-word windows.  It is kept unless it fails
    them or its host is rejected (see ``host_verdicts``); the rules on symbols and
    repeated lines count against the host only.

    Null and empty texts have no words and fail.  Rows without a host are one host.
    Repeated rows each count; extra columns are ignored; an empty table gives an
    empty result.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    features = stage(
        document_features(docs, id_col, text_col, host_col, with_rows)
        .withColumn("base_failed", failed)
        .withColumn("symbols_failed", F.col("n_symbols") > MAX_SYMBOLS * F.col("word_chars"))
        .withColumn("lines_failed", F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_words")),
        "quality",
    )
    verdicts = stage(
        host_verdicts(features, max_rate).select(F.col("host").alias("judged"), "rate", "host_rejected"), "verdicts"
    )
    return features.join(verdicts, F.col("host").eqNullSafe(F.col("judged")), "left").select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"),
        "host",
        F.col("rate").alias("host_rate"),
        *(["row"] if with_rows else []),
    )


CHECK = f"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '{WORD}')) AS lines
  FROM documents),
base AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
  FROM split),
windows AS (
  SELECT doc_id, i, words[i:i + 2] AS window3
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
repeats AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, window3) AS n FROM windows) WHERE n >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT place)::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM repeats) GROUP BY doc_id),
judged AS (
  SELECT base.*, coalesce(n_repeat_words, 0) AS n_repeat_words,
         n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
  FROM base LEFT JOIN covered USING (doc_id)),
hosts AS (
  SELECT source, count(*) AS n,
         count(*) FILTER (base_failed OR n_symbols > {MAX_SYMBOLS}::DOUBLE * word_chars OR n_dup_lines > {MAX_DUP_LINES}::DOUBLE * n_words) AS k
  FROM judged GROUP BY source),
moments AS (
  SELECT least(greatest(sum(k) / sum(n), 1e-6), 1 - 1e-6) AS m, avg(k / n) AS hm, avg((k / n) * (k / n)) AS sq, avg(1.0 / n) AS inv
  FROM hosts),
prior AS (
  SELECT m, least(greatest(m * (1 - m) / greatest(sq - hm * hm - m * (1 - m) * inv, 1e-6) - 1, 1.0), 1e6) AS strength
  FROM moments),
verdicts AS (
  SELECT source, (k + m * strength) / (n + strength) > 0.8 AS rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""
