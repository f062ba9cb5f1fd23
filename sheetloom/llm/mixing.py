"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.common import n_words
from sheetloom.operators.ids import sequence_ids
from sheetloom.sources.staging import stage

#: Ranks of a source are cut into so many bins, so that no task sorts a whole source.
BINS = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_copies: int = 3) -> DataFrame:
    """``source, source_size`` -> also ``source_no`` (from 1) and ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the
    sum of all sizes.  A target stops at ``max_copies`` times its source's size; the
    excess goes to the others by weight until none is above.  Only sums come to the
    driver, so that there may be any number of sources.
    """
    ranked = stage(
        sequence_ids(
            sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "source_no"
        ).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))),
        "sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * max_copies
    level, n_full = 0.0, -1
    while True:
        full = F.col("weight") * level > limit if n_full >= 0 else F.lit(False)
        row = ranked.agg(
            F.sum(F.when(full, limit)).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("n_full"),
        ).first()
        if row["n_full"] == n_full or not row["weight"]:
            break
        n_full, level = row["n_full"], (total - (row["taken"] or 0)) / row["weight"]
    target = F.least(F.col("weight") * F.lit(float(level)), limit.cast("double"))
    return ranked.select("source", "source_no", "source_size", target.alias("target"))


def row_key(seed: int) -> Column:
    """Names a row, and is the source of its random number: a hash of seed, id and text."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), text).cast("binary"))


def uniform(key: Column) -> Column:
    """A number in (0, 1) from a hexadecimal hash."""
    return (F.conv(F.substring(key, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))


def mix_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_copies: int = 3,
    seed: int = 42,
    affinity: Column | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, row_key, size, source_size, target, copies, taken``.

    A source whose target is r times its size expects r copies of each document
    (with ``affinity``, a positive column, r times the document's share of it, up to
    ``max_copies``).  The whole copies are certain.  Documents then rank by the odds
    of a random number over the odds of their remaining inclusion probability, and
    the first of them fill what the target still lacks, to within half a document.

    The prefix sum behind "first" is made in two steps, over bins of the rank and
    within a bin, so that a source with a third of all rows is many tasks.  Bins are cut
    on the rank as it would be spread if all documents had the source's mean probability,
    so they are of about equal size also where that is close to 0 or 1.

    Random numbers are hashes of id and text: reruns agree, and repeated rows tie
    (either of them may get the copy, the result is the same).  Null texts have size
    0; null ids are ids like any other; null sources are the last source.  Empty
    tables give empty results; extra columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id",
        "source",
        n_words(text).alias("size"),
        row_key(seed).alias("row_key"),
        (F.lit(1.0) if affinity is None else affinity.cast("double")).alias("affinity"),
    )
    rows = stage(base, "sizes")
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.try_divide(F.sum(F.col("size") * F.col("affinity")), F.sum("size")).alias("mean_affinity"),
    )
    targets = source_targets(sizes.select("source", "source_size"), weights, max_copies)
    named = stage(
        targets.join(sizes.withColumnRenamed("source", "own").drop("source_size"), F.col("source").eqNullSafe(F.col("own"))).drop("own"),
        "targets",
    ).withColumnRenamed("source", "of")
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    share = F.coalesce(F.try_divide("affinity", "mean_affinity"), F.lit(1.0))
    odds = F.col("u") * (1 - F.col("p"))
    planned = (
        rows.join(named, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("expected", F.least(ratio * share, F.lit(float(max_copies))))
        .withColumn("whole", F.floor(F.col("expected") + 1e-9))
        .withColumn("p", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
        .withColumn("u", uniform(F.col("row_key")))
        .withColumn("z", F.when(F.col("p") > 0, odds / (odds + (1 - F.col("u")) * F.col("p"))))
        .withColumn("bin", F.floor(F.coalesce(_evened("z", ratio), "u") * BINS))
        .withColumn("ranked", F.when(F.col("z").isNotNull(), F.col("size")).otherwise(0))
        .select("doc_id", "row_key", "size", "source_no", "source_size", "target", "whole", "z", "bin", "ranked")
    )
    by_bin = planned.groupBy("source_no", "bin").agg(
        F.sum("ranked").alias("bin_size"), F.sum(F.col("whole") * F.col("size")).alias("bin_whole")
    )
    earlier = Window.partitionBy("source_no").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bin.select(
        "source_no",
        "bin",
        F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)).alias("start"),
        F.sum("bin_whole").over(Window.partitionBy("source_no")).alias("source_whole"),
    )
    within = Window.partitionBy("source_no", "bin").orderBy("z", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("ranked").over(within), F.lit(0))
    lacking = F.col("target") - F.col("source_whole")
    extra = F.col("z").isNotNull() & (F.col("before") + F.col("size") / 2 <= F.col("lacking"))
    return (
        planned.join(starts, ["source_no", "bin"])
        .withColumn("before", before)
        .withColumn("lacking", lacking)
        .withColumn("copies", (F.col("whole") + extra.cast("int")).cast("int"))
        .select(
            "doc_id", "row_key", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
        )
    )


def _evened(z: str, ratio: Column) -> Column:
    """A rank, in the same order, as the random number that gives it at the source's mean probability."""
    p = F.least(F.greatest(ratio - F.floor(ratio + 1e-9), F.lit(1e-9)), F.lit(1 - 1e-9))
    odds = F.col(z) * p
    return odds / (odds + (1 - F.col(z)) * (1 - p))


def sample_mix(docs: DataFrame, seed: int = 42, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    Rows that repeat id and text share their copies out among themselves.
    """
    plan = mix_documents(docs, seed=seed, **options)
    dealt = stage(
        plan.groupBy(F.col("row_key").alias("mix_key")).agg(F.sum("copies").alias("mix_copies"), F.count("*").alias("mix_rows")),
        "copies",
    ).filter("mix_copies > 0")
    rows = docs.select(row_key(seed).alias("mix_key"), F.struct(*docs.columns).alias("mix_row"))
    turn = F.row_number().over(Window.partitionBy("mix_key").orderBy("mix_key"))
    more = (F.col("mix_turn") <= F.col("mix_copies") % F.col("mix_rows")).cast("int")
    times = (F.floor(F.col("mix_copies") / F.col("mix_rows")) + more).cast("int")
    return (
        rows.join(dealt, "mix_key")
        .withColumn("mix_turn", turn)
        .withColumn("mix_times", times)
        .filter("mix_times > 0")
        .select("mix_row", F.explode(F.sequence(F.lit(1), "mix_times")))
        .select("mix_row.*")
    )


CHECK = """
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_no
  FROM totals),
by_room AS (
  SELECT *,
    coalesce(sum(3 * source_size) OVER before, 0) AS full_size,
    (SELECT sum(source_size) FROM totals) AS total,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight,
    row_number() OVER (ORDER BY 3.0 * source_size / weight, source_no) AS place
  FROM weighed
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT arg_min((total - full_size)::DOUBLE / open_weight, place) FILTER (
    (total - full_size)::DOUBLE / open_weight * weight <= 3 * source_size) AS level FROM by_room),
targets AS (
  SELECT source, source_no, source_size, least(weight * (SELECT level FROM levels), (3 * source_size)::DOUBLE) AS target
  FROM weighed),
planned AS (
  SELECT doc_id, size, source_no, source_size, target, floor(target / source_size + 1e-9) AS whole,
         greatest(target / source_size - floor(target / source_size + 1e-9), 0) AS p,
         md5('42:' || doc_id || ':' || md5(body)) AS row_key,
         (('0x' || substr(row_key, 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / (u * (1 - p) + (1 - u) * p) END AS z FROM planned),
summed AS (
  SELECT *, coalesce(sum(CASE WHEN z IS NOT NULL THEN size END) OVER (
              PARTITION BY source_no ORDER BY z NULLS LAST, row_key
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         target - sum(whole * size) OVER (PARTITION BY source_no) AS lacking
  FROM ranked)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN z IS NOT NULL AND before + size / 2 <= lacking THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
