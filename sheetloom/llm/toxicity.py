"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.ngrams import blocks, hashed, letters
from sheetloom.sources.staging import stage

#: n-grams of these lengths share buckets (as a power of two).
ORDERS, BITS = (3, 4, 5), 20
#: Buckets with the clearest ratios that become features.
FEATURES = 2048
#: Labelled rows of each class that the classifier is fitted on, at most.
ROWS_PER_CLASS = 6000


@dataclass
class ToxicityModel:
    """``weight``: what a bucket adds to the score of a text that has it; ``bias``: the score without any."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def _distinct(text: str, scratch: np.ndarray) -> np.ndarray:
    for _, _, codes, _ in blocks([pa.scalar(text)], 1 << 40):
        found = np.concatenate([hashed(codes, n, BITS)[1] for n in ORDERS])
        order = np.arange(len(found))
        scratch[found] = order
        return found[scratch[found] == order]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scratch = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        rows = [np.sort(_distinct(t.as_py() or "", scratch)).astype(np.int32) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["label"], pa.array(rows, pa.list_(pa.int32()))], names=["label", "buckets"])


def _fit(
    index: np.ndarray, size: np.ndarray, y: np.ndarray, ratio: np.ndarray, l2: float = 1e-4, steps: int = 300
) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ratio, by accelerated gradient steps.

    ``index`` holds the features of all rows one after the other, ``size`` how many each has.
    """
    row = np.repeat(np.arange(len(y)), size)
    scale = ratio[index]

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, scale * w[index], len(y))

    def backward(e: np.ndarray) -> np.ndarray:
        return np.bincount(index, scale * e[row], len(ratio)) / len(y)

    # The step follows from the largest eigenvalue of the features' second moments.
    v, largest = np.ones(len(ratio)), 1.0
    for _ in range(20):
        v = backward(forward(v))
        largest = max(float(np.linalg.norm(v)), 1e-12)
        v /= largest
    rate = 1 / (0.25 * (1.2 * largest + 1) + l2)
    w, b, last_w, last_b = np.zeros(len(ratio)), 0.0, np.zeros(len(ratio)), 0.0
    for t in range(steps):
        ahead_w = w + t / (t + 3) * (w - last_w)
        ahead_b = b + t / (t + 3) * (b - last_b)
        error = 1 / (1 + np.exp(-np.clip(forward(ahead_w) + ahead_b, -30, 30))) - y
        last_w, last_b = w, b
        w, b = ahead_w - rate * (backward(error) + l2 * ahead_w), ahead_b - rate * error.mean()
    return w * ratio, b


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    rows_per_class: int = ROWS_PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Fits on labelled rows, about ``rows_per_class`` of each class at most (picked by a hash of the id).

    A bucket's log-count ratio compares the share of toxic with that of other rows
    that have it; the buckets whose shares differ most clearly become features, and
    a logistic regression on presence times ratio weighs them.  Counts are Spark
    aggregates; the driver gets the features' counts and the features of the picked
    rows, both of bounded size.

    Null labels and ids are left out; the larger of several labels of an id holds.
    Without labels of both classes every text scores the smoothed share of label 1.
    """
    one = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg((F.max(label_col) > 0).cast("int").alias("label"))
    )
    n = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    prior = (n1 + 0.5) / (n0 + n1 + 2)
    nothing = ToxicityModel(np.zeros(0, np.int64), np.zeros(0), _logit(prior))
    if not n0 or not n1:
        return nothing
    dice = F.pmod(F.xxhash64("label_id", F.lit("toxicity")), F.lit(1_000_000)) / 1_000_000
    picked = stage(one.filter(dice < F.when(F.col("label") == 1, rows_per_class / n1).otherwise(rows_per_class / n0)), "labels")
    texts = docs.select(F.col(id_col).alias("text_id"), letters(text_col, digits=True).alias("text"))
    texts = texts.join(F.broadcast(picked), F.col("text_id") == F.col("label_id")).select("label", "text")
    rows = stage(texts.mapInArrow(_features, "label int, buckets array<int>"), "toxic_features")
    m = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    m0, m1 = m.get(0, 0), m.get(1, 0)
    if not m0 or not m1:
        return nothing
    has = rows.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.sum("label").alias("k1"), (F.count("*") - F.sum("label")).alias("k0")
    )
    share = (F.col("k1") + F.col("k0") + 1) / (m1 + m0 + 2)
    clear = (F.col("k1") / m1 - F.col("k0") / m0) / F.sqrt(share * (1 - share))
    best = has.withColumn("clear", F.abs(clear)).orderBy(F.desc("clear"), "bucket").limit(FEATURES).collect()
    buckets = np.array([r["bucket"] for r in best], np.int64)
    k1, k0 = (np.array([r[k] for r in best], float) for k in ("k1", "k0"))
    ratio = np.log((k1 + 1) / (m1 + 2)) - np.log((k0 + 1) / (m0 + 2))
    number = np.full(1 << BITS, -1, np.int32)
    number[buckets] = np.arange(len(buckets))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [number[b.values.to_numpy()] for b in batch["buckets"]]
            found = pa.array([f[f >= 0] for f in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["label"], found], names=["label", "features"])

    sample = rows.mapInArrow(narrow, "label int, features array<int>").toArrow().combine_chunks()
    features = sample["features"].combine_chunks()
    y = sample["label"].to_numpy().astype(float)
    weights, bias = _fit(features.flatten().to_numpy(), features.value_lengths().to_numpy(), y, ratio)
    return ToxicityModel(buckets, weights, bias + _logit(prior) - _logit((m1 + 0.5) / (m0 + m1 + 2)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: ``id_col, score`` (0 to 1, higher: toxic likelier), of the whole text.

    Null and empty texts score the bias alone.  Equal texts score alike; extra
    columns are ignored; an empty table gives an empty result.
    """
    buckets, weights, bias = model.buckets, model.weights, model.bias
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(1 << BITS, -1, np.int32)
        number[buckets] = np.arange(len(buckets))
        for batch in batches:
            sums = np.zeros(batch.num_rows)
            for first, end, codes, starts in blocks(batch["text"]):
                pairs = []
                for n in ORDERS:
                    places, found = hashed(codes, n, BITS)
                    feature = number[found]
                    hit = np.flatnonzero(feature >= 0)
                    doc = np.searchsorted(starts, places[hit], "right") - 1
                    pairs.append(doc * len(buckets) + feature[hit])
                once = np.unique(np.concatenate(pairs))
                if len(once):
                    sums[first:end] = np.bincount(once // len(buckets), weights[once % len(buckets)], end - first)
            score = 1 / (1 + np.exp(-np.clip(sums + bias, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(score)], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), letters(text_col, digits=True).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)
