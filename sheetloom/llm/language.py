"""Language ID: a mixture of languages for each document, by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.ngrams import CHARS, SPACE, blocks, hashed, letters
from sheetloom.llm.sums import SCHEMA, add_up, packed

#: Trigrams are counted in so many buckets (as a power of two) for each language.
ORDER, BITS = 3, 16
#: Added to each count.
SMOOTHING = 0.5
#: Each language of a mixture costs so many times half the logarithm of the number of words.
PENALTY = 4.0
STEPS, CLOSE = 30, 1e-3


@dataclass
class LanguageModel:
    """Log-likelihoods of trigram buckets, ``buckets x languages``."""

    languages: list
    table: np.ndarray


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of a partition, a compressed row per language."""
    sums: dict = {}
    for batch in batches:
        langs = np.array(batch["lang"].to_pylist(), object)
        for first, end, codes, starts in blocks(batch["text"]):
            places, buckets = hashed(codes, ORDER, BITS)
            doc = np.searchsorted(starts, places, "right") - 1
            names, numbers = np.unique(langs[first:end], return_inverse=True)
            found = np.bincount((numbers[doc] << BITS) + buckets, minlength=len(names) << BITS)
            for lang, counts in zip(names, found.reshape(len(names), -1)):
                sums[lang] = sums.get(lang, 0) + counts
    yield packed(sums)


def train_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Counts all trigrams of all rows whose language is not null.

    Partitions count for themselves; their sums (a fixed number of buckets for each
    language) are added in two steps, so that no task adds up more than its share
    and the driver gets one row per language.
    """
    rows = docs.filter(F.col(lang_col).isNotNull()).select(letters(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    found = sorted(add_up(rows.mapInArrow(_count, SCHEMA)).items())
    counts = np.array([c for _, c in found]).reshape(len(found), 1 << BITS).T
    share = (counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * len(counts))
    return LanguageModel([lang for lang, _ in found], np.log(share).astype(np.float32))


def _expectation_maximisation(like: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood (relative to each word's best language) of each document.

    ``like``: likelihood of each word in each language; ``starts``: each document's
    first word; ``allowed``: the languages a document may have.
    """
    n_words = np.diff(np.append(starts, len(like)))
    share = allowed / allowed.sum(1, keepdims=True)
    open_docs, words, first, count = np.arange(len(starts)), like, starts, n_words
    for _ in range(STEPS):
        now = share[open_docs]
        joint = words * np.repeat(now, count, 0)
        joint /= np.maximum(joint.sum(1, keepdims=True), 1e-30)
        new = np.add.reduceat(joint, first, 0) / count[:, None]
        share[open_docs] = new
        moving = np.abs(new - now).max(1) > CLOSE
        if not moving.any():
            break
        if moving.sum() < 0.7 * len(moving):
            words = words[np.repeat(moving, count)]
            open_docs, count = open_docs[moving], count[moving]
            first = np.concatenate([[0], np.cumsum(count)[:-1]])
    mixed = np.log(np.maximum((like * np.repeat(share, n_words, 0)).sum(1), 1e-30))
    return share, np.add.reduceat(mixed, starts)


def infer_mixtures(word_like: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Language proportions of each document, of the set of languages with the best penalised likelihood.

    Sets are the k languages with the largest proportions in the mixture of all, k
    from 1 up.  A document for which even the mixture of all gains less over one
    language than a second language costs has one; the others try every k.
    """
    n_docs, n_langs = len(starts), word_like.shape[1]
    top = word_like.max(1, keepdims=True)
    like = np.exp(word_like - top)
    n_words = np.diff(np.append(starts, len(like)))
    cost = PENALTY * 0.5 * np.log(n_words + 1)
    single = np.add.reduceat(word_like - top, starts, 0)
    best = np.eye(n_langs)[single.argmax(1)]
    score = single.max(1) - cost
    # The most a mixture can gain is each word's best language for nothing.
    doubtful = np.flatnonzero(2 * cost < cost - single.max(1))
    if n_langs < 2 or not len(doubtful):
        return best

    def of(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.zeros(n_docs, bool)
        mask[docs] = True
        return like[np.repeat(mask, n_words)], np.concatenate([[0], np.cumsum(n_words[docs])[:-1]])

    share, whole = _expectation_maximisation(*of(doubtful), np.ones((len(doubtful), n_langs)))
    keep = whole - 2 * cost[doubtful] > score[doubtful]
    doubtful, share = doubtful[keep], share[keep]
    if not len(doubtful):
        return best
    words, first = of(doubtful)
    rank = (-share).argsort(1, kind="stable").argsort(1, kind="stable")
    for k in range(2, n_langs + 1):
        found, whole = _expectation_maximisation(words, first, (rank < k).astype(float))
        whole -= k * cost[doubtful]
        better = whole > score[doubtful]
        best[doubtful[better]] = found[better]
        score[doubtful[better]] = whole[better]
    return best


def detect_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: ``id_col, lang_pred, score, shares``.

    A document is a mixture of languages; each word comes from one of them, with the
    likelihood of its trigrams.  ``shares`` are the proportions of the chosen set of
    languages, ``lang_pred`` the largest (ties: the first by name), ``score`` its
    share.

    Null texts and texts without a letter (marks alone are none) are ``und`` with score 0, as is everything
    where no language was learned.  Rows are independent: repeated rows get equal
    results; extra columns are ignored.
    """
    languages, table = model.languages, model.table
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars = max(CHARS * 4 // max(len(languages), 4), 1 << 16)
        for batch in batches:
            shares = np.zeros((batch.num_rows, len(languages)))
            for first, _, codes, starts in blocks(batch["text"], chars) if languages else ():
                places, buckets = hashed(codes, ORDER, BITS)
                words = np.flatnonzero(codes[places] == SPACE)
                if not len(words):
                    continue
                like = np.add.reduceat(table[buckets], words, 0)
                doc, begin = np.unique(np.searchsorted(starts, places[words], "right") - 1, return_index=True)
                shares[first + doc] = infer_mixtures(like, begin)
            shares[~batch["lettered"].to_numpy(zero_copy_only=False)] = 0
            best = shares.argmax(1) if languages else np.zeros(batch.num_rows, int)
            score = shares.max(1) if languages else np.zeros(batch.num_rows)
            pred = [languages[b] if s > 0 else "und" for b, s in zip(best, score)]
            lists = [[(languages[j], float(row[j])) for j in np.flatnonzero(row)] for row in shares]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(pred, pa.string()),
                    pa.array(np.clip(score, 0, 1)),
                    pa.array(lists, pa.map_(pa.string(), pa.float64())),
                ],
                names=["id", "lang_pred", "score", "shares"],
            )

    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    rows = docs.select(F.col(id_col).alias("id"), letters(text_col).alias("text"), lettered)
    return rows.mapInArrow(run, f"id {id_type}, lang_pred string, score double, shares map<string,double>").withColumnRenamed("id", id_col)
