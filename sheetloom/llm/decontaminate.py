"""Benchmark decontamination by latent semantic retrieval."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StructField, StructType

from sheetloom.llm.ngrams import blocks
from sheetloom.llm.sums import SCHEMA, add_up, packed
from sheetloom.llm.wordhash import fold, fold_table, word_hashes
from sheetloom.sources.staging import stage

#: A benchmark passage has at most so many words; documents are read in windows of
#: twice as many, at every such step, so that each stretch of that length lies whole
#: within a window.
PASSAGE = 40
#: Latent dimensions, dimensions of the random sketch, passes over the matrix.
RANK, SKETCH, PASSES = 192, 224, 4
#: Least cosine of a candidate.
COSINE = 0.6
#: A passage is found where this share of its words lies in a window in order ...
LCS = 0.6
#: ... or this share (a paraphrase) along with the answer: the item's last words.
PARAPHRASE, ANSWER_WORDS, ANSWER = 0.3, 8, 0.75
#: Passages of fewer words are found as a run of words only; a run of so many is a candidate in itself.
SHORT = 8
#: Dimensions of the latent space's terms; beyond this number terms share them, there alone.
MAX_TERMS = 1 << 17
#: Passages that are looked for at once.
BLOCK = 20_000
#: Pairs of a window and a passage that are weighed at once.
CELLS = 1 << 22


def passages(words: np.ndarray) -> list[np.ndarray]:
    """An item's words in pieces of at most PASSAGE words; the last one ends with the item."""
    starts = list(range(0, max(len(words) - PASSAGE, 0), PASSAGE)) + [max(len(words) - PASSAGE, 0)]
    return [words[s : s + PASSAGE] for s in starts]


def _item_passages(table: DataFrame, id_col: str, text_col: str) -> list[tuple]:
    """``item id, passage words, answer words`` of the benchmark, hashed where it lies."""
    id_type = table.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars = fold_table()
        for batch in batches:
            ids, found, answers = [], [], []
            for first, end, codes, starts in blocks(batch["text"]):
                h, at = word_hashes(fold(codes, chars), starts)
                for i in range(first, end):
                    words = h[at[i - first] : at[i - first + 1]].view(np.int64)
                    if len(words):
                        for p in passages(words):
                            ids.append(batch["id"][i].as_py())
                            found.append(p)
                            answers.append(words[-ANSWER_WORDS:])
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch["id"].type), pa.array(found, longs), pa.array(answers, longs)],
                names=["id", "words", "answer"],
            )

    rows = table.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, words array<long>, answer array<long>")


class Terms:
    """The benchmark's words: sorted hashes, the number of each, and its dimension in the latent space."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.size = len(self.hashes)
        self.latent = min(self.size, MAX_TERMS)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.hashes >> np.uint64(44)] = True

    def dimensions(self, words: np.ndarray) -> np.ndarray:
        """-1 for words that the benchmark doesn't have."""
        out = np.full(len(words), -1, np.int64)
        hit = np.flatnonzero(self.maybe[words >> np.uint64(44)])
        at = np.searchsorted(self.hashes, words[hit])
        at[at == len(self.hashes)] = 0
        same = self.hashes[at] == words[hit]
        out[hit[same]] = at[same]
        return out


def _stepped(dims: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of PASSAGE dimensions, each text's last one filled up with -1, and each text's number of rows (one at least)."""
    n = np.diff(at)
    steps = np.maximum(-(-n // PASSAGE), 1)
    out = np.full(steps.sum() * PASSAGE, -1, np.int32)
    shift = np.concatenate([[0], np.cumsum(steps[:-1] * PASSAGE)]) - at[:-1]
    out[np.arange(len(dims)) + np.repeat(shift, n)] = dims
    return out.reshape(-1, PASSAGE), steps


def term_table(docs: DataFrame, terms: Terms, text_col: str, kept: list) -> DataFrame:
    """Whole texts as dimensions, the only form in which they are read again: ``kept`` columns and ``dims``."""
    rows = docs.select(*kept, F.col(text_col).alias("text"))
    fields = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars, pack = fold_table(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            out = []
            for _, _, codes, starts in blocks(batch["text"]):
                h, at = word_hashes(fold(codes, chars), starts)
                rows, steps = _stepped(terms.dimensions(h), at)
                ends = np.cumsum(steps)
                out += [pack.compress(rows[e - n : e].tobytes()) for n, e in zip(steps, ends)]
            columns = [batch[f.name] for f in fields]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=[*(f.name for f in fields), "dims"])

    return stage(rows.mapInArrow(run, StructType([*fields, StructField("dims", BinaryType())])), "terms")


def _read(column: pa.Array, rows: int = 1 << 14) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts as rows of dimensions: first text, rows, each text's number of rows."""
    unpack = zstandard.ZstdDecompressor()
    first, held, size = 0, [], 0
    for i, text in enumerate(column):
        held.append(np.frombuffer(unpack.decompress(text.as_py()), np.int32).reshape(-1, PASSAGE))
        size += len(held[-1])
        if size >= rows or i == len(column) - 1:
            yield first, np.concatenate(held), np.array([len(x) for x in held])
            first, held, size = i + 1, [], 0


def passage_frequencies(table: DataFrame, terms: Terms) -> tuple[float, np.ndarray]:
    """Number of passages of all documents, and of those with each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(terms.size)
        for batch in batches:
            for _, rows, _ in _read(batch["dims"]):
                rows = np.sort(rows, axis=1)
                new = rows >= 0
                new[:, 1:] &= rows[:, 1:] != rows[:, :-1]
                total += np.bincount(rows[new], minlength=terms.size)
                n += len(rows)
        yield packed({"n": np.array([n]), "df": total})

    sums = add_up(table.select("dims").mapInArrow(run, SCHEMA))
    return float(sums["n"][0]), sums["df"]


def latent_space(items: DataFrame, terms: Terms, idf: np.ndarray, seed: int = 42) -> np.ndarray:
    """Right singular vectors of the passages' TF-IDF matrix, ``dimensions x rank``.

    Randomised subspace iteration: a random sketch is multiplied by the matrix and
    its transpose, passage by passage where the passages lie; only sums of the
    sketch's size (bounded by MAX_TERMS) are brought together and orthonormalised.
    """
    basis = np.random.default_rng(seed).standard_normal((terms.latent, SKETCH))

    def multiply(basis: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(basis)
            for batch in batches:
                for words in batch["words"]:
                    dims, tf = np.unique(terms.dimensions(words.values.to_numpy().view(np.uint64)), return_counts=True)
                    row = tf * idf[dims]
                    row /= np.linalg.norm(row) or 1.0
                    np.add.at(total, dims % terms.latent, np.outer(row, row @ basis[dims % terms.latent]))
            yield packed({"product": total.ravel()})

        return run

    for _ in range(PASSES):
        basis, _ = np.linalg.qr(basis)
        product = add_up(items.mapInArrow(multiply(basis), SCHEMA))["product"].reshape(basis.shape)
        last, basis = basis, product
    values, vectors = np.linalg.eigh(last.T @ product)
    top = np.argsort(-values)[:RANK]
    return (last @ vectors[:, top[values[top] > 1e-9]]).astype(np.float32)


@dataclass
class Passages:
    """What is looked for at once."""

    items: list
    words: list[np.ndarray]  # as numbers of terms
    answers: list[np.ndarray]
    latent: np.ndarray


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit_benchmark(items: list, table: DataFrame, terms: Terms, passages_df: DataFrame) -> tuple[np.ndarray, list[Passages]]:
    """The latent place of every term, weighed by all documents, and the benchmark's passages in blocks."""
    n, df = passage_frequencies(table, terms)
    idf = np.log((n + 1) / (df + 1)) + 0.01
    space = latent_space(passages_df, terms, idf)[np.arange(terms.size) % max(terms.latent, 1)] * idf[:, None].astype(np.float32)
    dims = [terms.dimensions(np.array(r["words"], np.int64).view(np.uint64)) for r in items]
    answers = [terms.dimensions(np.array(r["answer"], np.int64).view(np.uint64)) for r in items]
    latent = _unit(np.array([space[d].sum(0) for d in dims]))
    ids = [r["id"] for r in items]
    cut = [slice(i, i + BLOCK) for i in range(0, len(ids), BLOCK)]
    return space, [Passages(ids[c], dims[c], answers[c], latent[c]) for c in cut]


def lcs_length(masks: dict[int, int], size: int, window: list[int]) -> int:
    """Length of the longest common subsequence, all rows of the table at once in the bits of a number."""
    row = full = (1 << size) - 1
    for word in window:
        match = masks.get(word, 0)
        if match:
            taken = row & match
            row = ((row + taken) | (row - taken)) & full
    return size - row.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` words along the last axis; equal runs have equal ones."""
    n = words.shape[-1] - size + 1
    out = np.zeros((*words.shape[:-1], max(n, 0)), np.uint64)
    if n > 0:
        values = (words.astype(np.uint64) + np.uint64(2)) * np.uint64(0x9E3779B97F4A7C15)
        for j in range(size):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + values[..., j : j + n]
    return out


class _Runs:
    """The passages that hold a run of words; what it finds is only a candidate."""

    def __init__(self, passages: list[np.ndarray], size: int, chosen: list[int]) -> None:
        self.size = size
        own = [np.unique(_runs(passages[p], size)) for p in chosen]
        run = np.concatenate(own)
        order = np.argsort(run, kind="stable")
        self.run = run[order]
        self.passage = np.repeat(chosen, [len(o) for o in own])[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.run >> np.uint64(44)] = True

    def find(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        runs = _runs(windows, self.size)
        row, column = np.nonzero(self.maybe[runs >> np.uint64(44)])
        wanted = runs[row, column]
        low, high = (np.searchsorted(self.run, wanted, side) for side in ("left", "right"))
        count = high - low
        at = np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)
        return np.repeat(row, count), self.passage[at]


class _Search:
    def __init__(self, space: np.ndarray, block: Passages) -> None:
        self.block = block
        # The row that -1 finds is zero.
        self.space = np.concatenate([space, np.zeros((1, space.shape[1]), np.float32)])
        self.latent = np.ascontiguousarray(block.latent.T)
        self.words = [w.tolist() for w in block.words]
        self.masks = [_masks(w) for w in self.words]
        self.answers = [(_masks(w.tolist()), len(w)) for w in block.answers]
        sizes = np.minimum([len(w) for w in self.words], SHORT)
        self.runs = [_Runs(block.words, int(n), np.flatnonzero(sizes == n).tolist()) for n in np.unique(sizes)]
        self.long = sizes == SHORT

    def find(self, column: pa.Array) -> list[list[tuple]]:
        """For each text the items in it, with the share of words in order."""
        out: list[list[tuple]] = [[] for _ in range(len(column))]
        for first, rows, steps in _read(column):
            latent = np.empty((len(rows), self.space.shape[1]), np.float32)
            for i in range(0, len(rows), 64):
                part = rows[i : i + 64]
                latent[i : i + 64] = self.space[part.ravel()].reshape(len(part), PASSAGE, -1).sum(1)
            # A window is a row and, unless it is the text's last, the next; one window for a single row.
            doc = np.repeat(np.arange(len(steps)), steps)
            last = np.append(doc[1:] != doc[:-1], True)
            window = np.flatnonzero(~last | (steps[doc] == 1))
            sums = latent[window]
            double = ~last[window]
            sums[double] += latent[window[double] + 1]
            sums = _unit(sums)
            step = min(2048, max(1, CELLS // len(self.words)))
            for i in range(0, len(window), step):
                part = window[i : i + step]
                follows = np.where(double[i : i + step, None], rows[np.minimum(part + 1, len(rows) - 1)], -1)
                near = (sums[i : i + step] @ self.latent >= COSINE) & self.long
                pairs, whole = near.copy(), np.concatenate([rows[part], follows], axis=1)
                for runs in self.runs:
                    pairs[runs.find(whole)] = True
                for a, p in zip(*np.nonzero(pairs)):
                    at = window[i + a]
                    share = self.share(rows[at : at + 1 + double[i + a]].ravel().tolist(), p, near[a, p])
                    if share:
                        out[first + doc[at]].append((self.block.items[p], share))
        return out

    def share(self, window: list[int], p: int, near: bool) -> float:
        """Share of a candidate's words that the window has in order, zero if it isn't found.

        A paraphrase must be ``near`` in the latent space, a verbatim stretch need not.
        """
        words = self.words[p]
        if len(words) < SHORT:
            runs = (window[i : i + len(words)] == words for i in range(len(window) - len(words) + 1))
            return float(any(runs))
        share = lcs_length(self.masks[p], len(words), window) / len(words)
        if share >= LCS:
            return share
        masks, size = self.answers[p]
        return share if near and share >= PARAPHRASE and lcs_length(masks, size, window) >= ANSWER * size else 0.0


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", with_rows: bool = False) -> DataFrame:
    """A row per input row: ``id_col, contaminated, item_ids, score``, with ``with_rows``
    also ``row``, the whole input row as a struct.

    Benchmark items are cut into passages and documents read in overlapping windows,
    whole.  Weights are inverse frequencies among all documents' passages; a randomised
    SVD of the passages' TF-IDF matrix gives a latent space.  Windows and passages whose
    cosine in it is large enough are candidates: that is how paraphrases are found.  A
    verbatim stretch, whose cosine the other words of its window may swamp, makes a pair a
    candidate by a run of eight words, or by all words of a shorter passage.  A candidate
    counts if the passage's words lie in the window in order for the most part; one that is
    near in the latent space also to a lesser part along with the item's last words (its
    answer).

    ``item_ids`` are the items found, in order; ``score`` the largest share of words
    in order (0: none).  Null and empty texts hold nothing; null and empty items are not
    looked for; a null item id is found like any other.  Repeated rows get equal
    results; extra columns are ignored; an empty benchmark finds nothing.
    """
    item_type = benchmark.schema[item_col].dataType
    queries = _item_passages(benchmark, item_col, "text")
    items = queries.collect()
    words = np.array([w for r in items for w in r["words"]], np.int64).view(np.uint64)
    terms = Terms(np.unique(words))
    kept = [F.col(id_col).alias("id"), F.array().cast(ArrayType(_hit(item_type))).alias("hits")]
    kept += [F.struct(*docs.columns).alias("row")] if with_rows else []
    if items:
        rows = term_table(docs, terms, text_col, kept)
        space, blocks_ = fit_benchmark(items, rows, terms, queries)
        sent = [docs.sparkSession.sparkContext.broadcast(vars(b)) for b in blocks_]
        rows = rows.mapInArrow(_searcher(space, sent), rows.schema)
    else:
        rows = docs.select(*kept)
    found = F.transform("hits", lambda x: x["item"])
    return rows.select(
        F.col("id").alias(id_col),
        (F.size("hits") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(found)).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("hits", lambda x: x["share"])), F.lit(0.0)).alias("score"),
        *(["row"] if with_rows else []),
    )


def _hit(item_type) -> StructType:
    return StructType([StructField("item", item_type), StructField("share", DoubleType())])


def _searcher(space: np.ndarray, blocks_: list[Broadcast]):
    """One block of passages after the other is looked for; a task holds one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = None
        for batch in batches:
            hits = [[] for _ in range(batch.num_rows)]
            for block in blocks_:
                if search is None or len(blocks_) > 1:
                    search = _Search(space, Passages(**block.value))
                for own, found in zip(hits, search.find(batch["dims"])):
                    own += [{"item": i, "share": s} for i, s in found]
            at = batch.schema.get_field_index("hits")
            yield batch.set_column(at, batch.schema.field(at), pa.array(hits, batch["hits"].type))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns."""
    return find_leaks(docs, benchmark, with_rows=True, **options).filter(~F.col("contaminated")).select("row.*")
