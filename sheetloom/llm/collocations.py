"""Phrase collocations by stripes: each first word keys counters of what follows it."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.heavy import heavy_hitters
from sheetloom.sources.staging import stage

#: Bytes of text that one flush of stripes counts, and entries that are merged at once.
BYTES = 6 << 20
ENTRIES = 1 << 20
#: A stripe is split by its next words into one part for every so much of all words.
SHARE = 1 / 2048

#: A row per language, first word and part.  ``total``: occurrences of the first word.
#: ``next``, ``n_next``: its next words and the pairs' counts, ``fan``: how many third words
#: each has, ``third``, ``n_third``: these and the triples' counts; all joined by spaces.
STRIPE = "lang string, word string, part int, total long, next string, n_next string, fan string, third string, n_third string"
_STRIPE_TYPES = [pa.string(), pa.string(), pa.int32(), pa.int64()] + [pa.string()] * 5
_STRIPE_NAMES = [field.split()[0] for field in STRIPE.split(", ")]

#: What merged stripes give: words' totals (``second`` null), pairs with the largest
#: count of a triple that begins with them, and triples with the count of their first pair.
FOUND = "lang string, first string, second string, third string, a long, other long"
_FOUND_NAMES = [field.split()[0] for field in FOUND.split(", ")]

_PUNCTUATION = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(10 if i in _PUNCTUATION else 32 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))


def collocations(
    docs: DataFrame,
    min_count: int = 10,
    subsumed_percent: int = 50,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The ``top`` phrases of two or three words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and split at ``. , ; : ! ?`` and line ends into
    pieces, and these at spaces and tabs into words.  ``a`` counts a phrase, ``l`` and
    ``r`` the two parts of its lowest-scoring cut, ``n`` all words of the language.  A
    phrase with ``min_count`` occurrences counts unless its words lie within a longer
    one that has ``subsumed_percent`` of them.  Scores are exact integers as long as a
    phrase has fewer than 10^13 occurrences; beyond that the query raises.

    A task sums up what follows each first word in some megabytes of text: a stripe of
    next words, each with a stripe of third words.  Stripes are shuffled by language and
    first word and merged elementwise; a merged stripe holds the pairs and triples with
    their counts, the totals of their prefixes and the largest extension of each pair.
    Words that make up a large share of all words have their stripes split by the next
    word, so that no task gets more than a share of the entries; which words these are
    comes from a bounded summary of all texts and changes no result.  What has fewer
    than ``min_count`` occurrences ends there.

    Null languages are ``und``; null and empty texts have no word.  Repeated rows
    count each time.  Extra columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    stripes = rows.mapInArrow(_stripes(_parts(rows)), STRIPE)
    merged = stripes.repartition("lang", "word", "part").sortWithinPartitions("lang", "word", "part")
    found = stage(merged.mapInArrow(_merged(min_count), FOUND), "collocations")
    totals = found.filter("second IS NULL").groupBy("lang", F.col("first").alias("word")).agg(F.sum("a").alias("n"))
    totals = stage(totals, "word_totals")
    words = totals.filter(F.col("n") >= min_count)
    pairs = found.filter("second IS NOT NULL AND third IS NULL")
    triples = found.filter("third IS NOT NULL")
    end = triples.groupBy("lang", F.col("second").alias("first"), F.col("third").alias("second")).agg(F.max("a").alias("longer"))
    pairs = stage(
        pairs.join(end, ["lang", "first", "second"], "left").withColumn("longer", F.greatest("other", F.coalesce("longer", F.lit(0)))),
        "pairs",
    )
    parts = pairs.select("lang", F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("r1"))
    both = pairs.select(
        "lang", "first", F.col("second").alias("last"), F.concat_ws(" ", "first", "second").alias("phrase"), "a", "longer",
        F.lit(None).cast("long").alias("l2"), F.lit(None).cast("long").alias("r1"),
    ).filter(100 * F.col("longer") < subsumed_percent * F.col("a"))
    three = triples.join(parts, ["lang", "second", "third"]).select(
        "lang", "first", F.col("third").alias("last"), F.concat_ws(" ", "first", "second", "third").alias("phrase"), "a",
        F.lit(0).cast("long").alias("longer"), F.col("other").alias("l2"), "r1",
    )
    scored = (
        both.unionByName(three)
        .join(words.select("lang", F.col("word").alias("first"), F.col("n").alias("n_first")), ["lang", "first"])
        .join(words.select("lang", F.col("word").alias("last"), F.col("n").alias("n_last")), ["lang", "last"])
        .withColumn("r1", F.coalesce("r1", "n_last"))
        .withColumn("s1", _score("a", "n_first", "r1"))
        .withColumn("s2", F.when(F.col("l2").isNotNull(), _score("a", "l2", "n_last")))
        .withColumn("later", F.coalesce(F.col("s2") < F.col("s1"), F.lit(False)))
        .select(
            "lang", "phrase", "a",
            F.when(F.col("later"), F.col("l2")).otherwise(F.col("n_first")).alias("l"),
            F.when(F.col("later"), F.col("n_last")).otherwise(F.col("r1")).alias("r"),
            F.when(F.col("later"), F.col("s2")).otherwise(F.col("s1")).alias("score"),
        )
    )
    n = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    return _first(scored, top).join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _score(a: str, left: str, right: str) -> Column:
    """``floor(1000000 a a / (left right))``, exact in 38 digits."""
    wide = "CAST({} AS DECIMAL(13, 0))"
    product = f"{wide.format(a)} * {wide.format(a)} * 1000000BD"
    return F.expr(f"({product}) div ({wide.format(left)} * {wide.format(right)})")


def _first(scored: DataFrame, top: int) -> DataFrame:
    """Ranks within the language; its rows are first thinned out in 4,096 and then 64 groups by hash."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for groups in (4096, 64):
        few = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(groups))).orderBy(*order)
        scored = scored.withColumn("rank", F.row_number().over(few)).filter(F.col("rank") <= top).drop("rank")
    last = Window.partitionBy("lang").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(last).cast("long")).filter(F.col("rank") <= top)


class _Words:
    """Words of several texts: their code in ``names`` in order, the text and the piece each is in."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join(texts).translate(_FOLD), np.uint8)
        blank = (data == 32) | (data == 10)
        held = np.concatenate([[False], ~blank, [False]])
        starts = np.flatnonzero(held[1:-1] & ~held[:-2])
        ends = np.flatnonzero(held[1:-1] & ~held[2:]) + 1
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        chars = pa.py_buffer(data[~blank].tobytes())
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), chars).dictionary_encode()
        self.names, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")
        self.piece = np.cumsum(data == 10)[starts]


def _flushes(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts of about ``BYTES`` bytes together, and their languages."""
    texts, langs, size = [], [], 0
    for text, lang in zip(batch["text"].cast(pa.binary()), batch["lang"]):
        texts.append(text.as_py())
        langs.append(lang.as_py())
        size += len(texts[-1])
        if size >= BYTES:
            yield texts, langs
            texts, langs, size = [], [], 0
    if texts:
        yield texts, langs


def _parts(rows: DataFrame) -> dict[str, int]:
    """Words that make up more than ``SHARE`` of all, of any language, and the number of parts of their stripes."""

    def counted(batch: pa.RecordBatch) -> Iterator[tuple[list[str], list[int]]]:
        for texts, _ in _flushes(batch):
            words = _Words(texts)
            times = np.bincount(words.code, minlength=len(words.names))
            yield ["", *words.names.to_pylist()], [int(times.sum()), *times.tolist()]

    found = heavy_hitters(rows, counted)
    total = found.pop("", 0)
    return {word: int(n / (SHARE * total)) + 1 for word, n in found.items() if n > SHARE * total}


def _mixed(text: pa.Array) -> np.ndarray:
    """A number for each word that is the same in every task."""
    width = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(text.cast(pa.binary()).to_pylist()), np.uint8).astype(np.uint64)
    start = np.cumsum(width) - width
    place = (np.arange(len(data)) - np.repeat(start, width)).astype(np.uint64)
    mixed = (data + np.uint64(1) + place * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xFF51AFD7ED558CCD)
    return np.add.reduceat(mixed ^ (mixed >> np.uint64(31)), start) >> np.uint64(20) if len(start) else start.astype(np.uint64)


def _joined(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """Consecutive values, ``sizes`` at a time, joined by spaces."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values.cast(pa.string())), " ")


def _stripes(parts: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, langs in _flushes(batch):
                yield _striped(_Words(texts), langs, parts)

    return run


def _striped(words: _Words, langs: list[str], parts: dict[str, int]) -> pa.RecordBatch:
    """The stripes of several texts."""
    lang = pa.array(langs, pa.string()).dictionary_encode()
    size = len(words.code)
    if not size:
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in _STRIPE_TYPES], names=_STRIPE_NAMES)
    own, first = np.unique(lang.indices.to_numpy()[words.text] * np.int64(len(words.names)) + words.code, return_inverse=True)
    total = np.bincount(first)
    code = own % len(words.names)
    split = np.array([parts.get(w, 1) for w in words.names.to_pylist()], np.int64)
    part_of = (_mixed(words.names) % np.uint64(1 << 40)).astype(np.int64)
    follows = words.piece[1:] == words.piece[:-1]
    at = np.flatnonzero(follows)
    part = part_of[words.code[at + 1]] % split[words.code[at]]
    # A pair's code sorts by the first word, its part and the next word.
    most = int(split.max())
    pair, place = np.unique((first[at] * most + part) * len(own) + first[at + 1], return_inverse=True)
    n_pair = np.bincount(place, minlength=len(pair))
    number = np.full(size, -1)
    number[at] = place
    at = np.flatnonzero(follows[1:] & follows[:-1])
    triple, n_triple = np.unique(number[at] * len(own) + first[at + 2], return_counts=True)
    # Every word has a row, and one more for each further part of its stripe.
    stripe = np.union1d(np.arange(len(own)) * most, pair // len(own))
    word, part = stripe // most, stripe % most
    n_next = np.bincount(np.searchsorted(stripe, pair // len(own)), minlength=len(stripe))
    fan = np.bincount(triple // len(own), minlength=len(pair))
    until, end = np.concatenate([[0], np.cumsum(fan)]), np.cumsum(n_next)
    n_third = until[end] - until[end - n_next]
    names = words.names.take(pa.array(code))
    columns = [
        lang.dictionary.take(pa.array(own[word] // len(words.names))),
        names.take(pa.array(word)),
        pa.array(part, pa.int32()),
        pa.array(np.where(part == 0, total[word], 0), pa.int64()),
        _joined(names.take(pa.array(pair % len(own))), n_next),
        _joined(pa.array(n_pair), n_next),
        _joined(pa.array(fan), n_next),
        _joined(names.take(pa.array(triple % len(own))), n_third),
        _joined(pa.array(n_triple), n_third),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_STRIPE_NAMES)


def _listed(joined: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values that were joined, and the row each is from."""
    parts = pc.split_pattern(joined, " ")
    parts = pc.if_else(pc.equal(pc.utf8_length(joined), 0), pa.scalar([], pa.list_(pa.string())), parts)
    return pc.list_flatten(parts), pc.list_parent_indices(parts).to_numpy().astype(np.int64)


def _merged(min_count: int):
    """Merges the stripes of sorted rows, some whole keys at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, 8 * ENTRIES
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                rows = batch.slice(start, 1024)
                held.append(rows)
                size += rows.nbytes
                if size >= limit:
                    table = pa.Table.from_batches(held).combine_chunks()
                    key = _keys(table)
                    done = int(np.flatnonzero(key == key[-1])[0])
                    if done:
                        yield _evaluated(table.slice(0, done), key[:done], min_count)
                    held = [_together(table.slice(done))]
                    size = held[0].nbytes
                    limit = max(8 * ENTRIES, 2 * size)
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield _evaluated(table, _keys(table), min_count)

    return run


def _keys(rows: pa.Table) -> np.ndarray:
    """Numbers of the rows' keys, in order."""
    columns = [rows[name].combine_chunks() for name in ("lang", "word", "part")]
    new = [pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in columns]
    return np.concatenate([[0], np.cumsum(reduce(np.logical_or, new))])


class _Counts:
    """Pairs and triples of some stripes, summed up."""

    def __init__(self, rows: pa.Table, key: np.ndarray) -> None:
        second, row = _listed(rows["next"].combine_chunks())
        n_second = _listed(rows["n_next"].combine_chunks())[0].cast(pa.int64()).to_numpy()
        fan = _listed(rows["fan"].combine_chunks())[0].cast(pa.int64()).to_numpy()
        third = _listed(rows["third"].combine_chunks())[0]
        n_third = _listed(rows["n_third"].combine_chunks())[0].cast(pa.int64()).to_numpy()
        coded = pa.chunked_array([second, third]).combine_chunks().dictionary_encode()
        self.names = coded.dictionary
        code = coded.indices.to_numpy().astype(np.int64)
        width = max(len(self.names), 1)
        pair, place = np.unique(key[row] * width + code[: len(second)], return_inverse=True)
        self.n_pair = _sums(place, n_second, len(pair))
        self.pair_key, self.second = pair // width, pair % width
        triple, where = np.unique(np.repeat(place, fan) * width + code[len(second) :], return_inverse=True)
        self.n_triple = _sums(where, n_third, len(triple))
        self.pair_of, self.third = triple // width, triple % width


def _sums(place: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Integer sums by place."""
    sums = np.zeros(size, np.int64)
    np.add.at(sums, place, values)
    return sums


def _together(rows: pa.Table) -> pa.RecordBatch:
    """The rows of one key as one row."""
    found = _Counts(rows, np.zeros(rows.num_rows, np.int64))
    fan = np.bincount(found.pair_of, minlength=len(found.n_pair))
    whole = lambda values, n: _joined(values, np.array([n]))
    columns = [
        *(rows[name].combine_chunks().slice(0, 1) for name in ("lang", "word", "part")),
        pa.array([pc.sum(rows["total"]).as_py()], pa.int64()),
        whole(found.names.take(pa.array(found.second)), len(found.second)),
        whole(pa.array(found.n_pair), len(found.second)),
        whole(pa.array(fan), len(found.second)),
        whole(found.names.take(pa.array(found.third)), len(found.third)),
        whole(pa.array(found.n_triple), len(found.third)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_STRIPE_NAMES)


def _evaluated(rows: pa.Table, key: np.ndarray, min_count: int) -> pa.RecordBatch:
    """Totals of all words, and pairs and triples that occur often enough."""
    start = np.flatnonzero(np.diff(key, prepend=-1))
    lang, word = (rows[name].combine_chunks().take(pa.array(start)) for name in ("lang", "word"))
    total = np.add.reduceat(rows["total"].to_numpy(), start)
    found = _Counts(rows, key)
    pair = np.flatnonzero(found.n_pair >= min_count)
    triple = np.flatnonzero(found.n_triple >= min_count)
    longest = np.zeros(len(found.n_pair), np.int64)
    np.maximum.at(longest, found.pair_of[triple], found.n_triple[triple])
    owner = found.pair_of[triple]
    keys = pa.array(np.concatenate([np.arange(len(start)), found.pair_key[pair], found.pair_key[owner]]))
    none = np.full(len(start), -1)
    no_third = np.full(len(start) + len(pair), -1)
    second = np.concatenate([none, found.second[pair], found.second[owner]])
    third = np.concatenate([no_third, found.third[triple]])
    columns = [
        lang.take(keys),
        word.take(keys),
        found.names.take(pa.array(second, mask=second < 0)),
        found.names.take(pa.array(third, mask=third < 0)),
        pa.array(np.concatenate([total, found.n_pair[pair], found.n_triple[triple]]), pa.int64()),
        pa.array(np.concatenate([none * 0, longest[pair], found.n_pair[owner]]), pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_FOUND_NAMES)


CHECK = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, words
  FROM (
    SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \t]+') IF w <> ''] AS words
    FROM (
      SELECT lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents))
  WHERE len(words) > 0),
pl AS (
  SELECT lang, piece, unnest(words) AS w1, unnest(range(1, len(words) + 1)) AS pos FROM pieces),
ahead AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM pl WINDOW p AS (PARTITION BY piece ORDER BY pos)),
f1 AS (SELECT lang, w1, count(*) AS f FROM ahead GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL),
c2 AS (SELECT * FROM f2 WHERE f >= 10),
c3 AS (SELECT * FROM f3 WHERE f >= 10),
inside AS (
  SELECT lang, w1, w2, max(f) AS longer FROM (
    SELECT lang, w1, w2, f FROM c3 UNION ALL SELECT lang, w2, w3, f FROM c3) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM c2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  LEFT JOIN inside i ON i.lang = c.lang AND i.w1 = c.w1 AND i.w2 = c.w2
  WHERE 100 * coalesce(i.longer, 0) < 50 * c.f
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
  FROM c3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1
  JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
  FROM c3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
  JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3),
scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
words AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT l.lang, row_number() OVER (PARTITION BY l.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM lowest l JOIN words w ON w.lang = l.lang
QUALIFY rank <= 2000
"""
