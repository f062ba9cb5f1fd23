"""SimHash near-duplicates by anchor-point covering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sheetloom.llm.components import connected_components
from sheetloom.sources.staging import stage

#: The covering code: the 64 bits hold two blocks of 31, and the anchors of a block
#: are the words of the Hamming code [31, 26], whose covering radius is 1.
BLOCK, RADIUS, THRESHOLD = 31, 1, 3
#: Two fingerprints that differ in 3 bits differ in at most 1 bit of one block.
BLOCK_THRESHOLD = THRESHOLD // 2
#: Home fingerprints of one anchor that are compared in one task; more are split.
HOMES = 2000


def _fingerprint(text: bytes, width: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    h = np.fromiter(map(_hash, shingles), np.uint64)
    parts = h.view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(parts), 4096):
        ones += np.unpackbits(parts[i : i + 4096], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def _hash(shingle: bytes) -> int:
    return xxhash.xxh64_intdigest(shingle, 42)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, with_rows: bool = False
) -> DataFrame:
    """``id, fp`` (a long), with ``with_rows`` also the whole input row as a struct ``row``: A-Z in lower case, words, shingles with repeats, XXH64 with seed 42;
    a bit is set that is set in over half the hashes.  No words: zero."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        *([F.struct(*docs.columns).alias("row")] if with_rows else []),
    )
    fields = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprint((t.as_py() or "").encode(), width) for t in batch["text"]]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            kept = [batch[f.name] for f in fields]
            yield pa.RecordBatch.from_arrays([*kept, fp], names=[*(f.name for f in fields), "fp"])

    return rows.mapInArrow(run, StructType([*fields, StructField("fp", LongType())]))


def _syndrome(block: np.ndarray) -> np.ndarray:
    s = np.zeros(len(block), np.int64)
    for i in range(BLOCK):
        s ^= ((block >> i) & 1) * (i + 1)
    return s


def _anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the anchor's key, plus one where the fingerprint is no home of it; and the fingerprints.

    Home is the anchor within the covering radius.  Anchors within radius plus block
    threshold are it and, unless the block is a code word itself, the 15 words that
    two flips reach: positions whose numbers have the syndrome as their exclusive or.
    """
    keys, values = [], []
    for b in range(2):
        block = (fp >> (BLOCK * b)) & ((1 << BLOCK) - 1)
        s = _syndrome(block)
        home = block ^ np.where(s > 0, 1 << np.maximum(s - 1, 0), 0)
        base = b << BLOCK
        keys.append((base | home) << 1)
        values.append(fp)
        inner = np.flatnonzero(s)
        for i in range(1, BLOCK + 1):
            j = s[inner] ^ i
            pick = inner[j > i]
            j = s[pick] ^ i
            keys.append(((base | (block[pick] ^ (1 << (i - 1)) ^ (1 << (j - 1)))) << 1) | 1)
            values.append(fp[pick])
    return np.concatenate(keys), np.concatenate(values)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, fp = _anchors(batch["fp"].to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])


class _Anchor:
    """Compares one anchor's fingerprints: homes first, then the others in pieces."""

    def __init__(self) -> None:
        self.key, self.homes = None, []

    def links(self, homes: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(others), 1024):
            part = others[i : i + 1024]
            near = np.bitwise_count(homes[:, None] ^ part[None, :]) <= THRESHOLD
            a, b = np.nonzero(near)
            yield forest(homes[a], part[b])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the given links connect, fewer than there are nodes."""
    if not len(a):
        return a, b
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[member]], nodes[member]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by key, homes first in each anchor -> links."""
    anchor = _Anchor()
    for batch in batches:
        key, fp = batch["key"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)
        at, outer = key >> 1, key & 1
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        ends = np.r_[starts[1:], len(at)]
        out_a, out_b = [], []
        # Groups that lie within the batch and are small: compare neighbours at every distance.
        size = ends - starts
        inside = (starts > 0) & (ends < len(at)) & (size > 1) & (size <= 64) & (outer[starts] == 0)
        row_size = np.repeat(np.where(inside, ends, 0), size)
        rows = np.flatnonzero((row_size > 0) & (outer == 0))
        step = 1
        while len(rows):
            rows = rows[rows + step < row_size[rows]]
            near = np.bitwise_count(fp[rows] ^ fp[rows + step]) <= THRESHOLD
            out_a.append(fp[rows[near]])
            out_b.append(fp[rows[near] + step])
            step += 1
        edge = (starts == 0) | (ends == len(at))
        for g in np.flatnonzero(edge | ((size > 64) & (outer[starts] == 0))):
            lo, hi = starts[g], ends[g]
            if anchor.key != at[lo]:
                anchor.key, anchor.homes = at[lo], []
            home = fp[lo:hi][outer[lo:hi] == 0]
            for old in anchor.homes:
                for a, b in anchor.links(old, fp[lo:hi]):
                    out_a.append(a)
                    out_b.append(b)
            if len(home):
                anchor.homes.append(home)
                for a, b in anchor.links(home, fp[lo:hi]):
                    out_a.append(a)
                    out_b.append(b)
        if out_a:
            a, b = forest(np.concatenate(out_a), np.concatenate(out_b))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """``fp`` (distinct) -> ``a, b``: links that connect all fingerprints at 3 or fewer differing bits.

    Each fingerprint is at home at one anchor a block and replicated to every anchor
    within covering radius plus threshold, so that a linked pair meets at the home of
    either.  Per anchor homes are compared with all; what comes out is a forest, not
    all pairs.  Anchors that are home to more than ``HOMES`` become a grid of cells
    with a share of the homes and a share of the others each.
    """
    spread = distinct.mapInArrow(_replicate, "key long, fp long")
    homes = spread.filter(F.col("key").bitwiseAND(F.lit(1)) == 0)
    hot = stage(
        homes.groupBy("key").count().filter(F.col("count") > HOMES).select(
            F.shiftright("key", 1).alias("hot"), F.ceil(F.col("count") / HOMES).cast("int").alias("n")
        ),
        "hot_anchors",
    )
    cells = spread.withColumn("cell", F.lit(0))
    if not hot.isEmpty():
        share = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
        every = F.sequence(F.lit(0), F.col("n") - 1)
        home = F.col("key").bitwiseAND(F.lit(1)) == 0
        # A home goes to the cells of its row, everything (homes too) to those of its column.
        row = F.transform(every, lambda c: share * F.col("n") + c)
        column = F.transform(every, lambda r: r * F.col("n") + share)
        cells = spread.join(hot, F.shiftright("key", 1) == F.col("hot"), "left")
        as_home = cells.filter(home).select("key", "fp", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(row)).alias("cell"))
        as_other = cells.filter(~home | F.col("n").isNotNull()).select(
            F.col("key").bitwiseOR(F.when(F.col("n").isNull(), F.col("key").bitwiseAND(F.lit(1))).otherwise(F.lit(1))).alias("key"),
            "fp",
            F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(column)).alias("cell"),
        )
        cells = as_home.unionByName(as_other)
    # A cell is an anchor of its own for the comparison: sort by cell within the key.
    return (
        cells.repartition(F.shiftright("key", 1), "cell")
        .sortWithinPartitions("cell", "key")
        .select("key", "fp")
        .mapInArrow(_compare, "a long, b long")
    )


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """A row per input row: ``id_col, fingerprint, component_id``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest id
    reachable over links of 3 or fewer differing bits.

    Null and empty texts have fingerprint zero and are linked like any other.  Null
    ids never are a component's smallest id unless it has no other.  Rows that repeat
    are copies.  Extra columns are ignored; an empty table gives an empty result.
    """
    prints = stage(fingerprints(docs, id_col, text_col, width), "fingerprints")
    rooted = _rooted(prints)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = stage(rooted.join(smallest, "root").select(F.col("fp").alias("class"), "component_id"), "members")
    return prints.join(member, prints["fp"] == member["class"]).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted(prints: DataFrame) -> DataFrame:
    """``fp, first_id, root``: the distinct fingerprints, their smallest id and their component."""
    classes = stage(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "classes")
    roots = stage(connected_components(fingerprint_links(classes.select("fp"))), "roots")
    return stage(
        classes.join(roots, classes["fp"] == roots["node"], "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    A component of null ids keeps one of its rows.  Components are settled on
    distinct fingerprints; whole rows are shuffled once, by id and fingerprint, so
    that a large group of copies doesn't meet in one task.
    """
    prints = stage(fingerprints(docs, id_col, text_col, width, with_rows=True), "fingerprints")
    keepers = (
        _rooted(prints.select("id", "fp"))
        .groupBy("root")
        .agg(F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "fp")).alias("keep"))
        .select(F.struct("keep.first_id", "keep.fp").alias("keeper"))
    )
    one = F.row_number().over(Window.partitionBy("keeper").orderBy("keeper"))
    return (
        prints.select(F.struct(F.col("id").alias("first_id"), "fp").alias("keeper"), "row")
        .join(stage(keepers, "keepers"), "keeper", "left_semi")
        .withColumn("turn", one)
        .filter("turn = 1")
        .select("row.*")
    )
