"""Frequent items of a whole table in bounded summaries, without a shuffle by item."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "items array<string>, counts array<long>"

#: Items that a summary holds at most once it is cut.
KEPT = 1 << 14
#: Summaries that a task of the tree merges, about.
FAN = 32


class Summary:
    """Misra-Gries counters: an item's count is short by at most a ``KEPT``-th of all that was added."""

    def __init__(self, kept: int = KEPT) -> None:
        self.kept, self.counts = kept, {}

    def add(self, items: Iterable[str], counts: Iterable[int]) -> None:
        held = self.counts
        for item, n in zip(items, counts):
            held[item] = held.get(item, 0) + n
        if len(held) > 8 * self.kept:
            self.cut()

    def cut(self) -> None:
        """The largest stay, less the largest count that goes; equal counts go together."""
        if len(self.counts) > self.kept:
            line = sorted(self.counts.values(), reverse=True)[self.kept]
            self.counts = {item: n - line for item, n in self.counts.items() if n > line}

    def batch(self) -> pa.RecordBatch:
        self.cut()
        columns = [pa.array([list(self.counts)], pa.list_(pa.string())), pa.array([list(self.counts.values())], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["items", "counts"])


def heavy_hitters(
    rows: DataFrame, counted: Callable[[pa.RecordBatch], Iterator[tuple[list[str], list[int]]]], kept: int = KEPT
) -> dict[str, int]:
    """The most frequent items of all rows and counts that are short by a bounded part.

    ``counted`` gives the items of a batch with their counts in it.  Every task sums
    its rows up in a summary of at most ``kept`` items; summaries are merged in a tree,
    by as many tasks as the session shuffles to, then by some, then by one, so what the
    driver and any task hold does not grow with the table.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(kept)
        for batch in batches:
            for items, counts in counted(batch):
                summary.add(items, counts)
        yield summary.batch()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(kept)
        for batch in batches:
            for items, counts in zip(batch["items"], batch["counts"]):
                summary.add(items.as_py(), counts.as_py())
        yield summary.batch()

    width, tree = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.mapInArrow(summed, SCHEMA)
    while width > 1:
        tree = tree.repartition(width).mapInArrow(merged, SCHEMA)
        width //= FAN
    found = tree.repartition(1).mapInArrow(merged, SCHEMA).collect()
    return {item: n for r in found for item, n in zip(r["items"], r["counts"])}
