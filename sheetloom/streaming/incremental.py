"""Incremental load: batches of listings merged into stored state (ST1, S12, S13, S15, J3, J9, M5).

The state of an entity lies in the bucket of its key's hash.  A batch reads the buckets
of its own keys, writes them anew under the number of its commit, and is there once the
commit's file is written; that file names the buckets in force, the last id and who
applied which batch, so a replay changes nothing and a reader sees whole batches only.
Position in the files decides which row is the latest, never the time of arrival.
One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sheetloom import vocabulary as V
from sheetloom.operators.ids import hash_bucket, hash_id, hash_slice, key_collisions
from sheetloom.operators.merge import (
    KEPT,
    KEY,
    assign_ids,
    collapse_dated,
    combine,
    existing_keys,
    has_keys,
    load_stats,
    rejected_entities,
    requirement_table,
    tombstones,
    university_table,
)
from sheetloom.operators.regions import join_regions, reference_regions
from sheetloom.session import children, exists, shared_dir
from sheetloom.sources.staging import release, stage

_TYPES = {"min_gpa": "double", "is_exchange": "boolean", "is_visit": "boolean", "has_review": "boolean"}
_LATEST = ",".join(f"{c}:{_TYPES.get(c, 'string')}" for c in KEPT)
_POSITION = "struct<file:string,version:bigint,row_idx:bigint>"
_REFERENCE = "file string, row_idx bigint, nation string, region string, commit bigint"
_STATS = "file string, inserted bigint, updated bigint, skipped bigint, language_reqs bigint, writer string, batch bigint, commit bigint"
_QUARANTINE = "file string, reason string, batch bigint, attempt bigint"
STATE_SCHEMA = (
    f"name_eng string, nation string, first_seen {_POSITION}, last_seen {_POSITION}, latest struct<{_LATEST}>, "
    f"semesters array<struct<semester:string,seen:{_POSITION}>>, removed {_POSITION}, batch bigint, id bigint"
)

#: So many commits are remembered, and known again if their batch comes a second time.
REPLAYED = 1000
#: Parts of a bucket that are merged apart, so that the number of tasks isn't that of the buckets.
SLICES = 16


@dataclass
class Commit:
    """What the file of a commit says."""

    number: int = 0
    last_id: int = 0
    #: Bucket -> number of the commit that wrote its state.
    buckets: dict[str, int] = field(default_factory=dict)
    #: Number of the commit that wrote the files set aside.
    quarantine: int = 0
    writer: str = ""
    batch: int | None = None


class CatalogueStore:
    """The stored state of the two tables under one folder.

    ``buckets`` is set when a store is made and holds for good.  ``ids`` of entities are
    numbers in the order of arrival (``sequence``), or follow from the key alone
    (``hash``: the same whatever arrives first).  Without ``stats`` batches are not counted,
    which spares parsing the requirements of rows that later ones replace.  Every ``compact_every`` commits the
    versions of buckets that two later commits have replaced are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 50, buckets: int = 16, ids: str = "sequence", stats: bool = True):
        if ids not in ("sequence", "hash"):
            raise ValueError(f"ids are given by sequence or hash, not {ids}")
        self.spark, self.compact_every, self.n_buckets, self.ids, self.with_stats = spark, compact_every, buckets, ids, stats
        self.path = path.rstrip("/")
        shared_dir(spark)

    # Generations: S15.

    def _generation(self) -> int:
        """The generation that readers see."""
        return max((int(n) for n in children(self.spark, f"{self.path}/generations", "_SUCCESS") if n.isdigit()), default=0)

    def _folder(self, generation: int | None = None) -> str:
        return f"{self.path}/generation-{self._generation() if generation is None else generation}"

    def _publish(self, generation: int) -> None:
        """Readers see a generation from now on; the one before stays for those that have begun to read it."""
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/generations/{generation}")
        release(self.spark, [self._folder(g) for g in range(max(generation - 5, 0), generation - 1)])

    def reset(self) -> None:
        """Forget everything stored."""
        generation = self._generation() + 1
        release(self.spark, [self._folder(generation)])
        self._publish(generation)

    def refresh(self, entities: DataFrame, reference: DataFrame | None = None, deleted: DataFrame | None = None) -> None:
        """Replace everything by one load.

        It is written beside the tables in force and takes their place at once when it is
        whole; a reader meanwhile, and one that has begun before, sees the state before.
        """
        generation = self._generation() + 1
        release(self.spark, [self._folder(generation)])
        self._apply(self._folder(generation), entities, -1, "refresh", reference, deleted, None, None, None)
        self._publish(generation)

    # Commits.

    def _commits(self, folder: str) -> list[tuple[int, str, int]]:
        """Number, writer and batch of all complete commits."""
        names = children(self.spark, f"{folder}/commits", "_SUCCESS")
        found = (re.fullmatch(r"(\d+)_(.*)_(-?\d+)", n) for n in names)
        return sorted((int(m[1]), m[2], int(m[3])) for m in found if m)

    def _last(self, folder: str) -> Commit:
        commits = self._commits(folder)
        if not commits:
            return Commit()
        number, writer, batch = commits[-1]
        text = self.spark.read.text(f"{folder}/commits/{number:012d}_{writer}_{batch}", wholetext=True).first()[0]
        return Commit(**json.loads(text))

    def _state(self, folder: str, commit: Commit, wanted: list[int] | None = None) -> DataFrame:
        """State records in force, of all or of some buckets; only their folders are read."""
        live = {int(b): c for b, c in commit.buckets.items() if wanted is None or int(b) in wanted}
        if not live:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        number = F.create_map(*[F.lit(x) for pair in live.items() for x in pair])
        records = self.spark.read.schema(f"{STATE_SCHEMA}, commit bigint, bucket int").parquet(f"{folder}/state")
        in_force = F.col("bucket").isin(*live) & (F.try_element_at(number, F.col("bucket")) == F.col("commit"))
        return records.filter(in_force).drop("commit", "bucket")

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of some keys."""
        return sorted(r[0] for r in keys.select(hash_bucket(KEY, self.n_buckets).alias("b")).distinct().collect())

    def stored(self, keys: DataFrame) -> DataFrame:
        """State records of the buckets that some keys are in."""
        folder = self._folder()
        return self._state(folder, self._last(folder), self.touched(keys))

    def states(self) -> DataFrame:
        """The entities' merged state records."""
        folder = self._folder()
        return self._listed(self._state(folder, self._last(folder)))

    @staticmethod
    def _listed(states: DataFrame) -> DataFrame:
        """Entities that are there, with their semesters alone."""
        return states.filter(F.col("last_seen").isNotNull()).withColumn("semesters", F.col("semesters.semester"))

    def apply(
        self,
        entities: DataFrame,
        batch: int,
        reference: DataFrame | None = None,
        deleted: DataFrame | None = None,
        versions: DataFrame | None = None,
        files: DataFrame | None = None,
        bad_files: DataFrame | None = None,
        writer: str = "",
    ) -> DataFrame:
        """Merge one batch of derived listing rows and give its statistics (M5).

        ``reference``: the rows of its reference file.  ``deleted``: ``name_eng, nation,
        file, row_idx`` (and ``version``) of entities that go, with their children, until
        a later row brings them back.  ``versions``: ``file, version``; rows of a later
        version of a file come after all those of an earlier one.  ``bad_files``:
        ``file, reason`` of files set aside; a file of ``files``, all that the batch has,
        is taken out again once it is read.  A batch that ``writer`` has applied before
        changes nothing.
        """
        return self._apply(self._folder(), entities, batch, writer, reference, deleted, versions, files, bad_files)

    def _apply(
        self,
        folder: str,
        entities: DataFrame,
        batch: int,
        writer: str,
        reference: DataFrame | None,
        deleted: DataFrame | None,
        versions: DataFrame | None,
        files: DataFrame | None,
        bad_files: DataFrame | None,
    ) -> DataFrame:
        if not re.fullmatch(r"[\w.-]*", writer):
            raise ValueError(f"a writer is named by letters, digits, dots and dashes, not {writer!r}")
        done = {(w, b): n for n, w, b in self._commits(folder)}
        if (writer, batch) in done:
            return self._stats(folder).filter(F.col("commit") == done[writer, batch])
        last = self._last(folder)
        commit = Commit(last.number + 1, last.last_id, dict(last.buckets), last.quarantine, writer, batch)
        if reference is not None and not reference.isEmpty():
            reference.write.mode("overwrite").parquet(f"{folder}/reference/commit={commit.number}")
        if "region_key" not in entities.columns:
            entities = entities.withColumn("region_key", F.lit(None).cast("string"))
        if versions is not None:
            entities = entities.join(versions, "file", "left")
        elif "version" not in entities.columns:
            entities = entities.withColumn("version", F.lit(0))
        entities = entities.withColumn("version", F.coalesce(F.col("version").cast("long"), F.lit(0)))
        if self.with_stats:
            entities = stage(entities, "entities")
        fresh = collapse_dated(entities.filter(has_keys()))
        if deleted is not None:
            fresh = combine(fresh.unionByName(tombstones(deleted), allowMissingColumns=True), drop_removed=False)
        fresh = stage(fresh.withColumn("batch", F.lit(commit.number).cast("long")), "batch")
        wanted = self.touched(fresh)
        stored = self._state(folder, last, wanted)
        if wanted:
            self._write(folder, commit, fresh, stored, wanted)
        if self.with_stats:
            stats = load_stats(entities, stored.filter(F.col("last_seen").isNotNull()))
            stats = stats.select("*", F.lit(writer).alias("writer"), F.lit(batch).cast("long").alias("batch"))
            stats.coalesce(1).write.mode("overwrite").parquet(f"{folder}/stats/commit={commit.number}")
        if bad_files is not None:
            self._set_aside(folder, commit, files, bad_files)
        text = self.spark.createDataFrame([(json.dumps(asdict(commit)),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{folder}/commits/{commit.number:012d}_{writer}_{batch}")
        if commit.number % self.compact_every == 0:
            self._sweep(folder)
        return self._stats(folder).filter(F.col("commit") == commit.number)

    def _write(self, folder: str, commit: Commit, fresh: DataFrame, stored: DataFrame, wanted: list[int]) -> None:
        """The touched buckets with a batch in them."""
        spread = {"bucket": hash_bucket(KEY, self.n_buckets), "slice": hash_slice(KEY, self.n_buckets, SLICES)}
        both, collisions = stored.unionByName(fresh, allowMissingColumns=True), None
        if self.ids == "hash":
            known = stored.select(*KEY).unionByName(fresh.select(*KEY)).distinct()
            collisions = key_collisions(known, KEY)
            collisions.write.mode("overwrite").parquet(f"{folder}/collisions/commit={commit.number}")
            both = both.drop("id")
        else:
            known = existing_keys(stored.filter(F.col("id").isNotNull()), fresh)
            arrived = fresh.filter("first_seen IS NOT NULL").join(known, KEY, "left_anti").select(*KEY, "first_seen")
            ids = stage(assign_ids(arrived, commit.last_id).select(*KEY, "id"), "new_ids")
            commit.last_id = ids.agg(F.max("id")).first()[0] or commit.last_id
            # A new id is a record that has nothing else; it meets its key's others in the merge.
            both = both.unionByName(ids, allowMissingColumns=True)
        # Shuffled nearly as they are written, records of a key need no other exchange to
        # meet; a bucket is many tasks.
        both = both.withColumns(spread).repartition(*spread)
        merged = combine(both, key=[*spread, *KEY]).drop("slice")
        if collisions is not None:
            ranks = collisions.select(*KEY, "rank")
            merged = merged.join(ranks, KEY, "left").withColumn("id", hash_id(KEY, F.col("rank"))).drop("rank")
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/state/commit={commit.number}")
        commit.buckets |= {str(b): commit.number for b in wanted}

    def compact(self, upto: int | None = None) -> None:
        """Delete the versions of buckets that two later commits have replaced."""
        self._sweep(self._folder())

    def _sweep(self, folder: str) -> None:
        """One version before the one in force stays, for readers that have begun with it."""
        live = self._last(folder)
        versions: dict[str, list[int]] = {}
        for name in children(self.spark, f"{folder}/state"):
            number = int(name.removeprefix("commit=")) if name.startswith("commit=") else live.number + 1
            if number <= live.number:
                for bucket in children(self.spark, f"{folder}/state/{name}"):
                    versions.setdefault(bucket, []).append(number)
        gone = [f"{folder}/state/commit={n}/{b}" for b, numbers in versions.items() for n in sorted(numbers)[:-2]]
        release(self.spark, [g for g in gone if "/bucket=" in g])
        old = [f"{number:012d}_{writer}_{batch}" for number, writer, batch in self._commits(folder)][:-REPLAYED]
        release(self.spark, [f"{folder}/commits/{name}" for name in old])

    # Files set aside: S13.

    def _set_aside(self, folder: str, commit: Commit, files: DataFrame | None, bad_files: DataFrame) -> None:
        """What was set aside before and isn't in this batch stays; a file that fails again has one attempt more."""
        before = self._quarantine(folder, commit)
        held = before if files is None else before.join(files.select("file"), "file", "left_anti")
        again = before.select("file", F.col("attempt").alias("before"))
        failed = bad_files.groupBy("file").agg(F.min("reason").alias("reason")).join(again, "file", "left")
        failed = failed.select(
            "file", "reason", F.lit(commit.batch).cast("long").alias("batch"), (F.coalesce("before", F.lit(0)) + 1).alias("attempt")
        )
        held = held.join(failed, "file", "left_anti")
        held.unionByName(failed).coalesce(1).write.mode("overwrite").parquet(f"{folder}/quarantine/commit={commit.number}")
        commit.quarantine = commit.number

    def _quarantine(self, folder: str, commit: Commit) -> DataFrame:
        if not commit.quarantine:
            return self.spark.createDataFrame([], _QUARANTINE)
        return self.spark.read.schema(_QUARANTINE).parquet(f"{folder}/quarantine/commit={commit.quarantine}")

    def quarantine(self) -> DataFrame:
        """``file, reason, batch, attempt`` of the files whose last version could not be read."""
        folder = self._folder()
        return self._quarantine(folder, self._last(folder))

    # Readers.

    def _committed(self, folder: str, name: str, schema: str) -> DataFrame | None:
        """Rows that were written beside the commits so far."""
        if not exists(self.spark, f"{folder}/{name}"):
            return None
        rows = self.spark.read.schema(schema).parquet(f"{folder}/{name}")
        return rows.filter(F.col("commit") <= self._last(folder).number)

    def _stats(self, folder: str) -> DataFrame:
        found = self._committed(folder, "stats", _STATS)
        return self.spark.createDataFrame([], _STATS) if found is None else found

    def stats(self) -> DataFrame:
        """M5: ``file, inserted, updated, skipped, language_reqs, writer, batch`` of all batches."""
        return self._stats(self._folder()).drop("commit")

    def _regions(self) -> DataFrame | None:
        """Nation -> region of the last reference file of all batches."""
        rows = self._committed(self._folder(), "reference", _REFERENCE)
        if rows is None:
            return None
        last = rows.filter(F.col("file") == rows.agg(F.max("file")).scalar())
        newest = last.filter(F.col("commit") == last.agg(F.max("commit")).scalar())
        return reference_regions(newest)

    def university(self) -> DataFrame:
        """The entity table; regions that depend on a reference file follow the last one stored."""
        table, regions = university_table(self.states(), keep=("region_key",)), self._regions()
        if regions is not None:
            found = join_regions(table, regions, F.col("region_key"))
            looked_up = F.coalesce("_region", F.lit(V.UNKNOWN))
            region = F.when(F.col("region_key").isNull(), F.col("region")).otherwise(looked_up)
            table = found.withColumn("region", region).drop("_region")
        return table.drop("region_key")

    def rejected(self) -> DataFrame:
        return rejected_entities(self.states())

    def language_requirement(self) -> DataFrame:
        return requirement_table(self.university())


def start_incremental(
    stream: DataFrame,
    derive: Callable[[DataFrame], DataFrame],
    store: CatalogueStore,
    checkpoint: str,
) -> StreamingQuery:
    """ST1: every micro-batch of listing rows is derived and merged.

    Runs through what has arrived and stops; the checkpoint remembers it.
    """

    def merge(df: DataFrame, batch: int) -> None:
        # A file may be one row group, which one task reads.
        dealt = df.repartition("file", "row_idx") if {"file", "row_idx"} <= set(df.columns) else df
        store.apply(derive(dealt), batch, writer=stream_id(df.sparkSession))

    return start_merging(stream, merge, checkpoint)


def stream_id(spark: SparkSession) -> str:
    """The id of the stream whose batch is being worked on; it lives as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def start_merging(
    stream: DataFrame, merge: Callable[[DataFrame, int], object], checkpoint: str, continuous: bool = False
) -> StreamingQuery:
    """Runs through what has arrived and stops, or goes on until it is stopped."""
    trigger = {"processingTime": "0 seconds"} if continuous else {"availableNow": True}
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**trigger).start()
