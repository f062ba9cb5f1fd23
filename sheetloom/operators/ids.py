"""Ids: dense sequence numbers without a single-task window, and ids that follow from the key (M6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.session import shared_dir
from sheetloom.sources.staging import stage

_POSITION_BITS = 33  # layout of monotonically_increasing_id


def sequence_ids(df: DataFrame, order: list[str], name: str = "id", start: int = 0) -> DataFrame:
    """Number the rows start+1, start+2, ... in the given, unique order.

    Rows are range-partitioned and sorted, then checkpointed so that partition
    and position stay fixed; the rows before a partition follow from one count
    per partition.  Only that table of counts, one row per partition, goes
    through one task.
    """
    shared_dir(df.sparkSession)
    parts = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_pos", _POSITION_BITS))
    )
    counts = parts.groupBy("_part").count()
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset")
    )
    position = F.col("_pos") - F.shiftleft("_part", _POSITION_BITS)
    return parts.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + position + F.lit(start + 1)).alias(name)
    )


#: Bits of hash in an id, and of the place among keys of equal hash.  Below 2**56, so
#: that children can be numbered within a hundred of their parent's id.
HASH_BITS, RANK_BITS = 52, 4


def key_hash(key: list[str], bits: int = HASH_BITS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - bits)


def hash_bucket(key: list[str], buckets: int) -> Column:
    """The bucket of a key; keys of equal hash share it."""
    return F.pmod(key_hash(key), F.lit(buckets)).cast("int")


def hash_slice(key: list[str], buckets: int, slices: int) -> Column:
    """A part of a key's bucket, by bits of its hash that don't tell the bucket; keys of equal hash share it."""
    return F.pmod(F.floor(key_hash(key) / buckets), F.lit(slices)).cast("int")


def hash_id(key: list[str], rank: Column, bits: int = HASH_BITS) -> Column:
    """The id of a key: its hash and, in the last bits, its rank (null: none) among keys of that hash."""
    return F.shiftleft(key_hash(key, bits), RANK_BITS) + F.coalesce(rank, F.lit(0))


def key_collisions(keys: DataFrame, key: list[str], bits: int = HASH_BITS) -> DataFrame:
    """Distinct keys -> those whose hash collides: ``key, id, rank``.

    Collisions are found by a narrow aggregate; they are a side table that is as good as
    empty at 52 bits (some hundred of 10^9 keys), and only its keys are ranked.  More than
    2**4 keys of one hash raise an error.
    """
    hashed = keys.select(*key, key_hash(key, bits).alias("_hash"))
    shared = hashed.groupBy("_hash").count().filter("count > 1").select("_hash")
    rank = F.row_number().over(Window.partitionBy("_hash").orderBy(*key)) - 1
    ranked = stage(hashed.join(shared, "_hash").withColumn("rank", rank), "collisions")
    if not ranked.filter(F.col("rank") >= 1 << RANK_BITS).isEmpty():
        raise ValueError(f"more than {1 << RANK_BITS} keys have one hash of {bits} bits")
    return ranked.select(*key, hash_id(key, F.col("rank"), bits).alias("id"), "rank")


def hash_ids(keys: DataFrame, key: list[str], bits: int = HASH_BITS) -> tuple[DataFrame, DataFrame]:
    """Distinct keys -> ``key, id``, and the keys whose hash collides: ``key, id, rank``.

    An id is the key's hash and, in its last bits, the key's rank among those of equal
    hash, so it depends on the set of keys alone and not on who came first.
    """
    collisions = key_collisions(keys, key, bits)
    ids = keys.join(collisions.select(*key, "rank"), key, "left").select(*key, hash_id(key, F.col("rank"), bits).alias("id"))
    return ids, collisions
