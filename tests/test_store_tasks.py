"""The merge of a store is many tasks, however few its buckets."""

import pytest
from pyspark.sql import functions as F

from sheetloom.operators import merge as M
from sheetloom.operators.ids import hash_bucket, hash_slice
from sheetloom.session import children
from sheetloom.streaming.incremental import CatalogueStore


def _entities(spark, n, first=0):
    numbered = spark.range(first, first + n).select(
        F.lit("2024-1 a.xlsx").alias("file"), F.col("id").alias("row_idx"), F.lit("k").alias("name_kor"),
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("name_eng"), F.lit("x").alias("nation"), F.lit("2024-1").alias("semester"),
    )
    typed = {"min_gpa": "double", "is_exchange": "boolean", "is_visit": "boolean", "has_review": "boolean"}
    others = [c for c in M.KEPT if c not in numbered.columns]
    return numbered.select("*", *[F.lit(None).cast(typed.get(c, "string")).alias(c) for c in others])


@pytest.mark.parametrize("ids", ["sequence", "hash"])
def test_a_bucket_is_many_tasks(spark, tmp_path, ids):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        store = CatalogueStore(spark, str(tmp_path / "store"), buckets=1, ids=ids, stats=False)
        store.apply(_entities(spark, 300), 0)
        store.apply(_entities(spark, 300, 200), 1)
    finally:
        spark.conf.set(name, "true")
    files = children(spark, str(tmp_path / "store/generation-0/state/commit=2/bucket=0"))
    assert sum(f.endswith(".parquet") for f in files) > 2
    rows = store.university().select("id", "name_eng").collect()
    assert len({r.id for r in rows}) == len({r.name_eng for r in rows}) == len(rows) == 500
    if ids == "sequence":
        assert {r.id for r in rows} == set(range(1, 501))


def test_slices_split_each_bucket(spark):
    keys = _entities(spark, 2000).select(hash_bucket(M.KEY, 4).alias("b"), hash_slice(M.KEY, 4, 8).alias("s"))
    assert {(r.b, r.s) for r in keys.distinct().collect()} == {(b, s) for b in range(4) for s in range(8)}
