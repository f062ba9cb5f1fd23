"""Merkle manifest of a dataset as a postorder append log, with a proof for every row.

The tree over n leaves has an aligned shape: node ``i`` of level ``h`` stands over the
leaves from ``i * 2**h`` up to ``(i + 1) * 2**h`` or the end, and is the digest of its
one or two children.  Nodes are appended when they are complete, so the nodes of an
aligned run of leaves lie together, and the place of every node follows from the sizes
of the subtrees before it.  Builders own aligned runs of ``2**BITS`` nodes: a builder
reads its run in order, keeps one open node for each level, and writes a tile of the
log.  The tiles' last nodes are the input of the next round of builders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheetloom.sources.staging import stage

#: Levels of the tree in one tile.
BITS = 8
SIZE = 32

TILE = "key string, tile long, n long, total long, nodes binary"
PATH = "key string, at long, path binary, subroot binary"
_PART_BITS = 33  # layout of monotonically_increasing_id


def appended(leaves: int) -> int:
    """Nodes that are complete once so many leaves of a larger tree are appended."""
    return 2 * leaves - leaves.bit_count()


def position(level: int, index: int, leaves: int) -> int:
    """The place of a node in the log of a tree of so many leaves.

    A node follows the last leaf under it, after the nodes below it that this leaf
    completes; what precedes that leaf are the complete subtrees before it.
    """
    last = min((index + 1) << level, leaves) - 1
    return appended(last) + level


def height(leaves: int) -> int:
    return (leaves - 1).bit_length()


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


class Builder:
    """Appends leaves and every node that they complete."""

    def __init__(self, leaves: int, levels: int) -> None:
        self.leaves, self.levels, self.seen = leaves, levels, 0
        self.log: list[bytes] = []
        self._open: list[bytes | None] = [None] * (levels + 1)

    def append(self, node: bytes) -> None:
        self.log.append(node)
        index, last = self.seen, self.seen + 1 == self.leaves
        self.seen += 1
        for level in range(self.levels):
            if index & 1:
                node = digest(self._open[level], node)
            elif last:
                node = digest(node)
            else:
                self._open[level] = node
                return
            self.log.append(node)
            index >>= 1


def siblings(log: bytes, index: int, leaves: int, levels: int) -> Iterator[tuple[int, bytes]]:
    """Level by level the other node of the run: -1 if left of the path, 1 if right, 0 if there is none."""
    for level in range(levels):
        other, size = index ^ 1, -(-leaves >> level)
        if other < size:
            at = position(level, other, leaves) * SIZE
            yield (-1 if other < index else 1), log[at : at + SIZE]
        else:
            yield 0, b""
        index >>= 1


def packed(steps: Iterator[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side + 1]) + node for side, node in steps)


def unpacked(path: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(path):
        side = path[at] - 1
        yield side, path[at + 1 : at + 1 + SIZE] if side else b""
        at += 1 + (SIZE if side else 0)


def folded(node: bytes, steps: list[tuple[int, bytes]]) -> bytes:
    """The root that a node and its siblings give."""
    for side, other in steps:
        node = digest(other, node) if side < 0 else digest(node, other) if side else digest(node)
    return node


def leaf_digest(columns: list[Column]) -> Column:
    """Digest of the columns, each ``-`` if null, else its UTF-8 length, a colon and the value."""
    values = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def place_leaves(leaves: DataFrame) -> tuple[DataFrame, int]:
    """``key, rank, ...`` -> the same rows with ``at``, their place within the key, and ``n``, the key's rows.

    Also gives the number of rows of the largest key.  Rows are ordered by ``key`` and
    ``rank``; they are sorted by range, split within keys of any size and among equal
    ranks, so that no key goes to one task.  The one row per key and partition that the
    offsets need is written, and joined as its real size allows.
    """
    rows = stage(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    order = ["key", "rank", "tie"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie", "rank")
    placed = stage(placed.withColumn("row", F.monotonically_increasing_id()), "placed_leaves")
    placed = placed.withColumn("slice", F.shiftright("row", _PART_BITS))
    slices = placed.groupBy(F.col("key").alias("slice_key"), "slice").agg(F.count("*").alias("rows"), F.min("row").alias("row0"))
    whole = Window.partitionBy("slice_key")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = stage(
        slices.select(
            "slice_key", F.col("slice").alias("slice_no"), "row0",
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(whole).alias("n"),
        ),
        "slices",
    )
    same = (F.col("key") == F.col("slice_key")) & (F.col("slice") == F.col("slice_no"))
    at = (F.col("before") + F.col("row") - F.col("row0")).alias("at")
    kept = [c for c in placed.columns if c not in ("row", "slice")]
    return placed.join(slices, same).select(*kept, at, "n"), slices.agg(F.max("n")).first()[0] or 0


def build_log(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """``key, at, n, node, ...`` -> rounds of tiles ``key, tile, n, total, nodes, ...``, the last with a tile per key.

    ``n`` counts a tile's input and ``total`` that of its key, ``nodes`` is its part of
    the log.  Further columns of the input become arrays of the first round's tiles.
    """
    rounds = []
    while True:
        extra = [c for c in nodes.columns if c not in ("key", "at", "n", "node")]
        kinds = "".join(f", {c} array<{nodes.schema[c].dataType.simpleString()}>" for c in extra)
        runs = nodes.withColumn("tile", F.shiftright("at", BITS)).repartition("key", "tile")
        built = runs.sortWithinPartitions("key", "tile", "at").mapInArrow(_build(extra), TILE + kinds)
        rounds.append(stage(built, "tiles"))
        largest = -(-largest >> BITS)
        if largest <= 1:
            return rounds
        above = F.shiftright(F.col("total") + ((1 << BITS) - 1), BITS)
        nodes = rounds[-1].select("key", F.col("tile").alias("at"), above.alias("n"), top("nodes").alias("node"))


def top(nodes: str) -> Column:
    """A tile's last node."""
    return F.substring(F.col(nodes), -SIZE, SIZE)


def _build(extra: list[str]):
    """Sorted nodes -> tiles, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder, beside = None, []
        for batch in batches:
            done: list[tuple] = []
            rows = zip(*(batch[c].to_pylist() for c in ("key", "tile", "n", "node", *extra)))
            for key, tile, total, node, *others in rows:
                if builder is None:
                    size = min(1 << BITS, total - (tile << BITS))
                    builder, beside = Builder(size, tile_levels(total)), [[] for _ in extra]
                builder.append(node)
                for values, value in zip(beside, others):
                    values.append(value)
                if builder.seen == builder.leaves:
                    done.append((key, tile, builder.leaves, total, b"".join(builder.log), *beside))
                    builder = None
            if done:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                kinds += [pa.list_(batch.schema.field(c).type) for c in extra]
                columns = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "tile", "n", "total", "nodes", *extra])

    return run


def tile_levels(total: int) -> int:
    """Levels above its input that a tile holds where its key has so many nodes in the round."""
    return min(BITS, height(total))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles with the path above them -> the path of each of their nodes."""
    for batch in batches:
        columns = ("key", "tile", "n", "total", "nodes", "path", "subroot")
        for key, tile, n, total, nodes, above, subroot in zip(*(batch[c].to_pylist() for c in columns)):
            paths = [packed(siblings(nodes, i, n, tile_levels(total))) + above for i in range(n)]
            places = pa.array(range(tile << BITS, (tile << BITS) + n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * n), places, pa.array(paths, pa.binary()), pa.array([subroot] * n, pa.binary())],
                names=["key", "at", "path", "subroot"],
            )


def with_paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first round's tiles with ``path``, the siblings of the tile's own top, and ``subroot``.

    ``above``: ``key, path, subroot`` of each key's top.  Round by round downwards, a
    tile's closed-form positions give the siblings of its nodes, the tops of the tiles
    below; so a path is made for every ``2**BITS`` leaves only.
    """
    paths = rounds[-1].select("key", "tile").join(above, "key")
    for tiles in reversed(rounds[1:]):
        found = tiles.join(paths, ["key", "tile"]).mapInArrow(_paths, PATH)
        paths = stage(found.withColumnRenamed("at", "tile"), "paths")
    return rounds[0].join(paths, ["key", "tile"])


def _proofs(root: bytes | None, schema: StructType):
    """Tiles with paths -> a row per leaf: its proof and what folding it gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("n", "total", "nodes", "path", "subroot", "id", "other")
        for batch in batches:
            id_type = batch.schema.field("id").type.value_type
            for n, total, nodes, path, subroot, ids, others in zip(*(batch[c].to_pylist() for c in columns)):
                above = list(unpacked(path))
                above_hex = "".join(node.hex() for _, node in above)
                ends: dict[bytes, bytes] = {}
                leaves, proofs, roots = [], [], []
                for i in range(n):
                    at = position(0, i, n) * SIZE
                    leaf = nodes[at : at + SIZE]
                    steps = list(siblings(nodes, i, n, tile_levels(total)))
                    proof = "".join(node.hex() for _, node in steps) + above_hex
                    reached = folded(leaf if others[i] is None else others[i], steps)
                    if reached not in ends:
                        ends[reached] = folded(reached, above)
                    leaves.append(leaf.hex())
                    proofs.append(hashlib.sha256(proof.encode()).hexdigest())
                    roots.append(ends[reached])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, id_type),
                        pa.array(leaves),
                        pa.array([subroot.hex()] * n),
                        pa.array([root.hex()] * n),
                        pa.array(proofs),
                        pa.array([r.hex() for r in roots]),
                        pa.array([r == root for r in roots]),
                    ],
                    names=schema.names,
                )

    return run


def dataset_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: list[str] | None = None,
    tampered: list[Column] | None = None,
    tampered_rows: Column | None = None,
) -> DataFrame:
    """A row per input row: ``id_col, leaf, subroot, root, proof_sha256, folded_root, verified``, digests in hex.

    ``columns`` (all if not given) make up a leaf.  Leaves of a group ascend by id (and
    then by digest) and form its tree; the groups' subroots, null first, then by UTF-8
    bytes, form the tree of the root.  ``proof_sha256`` is the digest of the row's
    siblings, from its leaf to the root.  ``folded_root`` is what the siblings and the
    row's leaf give, with the leaf made of ``tampered`` (columns in the place of
    ``columns``) for ``tampered_rows``; ``verified`` tells whether it equals the root.

    Texts are digested where they are read; only digests, ids and keys are shuffled:
    once by range to find places, once by aligned run to build.  A group may hold any
    share of the rows.  Each further round has a ``2**BITS``-th of the rows before, and
    so have the paths that the tiles of leaves are joined with.  The driver gets the
    root alone.

    Null ids come first.  Equal rows have equal leaves and places of their own.  Null,
    empty and long texts are values like others.  Extra columns are leaves' content only
    if named; an empty table gives an empty result.
    """
    other = F.lit(None).cast("binary")
    if tampered is not None:
        other = F.when(F.lit(True) if tampered_rows is None else tampered_rows, leaf_digest(tampered))
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("key"),
        F.col(id_col).alias("id"),
        leaf_digest([F.col(c) for c in columns or docs.columns]).alias("node"),
        other.alias("other"),
    )
    placed, largest = place_leaves(leaves.withColumn("rank", F.struct("id", "node")))
    rounds = build_log(placed, largest)
    subroots = rounds[-1].select(F.lit("").alias("key"), F.struct("key").alias("rank"), F.col("key").alias("of"), top("nodes").alias("node"))
    groups, n_groups = place_leaves(subroots)
    groups = stage(groups, "subroots")
    crown = build_log(groups.drop("of"), n_groups)
    start = crown[-1].select("key", F.lit(b"").alias("path"), F.lit(b"").alias("subroot"))
    crown_paths = stage(with_paths(crown, start).mapInArrow(_paths, PATH), "paths").drop("subroot")
    above = groups.join(crown_paths, ["key", "at"]).select(F.col("of").alias("key"), "path", F.col("node").alias("subroot"))
    root = crown[-1].select(top("nodes").alias("root")).first()
    id_type = docs.schema[id_col].dataType
    schema = StructType().add("id", id_type)
    for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root"):
        schema = schema.add(name, "string")
    schema = schema.add("verified", "boolean")
    tiles = with_paths(rounds, stage(above, "group_paths"))
    return tiles.mapInArrow(_proofs(bytes(root["root"]) if root else None, schema), schema).withColumnRenamed("id", id_col)


CHECK = r"""
WITH RECURSIVE bits AS (
  SELECT range AS byte, 0 AS k, range AS c FROM range(256)
  UNION ALL
  SELECT byte, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT byte, c FROM bits WHERE k = 8),
crc AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s, 1 AS pl, 4294967295::BIGINT AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, s, pl + 1, xor(crc.c >> 8, t.c)
  FROM crc JOIN crc_table t ON t.byte = xor(crc.c, ascii(s[pl])::BIGINT) & 255 WHERE pl <= length(s)),
marked AS (SELECT doc_id, xor(c, 4294967295) % 7 = 0 AS tampered FROM crc WHERE pl = length(s) + 1),
parts AS (
  SELECT d.doc_id, coalesce('=' || lang, '') AS key, coalesce(tampered, false) AS tampered,
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS before,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS after
  FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id),
leaves AS (
  SELECT key, doc_id, tampered,
    sha256(before || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || after) AS leaf,
    sha256(before || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || after) AS other
  FROM parts),
placed AS (
  SELECT *, row_number() OVER () AS doc, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pl,
    count(*) OVER (PARTITION BY key) AS n
  FROM leaves),
tree AS (
  SELECT key, 0 AS h, pl AS i, n, leaf AS node FROM placed
  UNION ALL
  SELECT key, any_value(h) + 1, i // 2, any_value(n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY key, i // 2),
subroots AS (
  SELECT key, node, row_number() OVER (ORDER BY key) - 1 AS pl, count(*) OVER () AS n FROM tree WHERE n = 1),
crown AS (
  SELECT 0 AS h, pl AS i, n, node FROM subroots
  UNION ALL
  SELECT any_value(h) + 1, i // 2, any_value(n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY i // 2),
root AS (SELECT node AS root FROM crown WHERE n = 1),
levels AS (
  SELECT p.doc, t.h AS level, p.pl >> t.h AS i, s.i AS j, s.node
  FROM placed p JOIN (SELECT DISTINCT key, h, n FROM tree WHERE n > 1) t ON t.key = p.key
  LEFT JOIN tree s ON s.key = p.key AND s.h = t.h AND s.i = xor(p.pl >> t.h, 1)
  UNION ALL
  SELECT p.doc, 1000 + t.h, r.pl >> t.h, s.i, s.node
  FROM placed p JOIN subroots r ON r.key = p.key CROSS JOIN (SELECT DISTINCT h, n FROM crown WHERE n > 1) t
  LEFT JOIN crown s ON s.h = t.h AND s.i = xor(r.pl >> t.h, 1)),
steps AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY level) AS step FROM levels),
fold AS (
  SELECT doc, 1 AS step, CASE WHEN tampered THEN other ELSE leaf END AS node FROM placed
  UNION ALL
  SELECT f.doc, f.step + 1, sha256(CASE WHEN j IS NULL THEN f.node WHEN j < i THEN s.node || f.node ELSE f.node || s.node END)
  FROM fold f JOIN steps s ON s.doc = f.doc AND s.step = f.step),
ends AS (SELECT doc, node FROM fold QUALIFY row_number() OVER (PARTITION BY doc ORDER BY step DESC) = 1),
proofs AS (SELECT doc, coalesce(string_agg(node, '' ORDER BY step), '') AS proof FROM steps GROUP BY doc)
SELECT doc_id, leaf, r.node AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, e.node AS folded_root, e.node = root AS verified
FROM placed p JOIN subroots r ON r.key = p.key JOIN ends e ON e.doc = p.doc LEFT JOIN proofs f ON f.doc = p.doc CROSS JOIN root
"""
