"""Training-order materialisation: token sequences in fixed-stride shards, in a keyed order."""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetloom.llm.tokens import Bpe, vocabulary_path
from sheetloom.session import run_dir
from sheetloom.sources.changes import open_folder
from sheetloom.sources.staging import collected, release, stage

ROUNDS = 6
#: Tokens that are compressed together while documents wait for their place.
CHUNK = 1 << 20


class Feistel:
    """A permutation of 0 .. n-1 under a key, and its inverse.

    A balanced Feistel network permutes the next even power of two; values outside
    the range are sent through it again until they fall inside (cycle-walking), which
    takes fewer than four steps on average.
    """

    def __init__(self, n: int, key: int) -> None:
        self.n = n
        self.half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.keys = [
            struct.unpack("<Q", hashlib.sha256(f"{key}:{r}".encode()).digest()[:8])[0] for r in range(ROUNDS)
        ]

    def _round(self, value: np.ndarray, key: int) -> np.ndarray:
        x = value.astype(np.uint64) ^ np.uint64(key)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return ((x ^ (x >> np.uint64(32))) & np.uint64(self.mask)).astype(np.int64)

    def _pass(self, value: np.ndarray, forward: bool) -> np.ndarray:
        left, right = value >> self.half, value & self.mask
        for key in self.keys if forward else reversed(self.keys):
            if forward:
                left, right = right, left ^ self._round(right, key)
            else:
                left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, values: np.ndarray, forward: bool) -> np.ndarray:
        out = self._pass(np.asarray(values, np.int64), forward)
        while (outside := out >= self.n).any():
            out[outside] = self._pass(out[outside], forward)
        return out

    def slots(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, True)

    def indexes(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, False)


def _tokenise(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, pack = Bpe(path), zstandard.ZstdCompressor(level=6)
        part, at = TaskContext.get().partitionId(), 0
        ids, lengths, tokens, n = [], [], [], 0
        end = np.array([bpe.size], np.uint32)

        def flush() -> pa.RecordBatch:
            blob = pack.compress(np.concatenate(tokens).astype("<u2").tobytes())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([at], pa.int64()),
                    pa.array([n], pa.int64()),
                    pa.array([ids], pa.list_(id_type)),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([blob], pa.binary()),
                ],
                names=["part", "start", "n", "ids", "lengths", "tokens"],
            )

        for batch in batches:
            id_type = batch["id"].type
            for doc_id, text in zip(batch["id"], batch["text"]):
                found = np.concatenate([bpe.encode(text.as_py() or ""), end])
                # A document longer than a chunk goes on in the next ones.
                for i in range(0, len(found), CHUNK):
                    piece = found[i : i + CHUNK]
                    if n and n + len(piece) > CHUNK:
                        yield flush()
                        at, ids, lengths, tokens, n = at + n, [], [], [], 0
                    ids.append(doc_id.as_py())
                    lengths.append(len(piece))
                    tokens.append(piece)
                    n += len(piece)
        if n:
            yield flush()

    return run


def _deal(total: int, n_sequences: int, length: int, shard_size: int, key: int):
    """Chunks of the token stream -> their pieces of sequences, grouped by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Feistel(n_sequences, key)
        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                get = {c: batch[c][row].as_py() for c in ("first", "n", "ids", "lengths", "tokens")}
                first, n = get["first"], get["n"]
                tokens = np.frombuffer(unpack.decompress(get["tokens"]), "<u2")
                sequences = np.arange(first // length, (first + n - 1) // length + 1)
                slots = order.slots(sequences)
                lo = np.maximum(sequences * length - first, 0)
                hi = np.minimum((sequences + 1) * length - first, n)
                starts = np.concatenate([[0], np.cumsum(get["lengths"])])
                doc_lo = np.searchsorted(starts, lo, "right") - 1
                doc_hi = np.searchsorted(starts, hi, "left")
                rank = np.argsort(slots // shard_size, kind="stable")
                out = {c: [] for c in ("shard", "slots", "at", "sizes", "docs", "tokens")}
                for shard, group in groupby(rank.tolist(), lambda i: int(slots[i]) // shard_size):
                    group = list(group)
                    out["shard"].append(shard)
                    out["slots"].append([int(slots[i]) for i in group])
                    out["at"].append([int(lo[i] + first - sequences[i] * length) for i in group])
                    out["sizes"].append([int(hi[i] - lo[i]) for i in group])
                    out["docs"].append([get["ids"][doc_lo[i] : doc_hi[i]] for i in group])
                    out["tokens"].append(pack.compress(b"".join(tokens[lo[i] : hi[i]].tobytes() for i in group)))
                longs, ids = pa.list_(pa.int64()), pa.list_(pa.list_(batch["ids"].type.value_type))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["shard"], pa.int32()),
                        pa.array(out["slots"], longs),
                        pa.array(out["at"], longs),
                        pa.array(out["sizes"], longs),
                        pa.array(out["docs"], ids),
                        pa.array(out["tokens"], pa.binary()),
                    ],
                    names=list(out),
                )

    return run


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _write(folder: str, total: int, n_sequences: int, length: int, shard_size: int, key: int, pad: int):
    """Pieces, a partition's shards one after the other -> shard files and a manifest row per sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        order, unpack = Feistel(n_sequences, key), zstandard.ZstdDecompressor()
        shard, buffer, docs, id_type = None, None, {}, None

        def finish() -> pa.RecordBatch:
            # Another attempt may write the same shard: each has its own file, the last rename stays.
            name, rows = f"{root}/{shard_name(shard)}", len(buffer)
            attempt = f"{name}.{uuid.uuid4().hex}"
            with files.open_output_stream(attempt) as out:
                out.write(buffer.tobytes())
            files.move(attempt, name)
            slots = np.arange(rows) + shard * shard_size
            index = order.indexes(slots)
            n = np.minimum(total - index * length, length)
            pieces = [[d for _, part in sorted(docs[int(s)]) for d in part] for s in slots]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(slots),
                    pa.array(index),
                    pa.array(np.full(rows, shard, np.int32)),
                    pa.array(np.arange(rows) * length * 2),
                    pa.array(n),
                    pa.array([list(dict.fromkeys(p)) for p in pieces], pa.list_(id_type)),
                    pa.array([hashlib.sha256(row.tobytes()).hexdigest() for row in buffer]),
                ],
                names=["slot", "sequence", "shard", "byte_offset", "n_tokens", "doc_ids", "sha256"],
            )

        for batch in batches:
            id_type = batch["docs"].type.value_type.value_type
            for row in range(batch.num_rows):
                if batch["shard"][row].as_py() != shard:
                    if shard is not None:
                        yield finish()
                    shard, docs = batch["shard"][row].as_py(), {}
                    buffer = np.full((min(shard_size, n_sequences - shard * shard_size), length), pad, "<u2")
                tokens, i = np.frombuffer(unpack.decompress(batch["tokens"][row].as_py()), "<u2"), 0
                columns = (batch[c][row].as_py() for c in ("slots", "at", "sizes", "docs"))
                for slot, at, size, of in zip(*columns):
                    buffer[slot - shard * shard_size, at : at + size] = tokens[i : i + size]
                    docs.setdefault(slot, []).append((at, of))
                    i += size
        if shard is not None:
            yield finish()

    return run


def write_training_order(
    docs: DataFrame,
    folder: str,
    length: int = 4096,
    shard_size: int = 2048,
    key: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
) -> DataFrame:
    """Writes shards and returns their manifest, a row per sequence:
    ``slot, sequence, shard, byte_offset, n_tokens, doc_ids, sha256``.

    Texts are tokenised, each document is ended by a reserved id (the vocabulary's
    size), and the stream of documents, in the order of the scan, is cut into
    sequences of ``length`` tokens.  A keyed permutation gives every sequence its
    slot.  A shard is a range of ``shard_size`` slots: little-endian 16-bit ids, so
    that slot s lies at ``(s % shard_size) * 2 * length`` of shard ``s // shard_size``.
    The last sequence is filled up with the end id.

    Texts are tokenised once and wait, compressed, in the shared folder.  Only one
    count per partition is gathered to place them.  Each range goes to one task,
    whose memory is one shard; a lost task writes the same bytes again.

    Null and empty texts are a lone end id.  Null ids stay null in ``doc_ids``, which
    lists a sequence's documents in order.  Repeated rows are documents like any
    other.  An empty table gives no shard.  Extra columns are ignored.
    """
    with collected() as waiting:
        manifest = _write_shards(docs, folder, length, shard_size, key, id_col, text_col, vocabulary or vocabulary_path())
    release(docs.sparkSession, waiting)
    return manifest


def _write_shards(
    docs: DataFrame, folder: str, length: int, shard_size: int, key: int, id_col: str, text_col: str, path: str
) -> DataFrame:
    spark = docs.sparkSession
    end = Bpe(path).size
    id_type = docs.schema[id_col].dataType.simpleString()
    chunks = stage(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            _tokenise(path),
            f"part int, start long, n long, ids array<{id_type}>, lengths array<long>, tokens binary",
        ),
        "tokens",
    )
    earlier = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = chunks.groupBy(F.col("part").alias("of_part")).agg(F.sum("n").alias("part_n"))
    offsets = stage(parts.withColumn("offset", F.coalesce(F.sum("part_n").over(earlier), F.lit(0))), "offsets")
    total = offsets.agg(F.sum("part_n")).first()[0] or 0
    n_sequences = -(-total // length)
    n_shards = max(1, -(-n_sequences // shard_size))
    out = f"{folder.rstrip('/')}/manifest"
    _write_meta(spark, folder, {"length": length, "shard_size": shard_size, "key": key, "n_sequences": n_sequences, "n_tokens": total, "end": end})
    placed = chunks.join(offsets, F.col("part") == F.col("of_part")).select(
        (F.col("offset") + F.col("start")).alias("first"), "n", "ids", "lengths", "tokens"
    )
    pieces = placed.mapInArrow(
        _deal(total, n_sequences, length, shard_size, key),
        f"shard int, slots array<long>, at array<long>, sizes array<long>, docs array<array<{id_type}>>, tokens binary",
    )
    manifest = pieces.repartitionById(n_shards, "shard").mapInArrow(
        _write(folder, total, n_sequences, length, shard_size, key, end),
        f"slot long, sequence long, shard int, byte_offset long, n_tokens long, doc_ids array<{id_type}>, sha256 string",
    )
    manifest.write.mode("overwrite").parquet(out)
    return spark.read.schema(manifest.schema).parquet(out)


def _write_meta(spark: SparkSession, folder: str, meta: dict) -> None:
    row = spark.createDataFrame([(json.dumps(meta),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{folder.rstrip('/')}/meta")


def read_training_order(spark: SparkSession, folder: str, first_slot: int = 0) -> DataFrame:
    """``slot, ids`` from a slot on: shards before it aren't opened, its own is read from its offset."""
    meta = json.loads(spark.read.text(f"{folder.rstrip('/')}/meta").first()["value"])
    length, size, n = meta["length"], meta["shard_size"], meta["n_sequences"]
    shards = spark.range(first_slot // size, -(-n // size)).repartition(F.col("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        for batch in batches:
            for shard in batch["id"].to_pylist():
                slot = max(first_slot, shard * size)
                with files.open_input_file(f"{root}/{shard_name(shard)}") as data:
                    data.seek((slot - shard * size) * 2 * length)
                    while slot < min(n, (shard + 1) * size):
                        ids = np.frombuffer(data.read(2 * length * 256), "<u2").reshape(-1, length).astype(np.int32)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.arange(slot, slot + len(ids))), pa.array(list(ids), pa.list_(pa.int32()))],
                            names=["slot", "ids"],
                        )
                        slot += len(ids)

    return shards.mapInArrow(run, "slot long, ids array<int>")


def new_folder(spark: SparkSession) -> str:
    return run_dir(spark, "shards")
