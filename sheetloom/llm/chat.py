"""Chat formatting by token-level assembly."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.tokens import Bpe, vocabulary_path

#: The template: what the three reserved ids (from the vocabulary's size on) are
#: rendered as.  A turn is OPEN role MIDDLE text CLOSE.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
#: Strings of a text, and of a role, that a reader of rendered text would take for marks.
IN_TEXT, IN_ROLE = r"###|</turn>", r"###|</turn>|:"


def escape(text: str, controls: str = IN_TEXT) -> str:
    """Puts a backslash before each control string and doubles backslashes that stand before one."""
    return re.sub(rf"(\\*)({controls})", lambda m: m[1] * 2 + "\\" + m[2], text)


def unescape(text: str, controls: str = IN_TEXT) -> str:
    return re.sub(rf"(\\+)({controls})", lambda m: m[1][: len(m[1]) // 2] + m[2], text)


def _encode_turns(path: str, learned_roles: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        marks = np.arange(bpe.size, bpe.size + 3, dtype=np.uint32)
        for batch in batches:
            ids, learned = [], []
            for role, text in zip(batch["role"].to_pylist(), batch["text"].to_pylist()):
                parts = [
                    marks[:1],
                    bpe.encode(escape(role or "", IN_ROLE)),
                    marks[1:2],
                    bpe.encode(escape(text or "")),
                    marks[2:],
                ]
                row = np.concatenate(parts)
                # The mask is a prefix sum over +1 where a learned text begins and -1 where it ends.
                step = np.zeros(len(row) + 1, np.int8)
                if role in learned_roles:
                    begin = sum(map(len, parts[:3]))
                    step[begin] += 1
                    step[begin + len(parts[3])] -= 1
                ids.append(row.astype(np.int32))
                learned.append(np.cumsum(step[:-1], dtype=np.int8).astype(bool))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["conv_id"],
                    batch["turn"],
                    batch["tie"],
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(learned, pa.list_(pa.bool_())),
                ],
                names=["conv_id", "turn", "tie", "ids", "loss"],
            )

    return run


def format_turns(
    conversations: DataFrame, learned_roles: tuple[str, ...] = ("assistant",), vocabulary: str | None = None
) -> DataFrame:
    """A row per turn: ``conv_id, turn, place, start, ids, loss``.

    ``ids`` are the turn's token ids, marks included; ``loss`` tells which of them are
    learned (texts of ``learned_roles``, without marks); ``place`` and ``start`` are
    the numbers of turns and tokens before it in the conversation.

    Roles and texts are encoded apart from each other and from the marks, which are
    reserved ids no text can produce; control strings in roles and texts are escaped.
    Turns are encoded where they lie; only then are they brought together, and a long
    conversation stays many rows.

    Rows of a conversation are ordered by turn (null first), then role and text, so
    repeated turns are turns of their own.  Null roles and texts are empty; null
    conversation ids are one conversation.  Extra columns are ignored.
    """
    types = dict(conversations.dtypes)
    tie = F.md5(F.concat_ws("\n", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))
    rows = conversations.select("conv_id", "turn", tie.alias("tie"), "role", "text").mapInArrow(
        _encode_turns(vocabulary or vocabulary_path(), frozenset(learned_roles)),
        f"conv_id {types['conv_id']}, turn {types['turn']}, tie string, ids array<int>, loss array<boolean>",
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "tie")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "conv_id",
        "turn",
        (F.row_number().over(order) - 1).cast("long").alias("place"),
        F.coalesce(F.sum(F.size("ids")).over(before), F.lit(0)).alias("start"),
        "ids",
        "loss",
    )


def format_conversations(conversations: DataFrame, **options) -> DataFrame:
    """A row per conversation: ``conv_id, n_turns, ids, loss``, for conversations that fit into a row."""
    turns = format_turns(conversations, **options)
    parts = F.sort_array(F.collect_list(F.struct("place", "ids", "loss")))
    return turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"), parts.alias("parts")).select(
        "conv_id", "n_turns", F.flatten("parts.ids").alias("ids"), F.flatten("parts.loss").alias("loss")
    )


def _read_back(path: str):
    """Turns sorted by conversation and place -> digests of what a reader of the output finds.

    One conversation is open at a time, and of it nothing but running digests.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, state = Bpe(path), None

        def result(rows: list[tuple]) -> pa.RecordBatch:
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*rows) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

        def close() -> tuple:
            conv, n, turns, n_loss, loss, n_all = state
            return conv, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_all

        for batch in batches:
            id_type, done = batch["conv_id"].type, []
            for i in range(batch.num_rows):
                conv, place = batch["conv_id"][i].as_py(), batch["place"][i].as_py()
                if place == 0:
                    if state:
                        done.append(close())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = batch["ids"][i].values.to_numpy(zero_copy_only=False)
                loss = batch["loss"][i].values.to_numpy(zero_copy_only=False)
                middle = int(np.flatnonzero(ids == bpe.size + 1)[0])
                role, text = bpe.decode(ids[1:middle]), bpe.decode(ids[middle + 1 : -1])
                learned = unescape(bpe.decode(ids[loss]))
                state[1] += 1
                state[2].update(f"{unescape(role, IN_ROLE)}\n{unescape(text)}\n".encode())
                state[3] += len(learned)
                state[4].update(learned.encode())
                state[5] += len(OPEN) + len(role) + len(MIDDLE) + len(text) + len(CLOSE)
            yield result(done)
        if state:
            yield result([close()])

    return run


def conversation_digests(turns: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Reads formatted turns back: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    A digest of a conversation is sequential, so its turns pass through one task, one
    at a time.
    """
    id_type = dict(turns.dtypes)["conv_id"]
    return (
        turns.select("conv_id", "place", "ids", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "place")
        .mapInArrow(
            _read_back(vocabulary or vocabulary_path()),
            f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )


#: Rendered length without tokens: marks, escaped roles and texts.
CHECK = r"""
WITH extra AS (
  SELECT -7 AS conv_id, 0 AS turn, 'user' AS role, '\### Assistant: </turn> ok' AS text
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM extra),
shown AS (
  SELECT *, length(role) + list_sum([0] || list_transform(regexp_extract_all(role, '(\\*)(###|</turn>|:)', 1), lambda b: length(b) + 1))
              AS role_chars,
         length(text) + list_sum([0] || list_transform(regexp_extract_all(text, '(\\*)(###|</turn>)', 1), lambda b: length(b) + 1))
              AS text_chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + role_chars + 2 + text_chars + 8)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""
