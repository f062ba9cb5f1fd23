"""Character n-grams of whole batches of texts in array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = 32
#: Characters that are worked on at once.
CHARS = 1 << 21


def letters(text: str, digits: bool = False) -> Column:
    """Lower case, everything but letters (and digits) a single space; null: empty."""
    kept = r"[^\p{L}\p{M}\p{N}]+" if digits else r"[^\p{L}\p{M}]+"
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), kept, " "))


def blocks(texts, chars: int = CHARS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts: first, end, their code points with a space around each text, and where each begins."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        value = text.as_py() or ""
        held.append(f" {value} ")
        size += len(value) + 2
        if size >= chars:
            yield first, i + 1, *_joined(held)
            first, held, size = i + 1, [], 0
    if held:
        yield first, first + len(held), *_joined(held)


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def hashed(codes: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and buckets of the n-grams that have no space but at their ends."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spaces = np.concatenate([[0], np.cumsum(codes == SPACE, dtype=np.int32)])
    places = np.flatnonzero(spaces[n - 1 : n - 1 + size] == spaces[1 : 1 + size])
    h = np.full(len(places), n, np.uint64)
    for j in range(n):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += codes[places + j]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return places, (h >> np.uint64(64 - bits)).astype(np.int64)
