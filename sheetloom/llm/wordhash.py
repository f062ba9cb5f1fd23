"""Words of whole batches of texts as 64-bit numbers, in array operations."""

from __future__ import annotations

import unicodedata

import numpy as np

SPACE = 32


def fold_table() -> np.ndarray:
    """Code point -> its lower case, or a space where it is no letter, mark or digit (first plane)."""
    table = np.full(1 << 16, SPACE, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if unicodedata.category(c)[0] in "LMN":
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def fold(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Folded code points; what lies beyond the first plane counts as letters."""
    return np.where(codes < 1 << 16, table[np.minimum(codes, (1 << 16) - 1)], codes)


def word_hashes(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of folded code points, and each text's first word (one more for the end).

    ``starts``: each text's first code point, which is a space, and the end.
    """
    letter = codes != SPACE
    begin = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    place = np.flatnonzero(letter)
    first = np.searchsorted(place, begin)
    x = codes[place].astype(np.uint64)
    offset = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
    x += offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(29)
    return np.add.reduceat(x, first), np.searchsorted(begin, starts)
