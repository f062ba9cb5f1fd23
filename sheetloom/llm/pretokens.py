"""Pre-tokens of byte-level BPE, cut from whole batches of texts in array operations.

The vocabulary's library splits a text by letters, numbers, white space and the rest,
as its own tables class them.  Those classes are asked from the library itself, so
that the pieces equal its own for every code point.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3

#: Characters that are worked on at once; longer texts are cut where a pre-token must end.
CHARS = 1 << 21

#: A place where every pre-token ends: before white space that follows something else.
_SEAM = re.compile(r"(?<=\S)[ \t\n]")


class Split(NamedTuple):
    """Pre-tokens of several texts, in order."""

    tokens: pa.StringArray
    special: np.ndarray  # tokens that are special strings of the vocabulary
    first: np.ndarray  # each text's first token, and the end


def special_strings(vocabulary: bytes) -> list[str]:
    """The vocabulary's added strings; raises where the file asks for steps that are not byte-level BPE."""
    said = json.loads(vocabulary)
    split = said.get("pre_tokenizer") or {}
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or said.get("normalizer"):
        raise ValueError("not a byte-level BPE vocabulary without normalizer and prefix space")
    added = said.get("added_tokens") or []
    if any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or re.search(r"\s", a["content"]) for a in added):
        raise ValueError("added tokens that take in white space or whole words")
    return sorted((a["content"] for a in added), key=lambda s: (-len(s), s))


def character_classes(codec) -> np.ndarray:
    """Class of every code point, from the library's own pre-tokenizer."""
    split = codec.pre_tokenizer.pre_tokenize_str
    guess = {LETTER: [], NUMBER: [], BLANK: [], OTHER: []}
    for c in map(chr, range(0x110000)):
        if not "\ud800" <= c <= "\udfff":
            guess[LETTER if c.isalpha() else NUMBER if c.isnumeric() else BLANK if c.isspace() else OTHER].append(c)
    table = np.zeros(0x110000, np.uint8)
    for chars in map("".join, guess.values()):
        for _, (start, end) in split(chars):
            c = chars[start:end].lstrip(" ")[:1] or " "
            alike = (k for k, before in ((LETTER, "a"), (NUMBER, "1"), (BLANK, "\n")) if len(split(before + c)) == 1)
            table[np.frombuffer(chars[start:end].encode("utf-32-le"), np.uint32)] = next(alike, OTHER)
    table[32] = BLANK
    return table


def pieces(text: str, chars: int = CHARS) -> Iterator[str]:
    """A text in parts whose pre-tokens are its own."""
    start = 0
    while len(text) - start > chars:
        seam = _SEAM.search(text, start + chars)
        if seam is None:
            break
        yield text[start : seam.start()]
        start = seam.start()
    yield text[start:]


def blocks(texts: list[str], chars: int = CHARS) -> Iterator[tuple[list[str], np.ndarray]]:
    """Parts of texts of about ``chars`` characters together, and the text each is from."""
    held, owner, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in pieces(text, chars):
            held.append(piece)
            owner.append(i)
            size += len(piece)
            if size >= chars:
                yield held, np.array(owner)
                held, owner, size = [], [], 0
    if held:
        yield held, np.array(owner)


def split(texts: list[str], classes: np.ndarray, specials: list[str]) -> Split:
    """The library's pre-tokens of each text; special strings are tokens of their own."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(codes)
    ends = np.cumsum([0, *map(len, texts)])
    edge = np.zeros(n + 1, bool)  # a new text, or a special string's ends
    edge[ends] = True
    taken = []
    if specials:
        for found in re.finditer("|".join(map(re.escape, specials)), joined):
            whole = ends[np.searchsorted(ends, found.start(), "right")] >= found.end()
            if whole:
                taken.append(found.span())
    for span in taken:
        edge[list(span)] = True
    kind = classes[codes]
    begin = edge.copy()
    begin[1:n] |= kind[1:] != kind[:-1]
    begin[n] = True
    runs = np.flatnonzero(begin)
    blank = np.flatnonzero(kind[runs[:-1]] == BLANK)
    start, end = runs[blank], runs[blank + 1]
    inner = ~edge[end]  # something else follows in the same text
    last = end[inner] - 1
    begin[last] = True
    begin[end[inner][codes[last] == 32]] = False
    # 's, 't, 'm, 'd, 're, 've and 'll end a pre-token where an apostrophe begins one.
    mark = np.flatnonzero((codes == 39) & begin[:n])
    mark = mark[mark + 1 < n]
    mark = mark[~edge[mark + 1]]
    one = codes[mark + 1]
    short = np.isin(one, [ord(c) for c in "stmd"])
    pairs = mark[~short & (mark + 2 < n)]
    pairs = pairs[~edge[pairs + 2]]
    a, b = codes[pairs + 1], codes[pairs + 2]
    pairs = pairs[((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))]
    begin[mark[short] + 1] = begin[pairs + 1] = False
    begin[mark[short] + 2] = begin[pairs + 3] = True
    for a, b in taken:
        begin[a + 1 : b] = False
    begin[ends] = True
    places = np.flatnonzero(begin)
    width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
    offsets = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[places].astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(offsets), pa.py_buffer(joined.encode()))
    special = np.searchsorted(places, [a for a, _ in taken])
    return Split(tokens, special.astype(np.int64), np.searchsorted(places, ends))
