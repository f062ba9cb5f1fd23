"""Public byte-level BPE vocabularies, read from files outside the package."""

from __future__ import annotations

import base64
import os

import numpy as np

from sheetloom.llm.pretokens import pieces

#: Folder of the vocabulary files; every executor must have it at this path.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: The vocabulary's own pre-tokenization pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Longer texts are encoded in parts of about so many characters, where they have a place to cut.
PIECE = 50_000


def vocabulary_path(name: str = VOCABULARY, folder: str = TOKENIZERS) -> str:
    return os.path.join(folder, name)


class Bpe:
    """Encodes ordinary text, so that no string in it becomes a reserved id, and decodes exactly."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.size = max(self.ranks.values()) + 1
        self._codec = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self._bytes = {rank: token for token, rank in self.ranks.items()}

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text.  Long texts are cut where every pre-token ends, so ids don't depend on the length."""
        ids: list[int] = []
        for piece in pieces(text, PIECE):
            ids.extend(self._codec.encode_ordinary(piece))
        return np.array(ids, np.uint32)

    def decode(self, ids) -> str:
        return b"".join(self._bytes[int(i)] for i in ids).decode()
