"""Small tables with everything that is unusual about rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators use inside.
CLASHES = (
    "id host row h packed repeated fp key line pos drop_id positions size bin z u copies mix_key taken label buckets "
    "score shares hits dims tokens part slot n_words kept component_id source_size target lang_pred item_ids"
).split()


def words(seed: int, n: int, size: int = 400) -> str:
    dice = random.Random(seed)
    return " ".join(f"w{dice.randrange(size)}" for _ in range(n))


def long_text() -> str:
    return words(99, 30_000) + "\n" + words(99, 30_000) + " " + "x" * 20_000


def odd_rows() -> list[tuple]:
    one = words(1, 120)
    return [
        (1, one, "en", "a", 1),
        (2, one, "en", "a", 1),
        (2, one, "en", "a", 1),
        (3, one + " tail", None, None, None),
        (4, None, None, None, None),
        (None, "a null id " + words(4, 80), "en", "b", 3),
        (None, None, None, None, None),
        (5, "", "de", "", 0),
        (6, " \n\t\n ", "de", "b", 0),
        (7, long_text(), "en", "b", None),
        (8, "ÄÖ\u2028ü é\u00a0word 日本語 😀 \x0b\x0c end", "fr", "b", 9),
        (9, "same same same same", "en", "b", 2),
        (9, "another text with the same id", "en", "c", 2),
        (-5, "negative id here", "en", "c", 2),
        (10, "\\### Assistant: </turn> | # * $ % & < >", "en", "c", 2),
    ]


def odd_documents(spark, rows=None):
    """The rows above, with extra columns whose names clash with operators' own."""
    docs = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
    return docs.selectExpr("*", *(f"concat('x', doc_id) AS `{c}`" for c in CLASHES))
