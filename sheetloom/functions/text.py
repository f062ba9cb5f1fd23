"""Small text helpers shared by all column functions.

Regular expressions spell out word boundaries and white space instead of using
``\\b`` and plain ``\\s``, so that Korean text gives the same result on every
Java version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, the set that trimming removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\s\x1c-\x1f]"
WORD_EDGE = (
    r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"
)
HANGUL = r"[가-힣]"

_WIDE_DIGITS = "０１２３４５６７８９"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pattern(regex: str, ignore_case: bool = False) -> str:
    """Java form of a pattern: Unicode classes on, our white-space class."""
    return ("(?iU)" if ignore_case else "(?U)") + regex.replace(r"\s", SPACE)


def standalone_pattern(regex: str) -> str:
    """The pattern where no word character touches it.

    The look-behind comes last: it is tried on candidates only, not at every
    position of a long text.  The pattern must have a bounded length.
    """
    return rf"{regex}(?![\p{{L}}\p{{N}}_])(?<![\p{{L}}\p{{N}}_]{regex})"


def strip(c: Column | str) -> Column:
    return F.trim(as_column(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def fold_digits(c: Column) -> Column:
    return F.translate(c, _WIDE_DIGITS, "0123456789")


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def matches_any(c: Column, regexes: list[str], ignore_case: bool = False) -> Column:
    return c.rlike(pattern("|".join(f"(?:{r})" for r in regexes), ignore_case))


def extract_or_null(c: Column, regex: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern(regex), group), F.lit(""))
