"""Value cleaning and single-field extraction as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions.text import (
    WORD_EDGE,
    as_column,
    blank_to_null,
    contains_any,
    extract_or_null,
    fold_digits,
    pattern,
    strip,
)

_YEARS = r"(20\d{2}(?:\s*-\s*20\d{2})?)"


def clean_program_type(c: Column | str) -> Column:
    """Strip, then remove line breaks."""
    return F.replace(strip(c), F.lit("\n"), F.lit(""))


def collapse_whitespace(c: Column | str) -> Column:
    """Runs of white space become one blank; blank values stay as they are."""
    c = as_column(c)
    collapsed = F.trim(F.regexp_replace(c, pattern(r"\s+"), " "))
    return F.when(strip(c) != "", collapsed).otherwise(c)


def normalise_gpa(c: Column | str) -> Column:
    """``a/b`` stays, ``x 이상`` and a bare number become ``x/4.5``."""
    v = blank_to_null(c)
    at_least = extract_or_null(v, r"(\d+\.?\d*)\s*이상", 1)
    return (
        F.when(v.rlike(pattern(r"^\d+\.?\d*/\d+\.?\d*$")), v)
        .when(at_least.isNotNull(), F.concat(at_least, F.lit("/4.5")))
        .when(v.rlike(pattern(r"^\d+\.?\d*$")), F.concat(v, F.lit("/4.5")))
        .otherwise(v)
    )


def field(c: Column | str, default: str | None = None) -> Column:
    """C4: stripped value; null and blank give the default."""
    value = blank_to_null(c)
    return value if default is None else F.coalesce(value, F.lit(default))


def is_exchange(program_type: Column | str) -> Column:
    """C5, of a C4 value."""
    return F.coalesce(as_column(program_type), F.lit(V.DEFAULT_PROGRAM)).contains(V.EXCHANGE_WORD)


def is_visit(program_type: Column | str) -> Column:
    """C5, of a C4 value."""
    return F.coalesce(as_column(program_type), F.lit(V.DEFAULT_PROGRAM)).contains(V.VISIT_WORD)


def join_remarks(*parts: Column | str) -> Column:
    """C6, of C4 values: the non-null ones on separate lines, '' when there is none."""
    return F.concat_ws("\n", *[as_column(p) for p in parts])


def requirement_label(exam: Column | str, score: Column | str, code: Column | str) -> Column:
    """``EXAM score (code)``; whole scores without decimals."""
    score = as_column(score)
    shown = F.when(score == F.floor(score), score.cast("long").cast("string")).otherwise(
        score.cast("string")
    )
    code = F.nullif(as_column(code), F.lit(""))
    return F.concat_ws(" ", as_column(exam), shown, F.concat(F.lit("("), code, F.lit(")")))


def display_gpa(min_gpa: Column | str) -> Column:
    """C9."""
    g = as_column(min_gpa)
    return F.concat(
        F.lit("GPA: "), F.when(g.isNotNull() & (g != 0), g.cast("string")).otherwise("N/A")
    )


def display_programs(exchange: Column | str, visit: Column | str) -> Column:
    """C9."""
    return F.concat_ws(
        ", ", F.when(as_column(exchange), "Exchange"), F.when(as_column(visit), "Visiting")
    )


def display_text(c: Column | str, width: int = 30) -> Column:
    """The first characters of a long text for a report line."""
    return F.concat(F.coalesce(F.nullif(F.left(as_column(c), F.lit(width)), F.lit("")), F.lit("None")), F.lit("..."))


def gpa_number(c: Column | str) -> Column:
    """X11: first number, unless it fits no grading scale."""
    found = F.regexp_extract(as_column(c), pattern(r"(\d+\.?\d*)"), 1)
    n = fold_digits(found).try_cast("double")
    misfit = (n < 1) | ((n > 5) & (n < 70)) | (n > 100)
    return F.when(~misfit, n)


def first_url(c: Column | str) -> Column:
    """First address with protocol or ``www.``, else first bare domain."""
    t = as_column(c)
    tail = r"[^\s()\[\]{}]+"

    def first(regex: str) -> Column:
        return F.get(F.regexp_extract_all(t, F.lit(pattern(regex)), F.lit(0)), F.lit(0))

    marked = first(r"(?:https?://|www\.)" + tail)
    bare = first(WORD_EDGE + r"[a-zA-Z0-9-]+\.[a-zA-Z]{2,}(?:[/?#]" + tail + ")?" + WORD_EDGE)
    return F.regexp_replace(F.coalesce(marked, bare), "^(?!https?://)", "http://")


def review_year(c: Column | str) -> Column:
    """A year or a range of years."""
    return F.get(F.regexp_extract_all(as_column(c), F.lit(pattern(_YEARS)), F.lit(1)), F.lit(0))


def has_review(c: Column | str) -> Column:
    """A year anywhere, or a positive word at the start.

    The negative answers need no rule of their own: none of them is positive.
    """
    positive = r"\A\s*(?:" + "|".join(V.REVIEW_POSITIVE) + ")"
    found = as_column(c).rlike(pattern(f"{positive}|{_YEARS}", ignore_case=True))
    return F.coalesce(found, F.lit(False))


#: Stands between the name of a file and its folder where ``file`` holds both.
FOLDER_MARK = "\t"


def base_name(file: Column | str) -> Column:
    """The name of a file without its folder."""
    return F.substring_index(as_column(file), FOLDER_MARK, 1)


def file_semester(name: Column | str) -> Column:
    """``YYYY-T`` at the start of a file name, else anywhere in it."""
    name = base_name(name)

    def found(regex: str) -> Column:
        year, term = extract_or_null(name, regex, 1), extract_or_null(name, regex, 2)
        return F.concat(year, F.lit("-"), term)

    return F.coalesce(
        found("^" + V.SEMESTER_PATTERN), found(V.SEMESTER_PATTERN), F.lit(V.UNKNOWN)
    )


def is_summary_row(name: Column | str, nan_rule: bool = False) -> Column:
    """The name holds a word for totals; the ``nan`` rule is optional."""
    words = V.SUMMARY_WORDS + (["NAN"] if nan_rule else [])
    return contains_any(F.upper(as_column(name)), words)
