"""Score requirements in mixed Korean and English text.

Every function maps columns of one row to a column of the same row, so the
whole extraction is a narrow job: no join, no shuffle, no Python worker.
"""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions.text import (
    HANGUL,
    as_column,
    contains_any,
    fold_digits,
    matches_any,
    pattern,
    standalone_pattern,
)

_HIT_TYPE = "array<struct<exam_type:string,raw:string,score:double>>"


def _standard_sql(code: str, category: str, exam: str, score: float) -> str:
    """One minimum as a literal; the lowest ``rank`` is the most lenient."""
    rank = -score if exam in V.LOWER_IS_HARDER else score
    return (
        f"named_struct('exam_type', '{exam}', 'rank', {rank}D, 'code', '{code}', "
        f"'score', {score}D, 'category', '{category}')"
    )


_STANDARDS_SQL = "map({})".format(
    ", ".join(
        f"'{code}', array({', '.join(_standard_sql(*row) for row in rows)})"
        for code, rows in groupby(V.STANDARDS, key=lambda row: row[0])
    )
)


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def is_waived(upper: Column | str, mode: str = "legacy") -> Column:
    """No text, or a phrase that waives the requirement.

    ``legacy`` finds ``NA`` anywhere, also inside words such as "final";
    ``bounded`` wants it to stand alone.
    """
    if mode not in ("legacy", "bounded"):
        raise ValueError(f"unknown waiver mode: {mode}")
    t = as_column(upper)

    def waives(names: list[str], regex: str) -> Column:
        if mode == "bounded" and regex == r"N/?A":
            regex = standalone_pattern(regex)
        return contains_any(t, names) & t.rlike(pattern(regex))

    return t.isNull() | reduce(lambda a, b: a | b, [waives(*rule) for rule in V.WAIVER_RULES])


def text_exclusions(upper: Column | str) -> Column:
    """Exams that an upper-cased requirement text itself rules out, sorted."""
    t = as_column(upper)
    exams = sorted({exam for _, exam in V.TEXT_EXCLUSIONS})
    flags = [
        F.when(matches_any(t, [r for r, e in V.TEXT_EXCLUSIONS if e == exam]), exam)
        for exam in exams
    ]
    return F.when(t.contains("제외"), F.array_compact(F.array(*flags))).otherwise(_no_strings())


def grade_codes(upper: Column | str, region: Column | str) -> Column:
    """Codes of the standards table named in an upper-cased text, sorted."""
    t = as_column(upper)
    known = sorted({code for code, *_ in V.STANDARDS})
    european = [code for code in known if code.startswith("EU_")]
    in_europe = F.coalesce(as_column(region).contains(V.EUROPE), F.lit(False)) | t.contains(V.EUROPE)

    def found(regex: str, gate: str | None = None) -> Column:
        matches = F.regexp_extract_all(t, F.lit(pattern(regex)), F.lit(1))
        return matches if gate is None else F.when(t.contains(gate), matches).otherwise(_no_strings())

    def prefixed(gate: str, regex: str, prefix: str) -> Column:
        return F.transform(found(regex, gate), lambda g: F.concat(F.lit(prefix), g))

    def standalone(grade: Column) -> Column:
        euro = F.concat(F.lit("EU_"), grade)
        return (
            F.when(in_europe & euro.isin(european), euro)
            .when(grade.startswith("B"), F.concat(F.lit("CN_"), grade))
            .when(grade.startswith("C"), F.concat(F.lit("JP_"), grade))
            .otherwise(grade)
        )

    bare = F.transform(
        found("(" + standalone_pattern("[A-E]-?[1-5]") + ")"),
        lambda g: F.replace(g, F.lit("-"), F.lit("")),
    )
    named = F.concat(
        found("(" + standalone_pattern("EU_[A-E][1-5]") + ")", "EU_"),
        prefixed("유럽", r"유럽(?:권)?\s*([A-E]-?[1-5])", "EU_"),
        prefixed("중국", r"중국(?:어)?(?:권)?\s*(B-?[1-3])", "CN_"),
        prefixed("일본", r"일본(?:어)?(?:권)?\s*(C-?[1-2])", "JP_"),
        F.transform(bare, standalone),
    )
    plain = F.transform(named, lambda c: F.replace(c, F.lit("-"), F.lit("")))
    codes = F.array_sort(F.array_distinct(F.filter(plain, lambda c: c.isin(known))))
    return F.coalesce(codes, _no_strings())


def code_rows(codes: Column | str) -> Column:
    """X5 within the row: the exam minimums behind each code."""
    standards = F.expr(_STANDARDS_SQL)
    return F.flatten(F.transform(as_column(codes), lambda c: F.try_element_at(standards, c)))


def level_value(token: Column, scale: str) -> Column:
    """Position of a level on one of the three scales, 0.0 when unknown."""
    pairs = [F.lit(x) for pair in V.LEVEL_SCALES[scale] for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(token)), F.lit(0.0))


def direct_hits(text: Column | str, upper: Column | str) -> Column:
    """Every score written out in the text, in rule order then text order.

    A rule's regular expression runs only on texts that hold one of its names.
    """
    t, u = as_column(text), as_column(upper)
    nothing = F.array().cast(_HIT_TYPE)

    def hits(exam: str, scale: str | None, names: list[str], regex: str) -> Column:
        group = 1 if scale is None else 0
        found = F.regexp_extract_all(t, F.lit(pattern(regex, ignore_case=True)), F.lit(group))

        def hit(match: Column) -> Column:
            if scale is None:
                raw = match
                score = fold_digits(F.replace(match, F.lit(","), F.lit(""))).try_cast("double")
            else:
                raw = F.element_at(F.split(match, pattern(r"\s+")), -1)
                score = level_value(raw, scale)
            return F.struct(F.lit(exam).alias("exam_type"), raw.alias("raw"), score.alias("score"))

        return F.when(contains_any(u, names), F.transform(found, hit)).otherwise(nothing)

    found = F.concat(*[hits(*rule) for rule in V.SCORE_RULES])
    return F.coalesce(F.filter(found, lambda h: h["score"].isNotNull()), nothing)


def exam_evidence(rows: Column | str, hits: Column | str, excluded: Column | str) -> Column:
    """First half of X7: per exam, the code row and the written scores that count.

    The most lenient code minimum counts (the highest number where lower is
    harder); of the written scores the first and the last.
    """
    rows, hits, excluded = as_column(rows), as_column(hits), as_column(excluded)

    def evidence(exam: Column) -> Column:
        base = F.array_min(F.filter(rows, lambda r: r["exam_type"] == exam))
        written = F.filter(hits, lambda h: h["exam_type"] == exam)
        return F.struct(exam.alias("exam"), base.alias("base"), written.alias("written"))

    exams = F.concat(
        F.transform(rows, lambda r: r["exam_type"]), F.transform(hits, lambda h: h["exam_type"])
    )
    return F.transform(F.array_except(exams, excluded), evidence)


def english_code(rows: Column | str) -> Column:
    """The English code with the lowest TOEFL minimum."""
    english = F.filter(
        as_column(rows), lambda r: (r["category"] == "ENGLISH") & (r["exam_type"] == "TOEFL")
    )
    return F.array_min(english)["code"]


def merge_scores(evidence: Column | str, fallback_code: Column | str) -> Column:
    """One entry per exam.

    The last written score replaces the code's minimum but keeps the code.  A
    written score without a code row takes the level that was written first,
    or, for an English exam, the fallback code.
    """
    groups = F.create_map(*[F.lit(x) for pair in V.EXAM_GROUPS for x in pair])
    levelled = sorted({exam for exam, scale, *_ in V.SCORE_RULES if scale})
    fallback = as_column(fallback_code)

    def entry(e: Column) -> Column:
        exam, base, written = e["exam"], e["base"], e["written"]
        group = F.try_element_at(groups, exam)
        level = F.when(exam.isin(levelled), F.try_element_at(written, F.lit(1))["raw"]).when(
            group == "ENGLISH", fallback
        )
        return F.struct(
            exam.alias("exam_type"),
            F.coalesce(F.try_element_at(written, F.lit(-1))["score"], base["score"]).alias("min_score"),
            F.when(base.isNotNull(), base["code"]).otherwise(level).alias("level_code"),
            F.coalesce(base["category"], group).alias("language_group"),
            F.when(F.size(written) == 0, "code")
            .when(base.isNull() & (F.size(written) == 1), "direct")
            .otherwise("direct_override")
            .alias("source"),
        )

    return F.transform(as_column(evidence), entry)


def note_exclusions(note: Column | str) -> Column:
    """Exams that a note rules out, sorted.

    For each exclusion word the fifty characters before it are read backwards
    by word; a Korean word that names no exam ends the reading.
    """
    n = F.upper(as_column(note))
    for old, new in V.NOTE_REWRITES:
        n = F.replace(n, F.lit(old), F.lit(new))
    # In the reversed note the window is what follows the word, which a
    # look-ahead captures in one pass; windows may overlap.
    words = "|".join(word[::-1] for word in V.NOTE_EXCLUSION_WORDS)
    following = f"(?s)(?:{words})(?=(.{{0,{V.NOTE_WINDOW}}}))"
    windows = F.when(
        contains_any(as_column(note), V.NOTE_EXCLUSION_WORDS),
        F.regexp_extract_all(F.reverse(n), F.lit(following), F.lit(1)),
    )
    exams = [exam for exam, _ in V.EXAM_GROUPS]
    stop = "."

    def meaning(token: Column) -> Column:
        return (
            F.when(token.isin(exams), token)
            .when(token.contains("ITP"), "TOEFL_ITP")
            .when(token.contains("IBT"), "TOEFL")
            .when(token.rlike(HANGUL), stop)
            .otherwise("")
        )

    def meanings(window: Column) -> Column:
        tokens = F.reverse(F.split(F.reverse(window), r"(?U)[,/\s\x1c-\x1f()\[\]]+"))
        return F.transform(tokens, meaning)

    def until_stop(found: Column) -> Column:
        end = F.array_position(found, stop)
        return F.slice(found, F.lit(1), F.when(end > 0, end - 1).otherwise(F.size(found)).cast("int"))

    found = F.flatten(F.transform(F.transform(windows, meanings), until_stop))
    named = F.array_distinct(F.filter(found, lambda m: m != ""))
    return F.coalesce(F.array_sort(named), _no_strings())
