"""Building blocks of the checking SQL.

They compute the operators a second time, with joins and windows and in another
regular-expression dialect, from the same inputs.
"""

from __future__ import annotations

from sheetloom import vocabulary as V

WORD = r"[^\p{L}\p{N}_]"


def strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288))"


def field(x: str, default: str | None = None) -> str:
    value = f"nullif({strip(x)}, '')"
    return value if default is None else f"coalesce({value}, '{default}')"


def values(rows: list[tuple], names: str) -> str:
    def lit(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({names}))"


def find(x: str, regex: str, group: int = 0) -> str:
    return f"nullif(regexp_extract({x}, '{regex}', {group}), '')"


def gpa_number(x: str) -> str:
    n = f"TRY_CAST({find(strip(x), r'([0-9]+\.?[0-9]*)', 1)} AS DOUBLE)"
    return f"CASE WHEN {n} >= 1 AND {n} <= 100 AND NOT ({n} > 5 AND {n} < 70) THEN {n} END"


def gpa_text(x: str) -> str:
    v = field(x)
    return (
        f"CASE WHEN regexp_full_match({v}, '[0-9]+\\.?[0-9]*/[0-9]+\\.?[0-9]*') THEN {v} "
        f"WHEN regexp_matches({v}, '[0-9]\\.?[0-9]*\\s*이상') THEN {find(v, r'([0-9]+\.?[0-9]*)\s*이상', 1)} || '/4.5' "
        f"WHEN regexp_full_match({v}, '[0-9]+\\.?[0-9]*') THEN {v} || '/4.5' ELSE {v} END"
    )


def url(x: str) -> str:
    """Inputs hold no text on which a trailing word edge would need backtracking."""
    tail = r"[^\s()\[\]{}]+"
    marked = find(strip(x), r"(https?://|www\.)" + tail)
    bare = find(strip(x), r"[a-zA-Z0-9][a-zA-Z0-9-]*\.[a-zA-Z]{2,}([/?#]" + tail + r"\b)?")
    found = f"coalesce({marked}, {bare})"
    return f"CASE WHEN regexp_matches({found}, '^https?://') THEN {found} ELSE 'http://' || {found} END"


def review_year(x: str) -> str:
    v = field(x)
    return (
        f"CASE WHEN upper({v}) NOT IN ('X', 'N', 'NO', 'NONE', '-') "
        f"THEN {find(v, r'(20[0-9]{2}(\s*-\s*20[0-9]{2})?)', 1)} END"
    )


def has_review(x: str) -> str:
    v = field(x)
    return (
        f"coalesce(upper({v}) NOT IN ('X', 'N', 'NO', 'NONE', '-') AND (regexp_matches({v}, '20[0-9]{{2}}') "
        f"OR regexp_matches(upper({v}), '^(Y|O|YES|TRUE|AVAILABLE|있음|후기|수기)')), false)"
    )


def remarks(a: str, b: str) -> str:
    return f"concat_ws(chr(10), {field(a)}, {field(b)})"


def collapse(x: str) -> str:
    space = r"[\s\x{a0}\x{3000}]+"
    flat = f"trim(regexp_replace({x}, '{space}', ' ', 'g'))"
    return f"CASE WHEN {flat} <> '' THEN {flat} ELSE {x} END"


def region_fill(region: str, mapped: str) -> str:
    own = field(region, V.UNCLASSIFIED)
    return f"CASE WHEN {own} = '{V.UNCLASSIFIED}' THEN coalesce({mapped}, {own}) ELSE {own} END"


# The checking side's own patterns of written scores, in the order of their precedence.
_GAP = r"[\t\n\f\r ]*"
_DIGITS, _GROUPED, _DECIMAL = "([0-9]+)", "([0-9,]+)", r"([0-9]+[.]?[0-9]*)"
SCORES = [
    ("TOEFL", None, f"toefl{_GAP}(?:[(]ibt[)]|ibt)?{_GAP}{_DIGITS}"),
    ("TOEFL_ITP", None, f"toefl{_GAP}(?:itp|pbt){_GAP}{_DIGITS}"),
    ("TOEFL", None, f"토플{_GAP}(?:ibt)?{_GAP}{_DIGITS}"),
    ("TOEIC", None, f"toeic{_GAP}{_GROUPED}"),
    ("TOEIC", None, f"토익{_GAP}{_GROUPED}"),
    ("IELTS", None, f"(?:ielts|itelts|iets){_GAP}{_DECIMAL}"),
    ("IELTS", None, f"아이엘츠{_GAP}{_DECIMAL}"),
    ("DUOLINGO", None, f"duolingo{_GAP}{_DIGITS}"),
    ("HSK", None, f"hsk{_GAP}{_DIGITS}"),
    ("HSK", None, f"hsk{_GAP}{_DIGITS}"),
    ("JLPT", None, f"jlpt{_GAP}n{_DIGITS}"),
    ("JPT", None, f"jpt{_GAP}{_GROUPED}"),
    ("DELF", "general", f"delf{_GAP}[abce][0-9]?"),
    ("ZD", "general", f"zd{_GAP}[abce][0-9]?"),
    ("DELE", "dele", f"dele{_GAP}[a-c][12]"),
    ("CELI", "italian", f"celi{_GAP}[a-c][12]"),
    ("CILS", "italian", f"cils{_GAP}[a-c][12]"),
    ("TOPIK", None, f"topik{_GAP}{_DIGITS}"),
]


def requirement_ctes(source: str, bounded: bool = False, prefix: str = "") -> str:
    """CTEs from ``source(id, text, region)``; the last one is ``req``."""
    p = prefix
    na = rf"(?i)(^|{WORD})N/?A($|{WORD})" if bounded else "(?i)N/?A"
    rules = []
    for i, (exam, scale, regex) in enumerate(SCORES):
        group = 1 if scale is None else 0
        if scale is None:
            raw, score = "m", "TRY_CAST(replace(m, ',', '') AS DOUBLE)"
        else:
            raw = r"string_split_regex(m, '\s+')[-1]"
            score = f"coalesce((SELECT v.value FROM {p}levels v WHERE v.scale = '{scale}' AND v.level = upper({raw})), 0.0)"
        rules.append(
            f"SELECT id, '{exam}' AS exam, {i} * 100000 + nth AS pos, {raw} AS raw, CAST({score} AS DOUBLE) AS score FROM ("
            f"SELECT id, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS nth FROM ("
            f"SELECT id, regexp_extract_all(t, '(?i){regex}', {group}) AS ms FROM {p}opened) x) y"
        )
    standards = [(code, cat, exam, score) for code, cat, exam, score in V.STANDARDS]
    levels = [(s, l, v) for s, pairs in V.LEVEL_SCALES.items() for l, v in pairs]
    euro = f"(contains(coalesce(region, ''), '유럽') OR contains(t, '유럽'))"
    grade = r"([A-E](?:--)?[1-5])"
    return f"""
    {p}levels AS {values(levels, 'scale, level, value')},
    {p}standards AS {values(standards, 'code, category, exam, score')},
    {p}groups AS {values(V.EXAM_GROUPS, 'exam, grp')},
    {p}opened AS (SELECT id, {strip('text')} AS t, region FROM ({source}) s
        WHERE {field('text')} IS NOT NULL
          AND NOT regexp_matches(text, '(?i)어학\\s*성적?\\s*없음|면제|불필요') AND NOT regexp_matches(text, '{na}')),
    {p}gone AS (SELECT id, 'TOEIC' AS exam FROM {p}opened WHERE regexp_matches(t, '(?i)(TOEIC|토익)[^가-힣]*제외')
        UNION SELECT id, 'TOEFL_ITP' FROM {p}opened WHERE regexp_matches(t, '(?i)ITP[^가-힣]*제외')),
    {p}doubled AS (SELECT id, {euro} AS euro, upper(t) AS u,
        regexp_replace(upper(t), '({WORD})', '\\1\\1', 'g') AS d FROM {p}opened),
    {p}plain AS (SELECT id, euro, replace(unnest(regexp_extract_all(d, '(?:^|{WORD}){grade}(?:$|{WORD})', 1)), '-', '') AS g FROM {p}doubled),
    {p}named AS (
        SELECT id, unnest(regexp_extract_all(d, '(?:^|{WORD})(EU_[A-E][1-5])(?:$|{WORD})', 1)) AS code FROM {p}doubled
        UNION SELECT id, 'EU_' || replace(unnest(regexp_extract_all(u, '유럽(?:권)?\\s*([A-E]-?[1-5])', 1)), '-', '') FROM {p}doubled
        UNION SELECT id, 'CN_' || replace(unnest(regexp_extract_all(u, '중국(?:어)?(?:권)?\\s*(B-?[1-3])', 1)), '-', '') FROM {p}doubled
        UNION SELECT id, 'JP_' || replace(unnest(regexp_extract_all(u, '일본(?:어)?(?:권)?\\s*(C-?[1-2])', 1)), '-', '') FROM {p}doubled
        UNION SELECT id, CASE WHEN euro AND EXISTS (SELECT 1 FROM {p}standards s WHERE s.code = 'EU_' || g) THEN 'EU_' || g
                  WHEN g[1] = 'B' THEN 'CN_' || g WHEN g[1] = 'C' THEN 'JP_' || g ELSE g END FROM {p}plain),
    {p}codes AS (SELECT DISTINCT id, code FROM {p}named WHERE code IN (SELECT code FROM {p}standards)),
    {p}coded AS (SELECT c.id, s.* FROM {p}codes c JOIN {p}standards s USING (code)),
    {p}best AS (SELECT id, exam, score, code, category FROM (
        SELECT *, row_number() OVER (PARTITION BY id, exam ORDER BY CASE WHEN exam = 'JLPT' THEN -score ELSE score END, code) AS rn
        FROM {p}coded) b WHERE rn = 1),
    {p}english AS (SELECT id, arg_min(code, score) AS code FROM {p}coded WHERE category = 'ENGLISH' AND exam = 'TOEFL' GROUP BY id),
    {p}hits AS ({' UNION ALL '.join(rules)}),
    {p}written AS (SELECT id, exam, arg_max(score, pos) AS score, arg_min(raw, pos) AS raw, count(*) AS n
        FROM {p}hits WHERE score IS NOT NULL GROUP BY id, exam),
    {p}req AS (SELECT coalesce(b.id, w.id) AS id, coalesce(b.exam, w.exam) AS exam_type,
            CAST(coalesce(w.score, b.score) AS DOUBLE) AS min_score,
            CASE WHEN b.id IS NOT NULL THEN b.code WHEN w.exam IN ('DELF', 'ZD', 'DELE', 'CELI', 'CILS') THEN w.raw
                 WHEN g.grp = 'ENGLISH' THEN e.code END AS level_code,
            coalesce(b.category, g.grp) AS language_group,
            CASE WHEN w.id IS NULL THEN 'code' WHEN b.id IS NULL AND w.n = 1 THEN 'direct' ELSE 'direct_override' END AS source
        FROM {p}best b FULL OUTER JOIN {p}written w ON b.id = w.id AND b.exam = w.exam
             LEFT JOIN {p}groups g ON g.exam = coalesce(b.exam, w.exam)
             LEFT JOIN {p}english e ON e.id = coalesce(b.id, w.id)
        WHERE NOT EXISTS (SELECT 1 FROM {p}gone x WHERE x.id = coalesce(b.id, w.id) AND x.exam = coalesce(b.exam, w.exam)))"""


def exclusion_ctes(source: str, prefix: str = "") -> str:
    """CTEs from ``source(id, note)``; the last one is ``banned(id, exam)``."""
    p = prefix
    exams = ", ".join(f"'{e}'" for e, _ in V.EXAM_GROUPS)
    return f"""
    {p}notes AS (SELECT id, replace(replace(replace(upper(note), 'TOEFL ITP', 'TOEFL_ITP'), 'TOEFL PBT', 'TOEFL_ITP'), 'TOEFL IBT', 'TOEFL') AS n
        FROM ({source}) s WHERE note IS NOT NULL),
    {p}pieces AS (SELECT id, n, string_split_regex(n, '제외|불가') AS ps FROM {p}notes WHERE regexp_matches(n, '제외|불가')),
    {p}ends AS (SELECT id, n, unnest(list_transform(range(1, len(ps)),
            lambda i: list_sum(list_transform(ps[1:i], lambda q: length(q))) + 2 * (i - 1))) AS e FROM {p}pieces),
    {p}windows AS (SELECT id, e, right(left(n, CAST(e AS BIGINT)), 50) AS w FROM {p}ends),
    {p}tokens AS (SELECT id, e, unnest(ts) AS k, unnest(range(1, len(ts) + 1)) AS i
        FROM (SELECT id, e, string_split_regex(w, '[,/\\s()\\[\\]]+') AS ts FROM {p}windows) x),
    {p}judged AS (SELECT *, CASE WHEN k IN ({exams}) THEN k WHEN contains(k, 'ITP') THEN 'TOEFL_ITP'
            WHEN contains(k, 'IBT') THEN 'TOEFL' WHEN regexp_matches(k, '[가-힣]') THEN '!' ELSE '' END AS m FROM {p}tokens),
    {p}banned AS (SELECT DISTINCT id, m AS exam FROM (
        SELECT *, max(CASE WHEN m = '!' THEN i ELSE 0 END) OVER (PARTITION BY id, e) AS stop FROM {p}judged) j
        WHERE i > stop AND m NOT IN ('', '!'))"""
