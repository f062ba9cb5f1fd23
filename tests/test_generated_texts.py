"""Texts that are put together from statements of known meaning: what is read must be what was said."""

import random

from pyspark.sql import functions as F

from sheetloom import vocabulary as V
from sheetloom.functions import fields as X
from sheetloom.functions import requirements as R
from sheetloom.operators.requirements import extract_requirements

#: Exam, how it may be written, and scores.
WRITTEN = {
    "TOEFL": (["TOEFL {}", "toefl iBT {}", "토플 {}", "TOEFL(iBT) {}"], [61, 80, 100]),
    "TOEFL_ITP": (["TOEFL ITP {}", "toefl pbt {}"], [500, 550]),
    "TOEIC": (["TOEIC {}", "토익{}"], [700, 850]),
    "IELTS": (["IELTS {}", "아이엘츠 {}"], [5.5, 6]),
    "DUOLINGO": (["Duolingo {}"], [95, 110]),
    "HSK": (["HSK {}급", "신HSK {}"], [4, 5]),
    "JLPT": (["JLPT N{}"], [1, 2, 3]),
    "JPT": (["JPT {}"], [600, 700]),
    "TOPIK": (["TOPIK {}급"], [3, 4]),
}
BETWEEN = [", ", " / ", "\n", " ; ", " 또는 "]
CODES = sorted({code for code, _, _, _ in V.STANDARDS if "_" not in code})


def _least(codes: list[str]) -> dict[str, tuple[float, str]]:
    """Exam -> the most lenient minimum of the codes, and the code that has it."""
    out: dict[str, tuple[float, str]] = {}
    for code, _, exam, score in V.STANDARDS:
        if code in codes:
            lenient = -score if exam in V.LOWER_IS_HARDER else score
            if exam not in out or (lenient, code) < (out[exam][2], out[exam][1]):
                out[exam] = (score, code, lenient)
    return {exam: row[:2] for exam, row in out.items()}


def _read(spark, texts: list[str], region: str | None = None) -> list[dict[str, tuple[float, str | None]]]:
    df = spark.createDataFrame([(i, t, region) for i, t in enumerate(texts)], "id int, language_requirement string, region string")
    out: list[dict] = [{} for _ in texts]
    for r in extract_requirements(df.repartition(8), keep=["id"]).collect():
        out[r.id][r.exam_type] = (r.min_score, r.level_code)
    return out


def _statements(dice: random.Random, n: int) -> tuple[list[str], dict[str, float]]:
    said, parts = {}, []
    for exam in dice.sample(list(WRITTEN), n):
        forms, scores = WRITTEN[exam]
        form = dice.choice(forms)  # of another spelling, the rule and not the place would decide
        for score in dice.sample(scores, dice.randint(1, 2)):  # the last one written holds
            said[exam] = float(score)
            parts.append((exam, form.format(score)))
    return [text for _, text in parts], said


def test_written_scores(spark):
    dice = random.Random(1)
    texts, wanted = [], []
    for _ in range(600):
        parts, said = _statements(dice, dice.randint(1, 4))
        texts.append("".join(p + dice.choice(BETWEEN) for p in parts).strip())
        wanted.append(said)
    for text, said, found in zip(texts, wanted, _read(spark, texts)):
        assert {exam: score for exam, (score, _) in found.items()} == said, text


def test_codes_and_written_scores_together(spark):
    dice = random.Random(2)
    plain = [c for c in CODES if c[0] not in "BC"]
    texts, wanted = [], []
    for _ in range(400):
        codes = dice.sample(plain, dice.randint(1, 2))
        parts, said = _statements(dice, dice.randint(0, 2))
        texts.append(dice.choice(BETWEEN).join([dice.choice([c, f"{c[0]}-{c[1:]}"]) for c in codes] + parts))
        expected = {exam: score for exam, (score, _) in _least(codes).items()}
        wanted.append((expected | said, {exam: code for exam, (_, code) in _least(codes).items()}))
    for text, (scores, levels), found in zip(texts, wanted, _read(spark, texts)):
        assert {exam: score for exam, (score, _) in found.items()} == scores, text
        assert all(found[exam][1] == code for exam, code in levels.items()), text


def test_codes_of_a_language_area(spark):
    for code, prefixes in (("B1", ["중국어 ", "중국권"]), ("C1", ["일본어", "일본권 "])):
        area = {"B": "CN_", "C": "JP_"}[code[0]]
        own = [p + code for p in prefixes] + [code]
        for text, found in zip(own, _read(spark, own)):
            assert {e: s for e, (s, _) in found.items()} == {e: s for e, (s, _) in _least([area + code]).items()}, text
    europe = [c for c, _, _, _ in V.STANDARDS if c.startswith("EU_")]
    texts = [f"유럽 {c[3:]}" for c in europe] + [f"어학 {c[3:]}" for c in europe] + europe
    for region, own in (("아시아", [*texts[: len(europe)], *texts[2 * len(europe) :]]), ("유럽", texts[len(europe) : 2 * len(europe)])):
        for text, code, found in zip(own, europe * 2, _read(spark, own, region)):
            assert {e: s for e, (s, _) in found.items()} == {e: s for e, (s, _) in _least([code]).items()}, (region, text)


def test_waivers_and_exclusions(spark):
    dice = random.Random(3)
    texts = []
    for _ in range(200):
        parts, _ = _statements(dice, 2)
        parts.insert(dice.randrange(len(parts) + 1), dice.choice(["면제", "어학성적 없음", "불필요"]))
        texts.append(", ".join(parts))
    assert not any(_read(spark, texts))
    for exclusion, exam in (("TOEIC 제외", "TOEIC"), ("토익 제외", "TOEIC"), ("ITP 제외", "TOEFL_ITP")):
        texts = [f"{code} ({exclusion})" for code in CODES if any(c == code and e == exam for c, _, e, _ in V.STANDARDS)]
        assert texts
        for text, found in zip(texts, _read(spark, texts)):
            left = set(_least([text.split()[0]])) - {exam}
            assert set(found) == left, text


def test_notes(spark):
    """Sentences begin with a Korean word, at which looking back for exams stops."""
    dice = random.Random(4)
    names = {"TOEFL": ["TOEFL", "toefl", "IBT"], "TOEFL_ITP": ["TOEFL ITP", "ITP", "TOEFL PBT"]}
    exams = [exam for exam, _ in V.EXAM_GROUPS if len(exam) < 10]
    notes, wanted = [], []
    for _ in range(800):
        said, sentences = set(), []
        for _ in range(dice.randint(1, 3)):
            own = dice.sample(exams, dice.randint(1, 3))
            word = dice.choice(["제외", "불가", "인정"])
            listed = dice.choice([", ", "/"]).join(dice.choice(names.get(e, [e])) for e in own)
            sentences.append(f"시험 {listed} {word}")
            said |= set(own) if word != "인정" else set()
        notes.append(dice.choice([". 그리고 ", "\n", " "]).join(sentences))
        wanted.append(sorted(said))
    # A sentence that excludes nothing must not lend its exams to the next one.
    df = spark.createDataFrame(list(enumerate(notes)), "id int, note string").repartition(8)
    got = {r.id: sorted(r.x) for r in df.select("id", R.note_exclusions("note").alias("x")).collect()}
    wrong = [(n, got[i], w) for i, (n, w) in enumerate(zip(notes, wanted)) if got[i] != w]
    assert not wrong, wrong[:3]


def test_addresses_in_their_surroundings(spark):
    dice = random.Random(5)
    rows = []
    for i in range(1500):
        path = dice.choice(["", "/in", "/a/b?q=1", "/x#top"])
        scheme = dice.choice(["http://", "https://", "www.", ""])
        # Without a scheme or www an address is read with two names at most.
        labels = [dice.choice(["abc", "u1", "inter-office", "example"]) for _ in range(dice.randint(1, 2) if scheme else 1)]
        host = ".".join(labels) + dice.choice([".edu", ".ac.kr", ".org"] if scheme else [".edu", ".org"])
        before, after = dice.choice(["", "홈페이지: ", "(", "[", "see "]), dice.choice(["", " (main)", ")", "]", "\n2", " 참조"])
        rows.append((i, before + scheme + host + path + after, (scheme if "//" in scheme else "http://" + scheme) + host + path))
    rows += [(2000, "없음", None), (2001, "3.5 / 4.5", None), (2002, "", None), (2003, None, None)]
    df = spark.createDataFrame(rows, "id int, t string, want string").repartition(8)
    wrong = df.withColumn("got", X.first_url("t")).filter(~F.col("got").eqNullSafe(F.col("want"))).limit(3).collect()
    assert not wrong, wrong


def test_white_space(spark):
    dice = random.Random(6)
    blanks = [" ", "\t", "\n", "　", "\x1c", "\xa0", " ", "\x0b"]
    rows = []
    for i in range(1500):
        words = [dice.choice(["a", "대학", "1.5", "é", "(x)"]) for _ in range(dice.randint(1, 5))]
        ends = ["".join(dice.choice(blanks) for _ in range(dice.randrange(3))) for _ in range(2)]
        gaps = ["".join(dice.choice(blanks) for _ in range(dice.randint(1, 3))) for _ in words[1:]] + [""]
        inside = "".join(w + g for w, g in zip(words, gaps))
        rows.append((i, ends[0] + inside + ends[1], " ".join(words), inside))
    df = spark.createDataFrame(rows, "id int, t string, flat string, inside string").repartition(8)
    wrong = df.filter(~(X.collapse_whitespace("t").eqNullSafe(F.col("flat")) & X.field("t").eqNullSafe(F.col("inside")))).limit(3).collect()
    assert not wrong, wrong
    only = spark.createDataFrame([("".join(blanks[:n]),) for n in range(1, 8)], "t string")
    assert only.filter(X.field("t").isNotNull() | (X.collapse_whitespace("t") != F.col("t"))).count() == 0


def test_grades_and_reviews(spark):
    rows = []
    for n in ("0.5", "1", "2.75", "3.0", "4", "5", "6.1", "69", "70", "85", "100", "120"):
        number = float(n) if 1 <= float(n) <= 5 or 70 <= float(n) <= 100 else None
        rows += [(n, number, f"{n}/4.5"), (f" {n} 이상", number, f"{n}/4.5"), (f"{n}이상/4.5", number, f"{n}/4.5"), (f"{n}/4.3", number, f"{n}/4.3")]
        rows.append((f"GPA {n}", number, f"GPA {n}"))
    rows += [("없음", None, "없음"), ("", None, None), ("  ", None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, number double, text string")
    out = df.select("*", X.gpa_number("t").alias("n"), X.normalise_gpa("t").alias("g"))
    wrong = out.filter(~(F.col("n").eqNullSafe(F.col("number")) & F.col("g").eqNullSafe(F.col("text")))).collect()
    assert not wrong, wrong
    reviews = [(f"{a}{y}{b}", True, y) for y in ("2013", "2018-2019", "2015 - 2016") for a, b in (("", ""), ("Y(", ")"), ("후기 ", ""))]
    reviews += [(w, True, None) for w in ("O", "yes", "있음", "Available", "Y (1999)")]
    reviews += [(w, False, None) for w in ("X", "n", "None", "-", " no ", "미확인", "", None, "1999")]
    df = spark.createDataFrame(reviews, "t string, has boolean, year string")
    out = df.select("*", X.has_review("t").alias("h"), X.review_year("t").alias("y"))
    wrong = out.filter(~(F.col("h").eqNullSafe(F.col("has")) & F.col("y").eqNullSafe(F.col("year")))).collect()
    assert not wrong, wrong
