"""Rules, lines, mixing, toxicity and language against plain versions and held-out rows."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from compare import connect, difference
from fixtures import odd_documents, odd_rows, words
from hypothesis import given
from hypothesis import strategies as st

from sheetloom.llm import chat, language, line_dedup, mixing, quality_rules, queries, toxicity

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_against_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.CHECKS[name]) is None


def _features(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for i in range(len(found) - 2):
        places[tuple(found[i : i + 3])].append(i)
    repeated = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(found),
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_features_of_odd_rows(spark):
    """The long text has more windows than positions fit into packed hashes."""
    out = quality_rules.document_features(odd_documents(spark)).collect()
    got = Counter((r["id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out)
    assert got == Counter((r[0], *_features(r[1])) for r in odd_rows())


def test_bad_host_is_rejected(spark):
    good = [(i, words(i, 100), "en", f"good{i % 5}", 0) for i in range(100)]
    bad = [(1000 + i, words(i, 10), "en", "bad", 0) for i in range(60)] + [(2000, words(7, 100), "en", "bad", 0)]
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(odd_documents(spark, good + bad)).collect()}
    assert all(out[i]["kept"] for i in range(100))
    assert not out[2000]["base_failed"] and not out[2000]["kept"]
    assert out[2000]["host_rate"] > 0.8 > out[0]["host_rate"]


def test_a_small_host_is_shrunk(spark):
    """One failure of one document doesn't reject a host."""
    good = [(i, words(i, 100), "en", f"good{i % 5}", 0) for i in range(100)]
    out = quality_rules.quality_rules(odd_documents(spark, good + [(500, "short", "en", "new", 0)]))
    assert out.filter("doc_id = 500").first()["host_rate"] < 0.8


def test_lines_of_odd_ids(spark):
    line = "a line that is long enough to be counted at all"
    docs = [(i, f"  {line.upper()}\nown {i}", "en", "a", 0) for i in range(6)]
    docs += [(None, line, "en", "a", 0), (None, line + "\n" + line, "en", "a", 0), (5, line, "en", "a", 0)]
    out = line_dedup.dedup_lines(odd_documents(spark, docs)).collect()
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in out) == sorted(
        [(str(i), 2, 1, f"own {i}") for i in range(5)]
        + [("5", 2, 0, f"  {line.upper()}\nown 5"), ("5", 1, 0, line), ("None", 1, 1, ""), ("None", 2, 2, "")]
    )


def test_lines_below_the_threshold_stay(spark):
    line = "a line that is long enough to be counted at all"
    docs = [(i, line, "en", "a", 0) for i in range(4)] + [(i, "short line", "en", "a", 0) for i in range(10, 20)]
    assert {r["n_dropped"] for r in line_dedup.dedup_lines(odd_documents(spark, docs)).collect()} == {0}


def test_mix_targets_and_copies(spark):
    docs = [(i, words(i, 50 + i % 7), "en", f"s{i % 3}" if i % 10 else "tiny", 0) for i in range(600)]
    docs += [(9000 + i, words(i, 40), "en", None, 0) for i in range(50)]
    out = mixing.mix_documents(odd_documents(spark, docs)).collect()
    again = mixing.mix_documents(odd_documents(spark, docs[::-1])).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in out) == sorted((r["doc_id"], r["taken"]) for r in again)
    taken, target, size = defaultdict(int), {}, {}
    for r in out:
        key = (r["source_size"], r["target"])
        taken[key] += r["taken"]
        target[key], size[key] = r["target"], r["source_size"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6 and len(size) == 5
    assert all(abs(taken[k] - target[k]) <= 40 and target[k] <= 3 * size[k] + 1e-9 for k in target)
    mixed = mixing.sample_mix(odd_documents(spark, docs)).groupBy("doc_id").count().collect()
    copies = {r["doc_id"]: r["copies"] for r in out if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in mixed} == copies


def test_mix_prefers_affinity(spark):
    docs = [(i, words(i, 50), "en", "ab"[i % 2], 0) for i in range(400)]
    table = odd_documents(spark, docs).selectExpr("*", "IF(doc_id % 8 = 0, 3.0, 1.0) AS likes")
    out = mixing.mix_documents(table, affinity=table["likes"]).collect()
    liked = [r["copies"] for r in out if r["doc_id"] % 8 == 0]
    others = [r["copies"] for r in out if r["doc_id"] % 8 == 2]
    assert sum(liked) / len(liked) > 1.5 * sum(others) / len(others)


def test_toxic_words_are_learned(spark):
    docs = [(i, words(i, 60) + (" youidiotic fool" if i % 5 == 0 else ""), "en", "a", 0) for i in range(500)]
    docs += [(9000, None, None, None, None), (9001, "", None, None, None)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    table = odd_documents(spark, docs)
    out = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(table, toxicity.train_toxicity(table, labels)).collect()}
    assert all((out[i] >= 0.5) == (i % 5 == 0) for i in range(500))
    assert out[9000] == out[9001] < 0.5 and all(0 <= s <= 1 for s in out.values())


def test_toxicity_held_out(spark):
    rows = queries.op1_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] > 0.7 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) < 0.02 * n[0, 0]


def test_language_held_out(spark):
    rows = queries.op8_language(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = rows.filter("held_out").join(docs, "doc_id").selectExpr("avg(int(lang = lang_pred))").first()[0]
    assert right > 0.97


def test_mixture_of_two_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train_languages(docs)
    text = {r["lang"]: r["text"] for r in docs.filter("length(text) BETWEEN 2000 AND 4000").collect()}
    both = [(1, text["de"][:2000] + " " + text["es"][:2000]), (2, text["fr"][:2000]), (3, "12 ... 34"), (4, None)]
    out = {r["doc_id"]: r for r in language.detect_languages(spark.createDataFrame(both, "doc_id long, text string"), model).collect()}
    assert set(out[1]["shares"]) == {"de", "es"} and 0.4 < out[1]["score"] < 0.75
    assert out[2]["shares"] == {"fr": 1.0}
    assert out[3]["lang_pred"] == out[4]["lang_pred"] == "und" and out[3]["score"] == 0


@given(st.text(alphabet="\\#/<>turn :a", max_size=40))
def test_escapes_are_reversible(text):
    for controls in (chat.IN_TEXT, chat.IN_ROLE):
        shown = chat.escape(text, controls)
        assert chat.unescape(shown, controls) == text
        assert all(len(m[1]) % 2 for m in re.finditer(rf"(\\*)({controls})", shown))
