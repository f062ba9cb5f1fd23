"""Every operator on unusual and on empty tables: a row per input row, and nothing else changed."""

from __future__ import annotations

import pytest
from fixtures import SCHEMA, odd_documents, odd_rows

from sheetloom.llm import chat, decontaminate, html_extract, language, line_dedup, mixing, quality_rules, simhash
from sheetloom.llm import token_shards, toxicity

BENCH = [(0, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (1, None), (2, ""), (None, "negative id here")]


def _bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


def _toxic(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (8, 0), (9, None), (None, 1)], "doc_id long, toxic int")
    return toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels))


RUNS = {
    "toxicity": _toxic,
    "quality": lambda spark, docs: quality_rules.quality_rules(docs),
    "simhash": lambda spark, docs: simhash.simhash_components(docs),
    "leaks": lambda spark, docs: decontaminate.find_leaks(docs, _bench(spark)),
    "mixing": lambda spark, docs: mixing.mix_documents(docs),
    "language": lambda spark, docs: language.detect_languages(docs, language.train_languages(docs)),
    "lines": lambda spark, docs: line_dedup.dedup_lines(docs),
}
TABLES = {
    "simhash_dedup": lambda spark, docs: simhash.simhash_dedup(docs),
    "decontaminate": lambda spark, docs: decontaminate.decontaminate(docs, _bench(spark)),
    "sample_mix": lambda spark, docs: mixing.sample_mix(docs),
}


@pytest.mark.parametrize("name", RUNS)
def test_one_row_per_row(spark, name):
    rows = odd_rows()
    out = RUNS[name](spark, odd_documents(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("name", RUNS)
def test_repeated_rows_agree(spark, name):
    out = [r.asDict() for r in RUNS[name](spark, odd_documents(spark)).collect() if r["doc_id"] == 2]
    assert len(out) == 2
    if name != "mixing":
        assert out[0] == out[1]


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(spark, name):
    assert RUNS[name](spark, odd_documents(spark, [])).count() == 0


@pytest.mark.parametrize("name", TABLES)
def test_tables_keep_their_columns(spark, name):
    docs = odd_documents(spark)
    out = TABLES[name](spark, docs)
    assert out.columns == docs.columns and out.count() > 0
    assert TABLES[name](spark, odd_documents(spark, [])).count() == 0
    known = {tuple(map(str, r)) for r in docs.collect()}
    assert {tuple(map(str, r)) for r in out.collect()} <= known


def test_documents_without_words(spark):
    docs = spark.createDataFrame([(i, None, None, None, None) for i in range(3)], SCHEMA)
    assert {r["kept"] for r in quality_rules.quality_rules(docs).collect()} == {False}
    found = simhash.simhash_components(docs).collect()
    assert {(r["fingerprint"], r["component_id"]) for r in found} == {("0" * 16, 0)}
    assert simhash.simhash_dedup(docs).count() == 1
    assert {r["taken"] for r in mixing.mix_documents(docs).collect()} == {0}
    assert {r["lang_pred"] for r in RUNS["language"](spark, docs).collect()} == {"und"}
    assert {r["text"] for r in line_dedup.dedup_lines(docs).collect()} == {""}
    assert not any(r["contaminated"] for r in RUNS["leaks"](spark, docs).collect())


def test_empty_pages_and_conversations(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract_main_text(pages).count() == 0
    talks = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_turns(talks)).count() == 0


def test_shards_of_empty_table(spark):
    folder = token_shards.new_folder(spark)
    assert token_shards.write_training_order(odd_documents(spark, []), folder).count() == 0
    assert token_shards.read_training_order(spark, folder).count() == 0
