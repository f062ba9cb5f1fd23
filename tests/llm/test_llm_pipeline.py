"""The pipeline against a plain version of its stages."""

from __future__ import annotations

import re

import corpus_pipeline
from fixtures import words
from test_llm_groups import plain_components, plain_fingerprint
from test_llm_text import _features

from sheetloom.llm import mixing

SF_DIR = "/root/testdata/sf0.001"


def test_pipeline_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for i, r in rows.items():
        n, _, _, _, repeats = _features(r["text"])
        if n >= 50 and 100 * repeats <= 50 * n:
            kept.append(i)
    prints = [(i, plain_fingerprint(rows[i]["text"])) for i in kept]
    kept = sorted(set(plain_components(prints)))
    bench = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    plain = lambda t: f" {' '.join(re.findall(r'[^\W_]+', t.lower()))} "
    kept = [i for i in kept if not any(plain(t) in plain(rows[i]["text"]) for t in bench)]
    mix = mixing.mix_documents(spark.createDataFrame([rows[i] for i in kept], docs.schema))
    copies = {r["doc_id"]: r["copies"] for r in mix.collect() if r["copies"]}
    found = {i for r in corpus_pipeline.run(spark, SF_DIR).collect() for i in r["doc_ids"]}
    assert found == set(copies)


def test_stages_return_documents(spark):
    docs = spark.createDataFrame(
        [(i, words(i // 2, 80), "en", f"s{i % 3}", 5) for i in range(20)] + [(None, None, None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() > 0
    assert [s for s, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None
