"""The registered queries against their SQL and, where there is none, against brute force."""

import hashlib

import pytest

import corpus_pipeline
from ledgerline.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm import brute
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_sql(spark, name):
    assert compare(spark, duck(SF_DIR), name, QUERIES[name], SF_DIR) is None


def test_documents_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    want = brute.near_copies(docs)
    got = QUERIES["op5_near_dup"].run(spark, SF_DIR).collect()
    assert {r.doc_id: (r.class_id, r.kept) for r in got} == {i: (c, c == i) for i, c in want.items()}
    spans = brute.repeated_spans(docs)
    for r in QUERIES["op10_passages"].run(spark, SF_DIR).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans) == spans[r.doc_id][:3]
        assert r.kept_sha256 == hashlib.sha256(spans[r.doc_id][3]).hexdigest()
    for r in QUERIES["op7_line_rules"].run(spark, SF_DIR).collect():
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == brute.line_counts(docs[r.doc_id])


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = QUERIES["op6_quality"].run(spark, SF_DIR).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.9 * len(got) > 0


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert out.count() > 0 and out.join(docs, "doc_id", "left_anti").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_duplicates", "repeated_passages", "packing"
    ]
