"""What is sent and compared where one group is very large."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import common, near_dup, passages
from ledgerline.llm.common import components
from tests.llm import brute
from tests.llm.test_operators import DOCS, sentence


def test_rows_sent_grow_with_members_and_outsiders(spark):
    members = spark.range(5_000).selectExpr("7L AS band", "id AS node", "100L + id % 50 AS n", "0L AS component")
    outside = spark.range(20).selectExpr("7L AS band", "10000 + id AS node", "120L AS n", "10000 + id AS component")
    far = spark.range(3_000).selectExpr("7L AS band", "20000 + id AS node", "900L AS n", "0L AS component")
    rows = near_dup.shipped(members.unionByName(outside).unionByName(far), 0.8, 512)
    sent = {r.what: r.n for r in rows.groupBy(F.when(F.col("component") > 0, "outside").otherwise("inside").alias("what")).agg(F.count("*").alias("n")).collect()}
    # one block of outsiders, sixteen of the large component, whose far members stay at home
    assert sent == {"inside": 5_000, "outside": 20 * 17}
    met = rows.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).distinct().collect()
    assert all(r.i == 0 for r in met)


def test_outsiders_of_a_giant_group_find_their_links(spark):
    r = random.Random(4)
    words = sentence(31, 60).split()
    texts = {}
    for i in range(300):  # one word changed, each elsewhere or otherwise
        own = list(words)
        own[r.randrange(60)] = f"w{i}"
        texts[i] = " ".join(own)
    for i in range(300, 330):  # several words changed: near some, far from others
        own = list(words)
        for place in r.sample(range(60), r.choice([1, 2, 2, 3])):
            own[place] = f"v{i}"
        texts[i] = " ".join(own)
    want = brute.near_copies(texts)
    docs = spark.createDataFrame([(i, t, "") for i, t in texts.items()], DOCS).repartition(3)
    got = {r.doc_id: r.class_id for r in near_dup.near_copies(docs).collect()}
    assert got == want


def test_ids_with_several_texts_chain_their_copies(spark):
    a, b = sentence(41, 40), sentence(42, 40)
    docs = spark.createDataFrame([(9, a, ""), (5, a, ""), (5, b, ""), (2, b, ""), (7, sentence(43, 40), "")], DOCS)
    got = {(r.doc_id, r.class_id) for r in near_dup.near_copies(docs).collect()}
    assert got == {(9, 2), (5, 2), (2, 2), (7, 7)}


def test_later_links_join_what_was_found(spark):
    edges = [(i, i + 2) for i in range(40)] + [(100, 101)]
    links = spark.createDataFrame(edges, "a long, b long")
    labels = components(links, "a", "b")
    more = spark.createDataFrame([(39, 100), (7, 8), (300, 301), (301, 5)], "a long, b long")
    got = {r.node: r.component for r in near_dup.joined(labels, more).collect()}
    assert got == {n: 0 for n in [*range(42), 100, 101, 300, 301]}
    none = spark.createDataFrame([], "a long, b long")
    assert near_dup.joined(components(none, "a", "b"), none).count() == 0


def test_hashes_are_compared_range_by_range(monkeypatch):
    """What a task holds to compare is bounded by the range, not by its share of all hashes."""
    r = np.random.default_rng(2)
    hashes = [np.sort(r.integers(0, 4_000, n).astype(np.uint64)) for n in (0, 3_000, 1, 2_000)]
    marks = [(r.integers(-9, 9, 5), r.integers(0, 5, len(h))) for h in hashes]
    held = {}
    for h, (mark, place) in zip(hashes, marks):
        for x, m in zip(h.tolist(), mark[place].tolist()):
            held.setdefault(x, set()).add(m)
    monkeypatch.setattr(passages, "RANGE", 300)
    most, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *rest, **more: most.append(len(x)) or sort(x, *rest, **more))
    got = passages.in_two_texts(hashes, marks, 4_000)
    assert [g.tolist() for g in got] == [[len(held[x]) > 1 for x in h.tolist()] for h in hashes]
    assert max(most) < 600


def test_stages_give_their_python_tasks_few_rows_at_a_time(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    before = spark.conf.get(common.ARROW_ROWS)
    try:
        for given, want in ((10_000, common.BATCH_ROWS), (0, common.BATCH_ROWS), (7, 7)):
            spark.conf.set(common.ARROW_ROWS, given)
            corpus_pipeline.near_duplicates(spark, docs, "")
            assert int(spark.conf.get(common.ARROW_ROWS)) == want
    finally:
        spark.conf.set(common.ARROW_ROWS, before)
