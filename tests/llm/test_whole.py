"""Cases in which an operator or a stage once did less than the whole job."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import line_rules, lm_score, quality_model
from ledgerline.llm.common import whole_rows
from ledgerline.llm.attention import Vocabulary
from tests.llm.test_operators import DOCS, LABELS, sentence


def shouts(seed, n):
    r = random.Random(seed)
    return "\n".join(f"BUY NOW!! ### $$$ {sentence(r.random(), 4).upper()}" for _ in range(n))


def wares(seed, n):
    r = random.Random(seed)
    return "\n".join(" ".join(r.choice(["casino", "bonus", "click", "pills", "cheap"]) + r.choice("xyz") for _ in range(10)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of tables: labelled good (below 100) and bad (to 200) documents, and from 200 on bad ones without a
    label, whose lines are content, so that the line rules keep them."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    given = [(i, sentence(i, 80) + ".\n" + sentence(i + 1, 60), "") for i in range(100)]
    given += [(i, shouts(i, 12) + "\n" + wares(i, 4), "") for i in range(100, 200)]
    given += [(i, wares(i, 12), "") for i in range(200, 220)]
    spark.createDataFrame(given, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 100), 0) for i in range(200)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return folder


def test_each_quality_stage_decides_on_its_own_input(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    ruled = corpus_pipeline.quality_rules(spark, docs, corpus).localCheckpoint()
    kept = {r.doc_id for r in ruled.collect()}
    assert kept == {*range(100), *range(200, 220)}
    assert {r.doc_id for r in corpus_pipeline.quality_classifier(spark, ruled, corpus).collect()} == set(range(100))


def test_a_labelled_id_is_learnt_from_once(spark):
    given = [(i, sentence(i, 80) + ".\n" + sentence(i + 1, 30), "") for i in range(40)]
    given += [(i, shouts(i, 12), "") for i in range(40, 80)]
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(80)], LABELS)
    once = spark.createDataFrame(given, DOCS)
    often = spark.createDataFrame(given + [given[i] for i in (50, 51, 52) for _ in range(100)], DOCS)
    models = [quality_model.fit(d, labels, "doc_id", "text", train_docs=80) for d in (once, often)]
    assert all(np.allclose(models[0].theta[k], models[1].theta[k]) for k in quality_model.Model.NAMES)
    fields = [line_rules.fit(d, labels, "doc_id", "text", train_docs=80) for d in (once, often)]
    assert np.allclose(fields[0].weights, fields[1].weights)


def test_every_training_text_reaches_the_language_model(spark):
    texts = [sentence(i, 2) + f" w{i} common words" for i in range(6_000)]
    rows = [(i, True, t) for i, t in enumerate(texts)] + [(i, False, "held out") for i in range(6_000, 6_100)]
    docs = spark.createDataFrame(rows, "mark long, train boolean, text string").repartition(5)
    kept = lm_score.encoded(docs)
    scorer = lm_score.fit(kept)
    count = np.zeros(scorer.end + 1)
    for _, ids, counts in lm_score.encode(texts, scorer.vocabulary):
        count += np.bincount(ids, minlength=len(count))
        count[scorer.end] += len(counts)
    want = Vocabulary.of(count, lm_score.SHOWN)
    assert np.array_equal(scorer.words.place, want.place) and np.allclose(scorer.words.share, want.share)
    turns = [lm_score.learnt(kept).where(F.pmod(F.xxhash64("mark"), F.lit(lm_score.ROUNDS)) == t) for t in range(lm_score.ROUNDS)]
    assert sum(t.count() for t in turns) == 6_000
    with pytest.MonkeyPatch.context() as patch:
        sent, seen = [], lm_score._added
        patch.setattr(lm_score, "_added", lambda *args: sent.append(seen(*args)) or sent[-1])
        lm_score.fit(kept)
    words = lm_score.Windows.of(*(np.concatenate(x) for x in list(zip(*lm_score.encode(texts, scorer.vocabulary)))[1:]), scorer.end, stride=lm_score.WINDOW)
    assert [len(sent), sum(weight for _, weight in sent[1:])] == [1 + lm_score.ROUNDS, len(words.doc)]
    untrained = lm_score.fit(kept.where("NOT train"))
    assert untrained.scores(texts[:1])[0] + 5 < scorer.scores(texts[:1])[0]


def test_classifiers_learn_from_the_ends_of_long_texts(spark):
    """What tells the labels apart stands behind the 70th line and the 3,000th word."""
    lines = "\n".join(f"the quiet river number {i} runs past the old mill and on" for i in range(300))
    junk = "\n".join("BUY $$ NOW ## CHEAP %% PILLS && WIN" for _ in range(200))
    calm = "\n".join(f"at dusk the boats of year {i} come home to the harbour" for i in range(200))
    texts = [(i, f"{lines}\n{junk if i % 2 else calm}") for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(30)], "doc_id long, quality int")
    field = line_rules.fit(docs, labels, "doc_id", "text")
    assert field.moves.any()  # the plain field, which knows no boilerplate, has none
    model = quality_model.fit(docs, labels, "doc_id", "text")
    got = quality_model.scored(docs, model).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got)


def test_allowance_takes_whole_rows_or_none(spark):
    rows = spark.createDataFrame([(1, 5), (2, 9), (3, 4), (4, 2)], "at long, units long")
    assert [r.at for r in whole_rows(rows, 11)] == [1, 3, 4]
    assert whole_rows(rows.limit(0), 11) == [] and whole_rows(rows, 0) == []
