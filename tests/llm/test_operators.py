"""The operators on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import bpe_codec, embedding_dedup, line_rules, lm_score, near_dup, packing, passages, quality_model
from ledgerline.llm import scan, url_filter, warc
from ledgerline.llm.attention import HIDDEN, WIDTH, Attention, Steps, Vocabulary, Windows, summed
from ledgerline.llm.bag_minhash import signatures
from ledgerline.llm.common import components
from ledgerline.llm.lexicon import Lexicon, compiled
from tests.llm import brute

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("kept", T.StringType())]
)
LABELS = "doc_id long, quality int, toxic int"


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "ke", "li", "mo", "nu"]) for _ in range(r.randint(1, 4))) for _ in range(n))


BASE = sentence(1, 120)
TEXTS = {
    1: BASE,
    2: BASE,
    3: BASE.replace(BASE.split()[60], "changed", 1),
    4: "head " + sentence(2, 40) + " " + BASE[100:400] + " tail",
    5: None,
    6: "",
    7: " \n\t ",
    8: "four words are here",
    9: "four words are here",
    10: "x" * 5000,
    11: "é日本 " * 400 + sentence(3, 30),
    12: "same line\nsame line\n\nother line ###\r\nsame line",
    13: sentence(4, 3000),
    14: "<|endoftext|> it's we'll  I'm\n\n'tis 12ab " + BASE[:200],
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "mine") for i, t in TEXTS.items()] + [(None, BASE, None)], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- near copies ---


def test_near_copies(docs, none):
    got = rows(near_dup.near_copies(docs))
    want = brute.near_copies(TEXTS)
    assert {i: got[i].class_id for i in TEXTS} == want
    assert all(got[i].kept == (want[i] == i) for i in TEXTS)
    assert got[None].class_id is None and got[None].kept
    assert near_dup.near_copies(none).count() == 0


def test_a_chain_of_near_copies_is_one_class(spark):
    words, texts = sentence(9, 200).split(), {}
    for i in range(12):
        words[5 + 15 * i] = f"new{i}"
        texts[100 - i] = " ".join(words)
    got = rows(near_dup.near_copies(spark.createDataFrame([(i, t, "") for i, t in texts.items()], DOCS)))
    want = brute.near_copies(texts)
    assert {i: got[i].class_id for i in texts} == want and set(want.values()) == {89}


def test_bag_minhash_is_unbiased():
    r = random.Random(5)
    a = {i: r.randint(1, 30) for i in range(60)}
    b = {i: (w if r.random() < 0.6 else r.randint(1, 30)) for i, w in a.items()}
    want = sum(min(a[i], b[i]) for i in a) / sum(max(a[i], b[i]) for i in a)
    element = scan.mixed(np.array([*a, *b], dtype=np.uint64))
    s = signatures(np.repeat([0, 1], 60), element, np.array([*a.values(), *b.values()]), 3, 4000)
    assert abs((s[0] == s[1]).mean() - want) < 0.03 and np.isinf(s[2]).all()


# --- repeated passages ---


def test_passages(docs, none):
    got = rows(passages.repeated(docs, with_text=True))
    for i, (size, gone, spans, kept) in brute.repeated_spans(TEXTS).items():
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (size, gone, spans), i
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest() and r.text == kept.decode("utf-8", "ignore")
    assert got[None].n_removed == 0 and got[None].n_bytes == len(BASE)
    assert passages.repeated(none).count() == 0


def test_passages_at_random(spark):
    r = random.Random(8)
    parts = ["ab" * 40, sentence(5, 20), "z" * 90, sentence(6, 12), "ü" * 60]
    texts = {i: "".join(r.choice(parts)[: r.randint(30, 120)] for _ in range(r.randint(0, 6))) for i in range(60)}
    got = rows(passages.repeated(spark.createDataFrame([(i, t, "") for i, t in texts.items()], DOCS).repartition(4)))
    want = brute.repeated_spans(texts)
    assert {i: (r.n_bytes, r.n_removed, r.n_spans) for i, r in got.items()} == {i: w[:3] for i, w in want.items()}


def test_multikey_order():
    held = np.random.default_rng(1).integers(0, 3, (500, 20)).astype(np.uint8)
    assert [held[i].tobytes() for i in passages.sorted_order(held)] == sorted(h.tobytes() for h in held)


# --- packing and tokens ---


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_codec(docs, none, tokenizer, spark):
    words = bpe_codec.frequent_words(docs, "text", 50)
    assert 0 < len(words) <= 50
    name = bpe_codec.share_lexicon(spark, words)
    got = rows(bpe_codec.digests(docs, "doc_id", "text", name))
    for i, text in TEXTS.items():
        ids = ids_of(tokenizer, text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe_codec.encoded(docs, "doc_id", "text", name)
    back = rows(bpe_codec.decoded(encoded, "doc_id"))
    assert all(back[i].text == (t or "") for i, t in TEXTS.items())
    assert bpe_codec.digests(none, "doc_id", "text", None).count() == 0
    assert bpe_codec.frequent_words(none, "text", 5) == []


def test_lexicon(tmp_path):
    import public_tokenizers

    from ledgerline.llm.bytepair import merges

    own = merges(public_tokenizers.path("byte_bpe_50k.json"))
    words = [w.encode() for w in ("stop", "top", "tops", "stops", "", "a", " the", "é")]
    (tmp_path / "x").write_bytes(compiled(words, own))
    held = Lexicon(str(tmp_path / "x"))
    asked = [b"tops", b"to", b"stop", b" the", b"a", b"topsy", "é".encode(), b"b"]
    data = np.frombuffer(b"".join(asked), dtype=np.uint8)
    ends = np.cumsum([len(a) for a in asked])
    known, start, size = held.find(data, ends - [len(a) for a in asked], ends)
    assert known.tolist() == [a in words for a in asked]
    for i in np.flatnonzero(known):
        assert held.ids[start[i] : start[i] + size[i]].tolist() == own.one(asked[i])
    assert held.states < sum(map(len, words))  # ends are shared


def test_packing(docs, none, tokenizer):
    got = packing.packed(docs, capacity=256, per_group=5).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {*TEXTS, None}
    for i, text in [*TEXTS.items(), (None, BASE)]:
        ids, at = [*ids_of(tokenizer, text), 1], 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], dtype="<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256
    assert packing.packed(none).count() == 0


def test_best_fit_takes_the_tightest():
    lengths = sorted((random.Random(2).randint(1, 50) for _ in range(400)), reverse=True)
    sequences, offsets = packing.best_fit(lengths, 50)
    left = {}
    for n, s, o in zip(lengths, sequences, offsets):
        fits = [v for v in left.values() if v >= n]
        assert 50 - o == (min(fits) if fits else 50)
        left[s] = 50 - o - n


# --- WARC ---


def test_warc(spark, folder):
    pages = [(1, "http://a/", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 5000), (5, "u", "é" * 5000)]
    pages += [(7, "u\r\nx: y", "one\r\n\r\nWARC/1.1\r\n"), (9, "u", "same"), (None, "u", "lone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("record_type", F.lit(1))
    files = warc.write_archives(df, folder("warc"), chunk_bytes=777, file_bytes=2000)
    got = sorted((r.page_id or -1, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_archives(files).collect())
    d = lambda t: warc.base32(hashlib.sha1((t or "").encode()).digest())
    assert got == sorted(
        [
            (1, "revisit", 9, 4, d("same")),
            (2, "revisit", 9, 4, d("same")),
            (9, "response", None, 4, d("same")),
            (3, "revisit", 4, 0, d("")),
            (4, "response", None, 0, d("")),
            (5, "response", None, 10000, d("é" * 5000)),
            (5, "revisit", 5, 10000, d("é" * 5000)),
            (7, "response", None, len(pages[6][2]), d(pages[6][2])),
            (-1, "response", None, 4, d("lone")),
        ],
        key=lambda x: (x[0], x[1]),
    )
    assert files.agg(F.sum("records")).first()[0] == len(pages)
    small = warc.write_archives(df, folder("small"), least_bytes=5)
    assert warc.read_archives(small).where("record_type = 'revisit'").count() == 1
    empty = warc.write_archives(df.where("page_id = 77"), folder("none"))
    assert warc.read_archives(empty).count() == 0


# --- quality ---


@pytest.fixture(scope="module")
def judged_docs(spark):
    good = [(i, sentence(i, 80) + ".\n" + sentence(i + 1, 30)) for i in range(20, 80)]
    bad = [(i, "\n".join(["BUY NOW!! ### $$$ " + sentence(i % 3, 4).upper()] * 12)) for i in range(80, 140)]
    return spark.createDataFrame([(i, t, "") for i, t in good + bad], DOCS)


@pytest.fixture(scope="module")
def marked(spark):
    given = [(i, int(i < 80), 0) for i in range(20, 140)]
    return spark.createDataFrame(given + [(None, 1, 0), (21, None, 0)], LABELS)


def test_line_rules(spark, docs, none, judged_docs, marked):
    field = line_rules.fit(judged_docs, marked, "doc_id", "text")
    got = rows(line_rules.judged(judged_docs, field))
    assert all(got[i].kept == (i < 80) for i in range(20, 140))
    got = rows(line_rules.judged(docs, field))
    for i, text in TEXTS.items():
        r, want = got[i], brute.line_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    plain = line_rules.fit(docs, marked.where("quality = 9"), "doc_id", "text")
    assert all(r.kept == (not r.base_failed) for r in line_rules.judged(docs, plain).collect())
    assert line_rules.judged(none, field).count() == 0
    kept = line_rules.filtered(docs, plain)
    assert kept.columns == docs.columns and kept.count() == line_rules.judged(docs, plain).where("kept").count()


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(4)
    field = line_rules.Field(r.normal(size=(line_rules.FEATURES, 2)), r.normal(size=(2, 2)))
    x = r.normal(size=(9, line_rules.FEATURES))
    marks = field.decode(x, np.array([0, 4, 4]), np.array([4, 0, 5]))
    for a, b in ((0, 4), (4, 9)):
        e = x[a:b] @ field.weights
        def value(path):
            return sum(e[i, p] for i, p in enumerate(path)) + sum(field.moves[p, q] for p, q in zip(path, path[1:]))
        every = [[n >> i & 1 for i in range(b - a)] for n in range(1 << (b - a))]
        assert value(marks[a:b].tolist()) == pytest.approx(max(map(value, every)))


def test_quality_model(docs, none, judged_docs, marked):
    model = quality_model.fit(judged_docs, marked, "doc_id", "text")
    got = rows(quality_model.scored(judged_docs, model).withColumn("out", quality_model.held_out("doc_id")))
    assert all(r.predicted == (i < 80) for i, r in got.items() if r.out)
    odd = rows(quality_model.scored(docs, model))
    assert all(0 <= r.score <= 1 for r in odd.values()) and odd[5].score == odd[6].score == odd[7].score
    assert odd[1].score == odd[2].score
    assert quality_model.scored(none, model).count() == 0
    nothing = quality_model.fit(docs, marked.where("quality = 9"), "doc_id", "text")
    assert {r.score for r in quality_model.scored(docs, nothing).collect()} == {0.5}
    assert quality_model.filtered(docs, nothing).columns == docs.columns


# --- language model ---


def test_language_scores(docs, none):
    got = rows(lm_score.language_scores(docs))
    learnt = {i: t for i, t in [*TEXTS.items(), (None, BASE)] if i is None or zlib.crc32(str(i).encode()) % 5 != 1}
    low = lambda t: (t or "").encode().lower().split()
    counts = Counter(w for t in learnt.values() for w in low(t))
    total, ends = sum(counts.values()) + len(learnt), len(learnt)
    for i, text in TEXTS.items():
        words, r = low(text), got[i]
        spread = math.log10(total + 0.5 * (len(counts) + 2))
        base = sum(math.log10(counts[w] + 0.5) for w in words) + math.log10(ends + 0.5) - spread * (len(words) + 1)
        assert r.base_score == pytest.approx(base) and r.n_known == sum(counts[w] > 0 for w in words) + 1
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(words) + 1, total, i not in learnt)
        assert r.score < 0
    assert got[5].score == got[6].score == got[7].score
    assert lm_score.language_scores(none).count() == 0


def test_windows_score_each_target_once():
    counts = np.array([0, 1, 31, 32, 33, 200])
    ids = np.arange(counts.sum())
    w = Windows.of(ids, counts, 999)
    for doc, (n, end) in enumerate(zip(counts, np.cumsum(counts))):
        own = w.doc == doc
        assert w.targets[own][w.scored[own]].tolist() == [*range(end - n, end), 999]


def test_equal_texts_score_the_same_in_every_batch(monkeypatch):
    """Products over different numbers of rows may round differently, so the model gets as many windows each time."""
    import public_tokenizers

    from ledgerline.llm.bytepair import merges

    r = np.random.default_rng(5)
    end = merges(public_tokenizers.path(lm_score.VOCABULARY)).size
    count = np.append(r.integers(0, 9, end), 50).astype(float)
    words = Vocabulary.of(count, 60)
    entry = np.bincount(words.place, weights=count + 0.1)
    scorer = lm_score.Scorer(Attention.new(entry / entry.sum()), words, end, lm_score.VOCABULARY)
    texts = [r.integers(0, end, n).astype("<u2").tobytes() for n in (0, 1, 40, 700, 5_000, 90)]
    sizes, logs = set(), Attention.logs
    monkeypatch.setattr(Attention, "logs", lambda self, x, *rest: sizes.add(len(x)) or logs(self, x, *rest))
    want = scorer.of_ids(texts)
    assert [scorer.of_ids([t])[0] for t in texts] == want.tolist()
    assert scorer.of_ids(texts[::-1] * 3).tolist() == want[::-1].tolist() * 3
    assert len(sizes) == 1


def test_scoring_weighs_each_target_once(monkeypatch):
    """Positions that a window only looks back at get no mixture weights, and the scores are those of whole windows."""
    import public_tokenizers

    from ledgerline.llm.bytepair import merges

    r = np.random.default_rng(6)
    end = merges(public_tokenizers.path(lm_score.VOCABULARY)).size
    count = np.append(r.integers(0, 9, end), 50).astype(float)
    words = Vocabulary.of(count, 60)
    entry = np.bincount(words.place, weights=count + 0.1)
    scorer = lm_score.Scorer(Attention.new(entry / entry.sum()), words, end, lm_score.VOCABULARY)
    texts = [r.integers(0, end, 32 + 3 * 26 - 1) for _ in range(lm_score.BATCH)]
    weighed, logs = [], Attention.logs
    monkeypatch.setattr(Attention, "logs", lambda self, x, y, *rest: weighed.append(y.size) or logs(self, x, y, *rest))
    got = scorer.of_ids([t.astype("<u2").tobytes() for t in texts])
    assert sum(weighed) == sum(len(t) + 1 for t in texts)
    w = Windows.of(np.concatenate(texts), np.array([len(t) for t in texts]), end)
    places, goals = words.place[w.inputs], words.place[w.targets]
    whole = logs(scorer.model, places, goals, scorer.model.tables()) + words.share[w.targets]
    assert np.allclose(got, np.bincount(w.doc, (whole * w.scored).sum(axis=1)), rtol=1e-5)


def test_steep_mixture_weights():
    """Weights whose logarithms no exponential of the short numbers holds."""
    model = Attention.new(np.full(40, 1 / 40))
    x = np.random.default_rng(3).integers(0, 40, (4, 32))
    model.theta["M"] = model.theta["M"] * np.float32(400)
    got = model.forward(x)
    z = got["u"].astype(float) @ model.theta["M"] + model.theta["m"]
    want = np.exp(z - z.max(axis=1, keepdims=True))
    assert z.max() > 100 and np.allclose(got["pi"].reshape(z.shape), want / want.sum(axis=1, keepdims=True), atol=1e-4)


def test_speller_forgets_words_and_encodes_them_again(monkeypatch):
    """A table of few words and little room gives the ids that whole texts have."""
    monkeypatch.setattr(lm_score.Speller, "BITS", 3)
    monkeypatch.setattr(lm_score.Speller, "ROOM", 40)
    lm_score.speller.cache_clear()
    texts = [f"{sentence(i, 9)} Don't\tstop-{i % 5}  \u00c9t\u00e9 \u4f60\u597d!? " for i in range(40)] + ["", None, "x" * 200]
    plain = [b"".join(b" " + w for w in t.split()).decode() for t in lm_score.lowered(texts)]
    want, counts = bpe_codec.encoder(None, lm_score.VOCABULARY).encode(plain)
    for given in (texts, texts):
        parts = list(lm_score.encode(given, lm_score.VOCABULARY))
        assert np.concatenate([ids for _, ids, _ in parts]).tolist() == want.tolist()
        assert np.concatenate([n for _, _, n in parts]).tolist() == counts.tolist()
    lm_score.speller.cache_clear()


def test_shares_stay_normal_numbers():
    """A word that no longer occurs keeps a share that arithmetic is fast on."""
    steps = Steps(Attention.new(np.full(40, 1 / 40)), 0.02, 0.5)
    x, on = np.zeros((4, 32), dtype=int), np.ones((4, 32), dtype=bool)
    for _ in range(500):
        steps.take(x, x, on)
    assert steps.model.share.min() > np.finfo(np.float32).tiny
    assert all(np.isfinite(v).all() for v in steps.model.theta.values())


def test_attention_is_causal_and_its_slopes_are_right():
    model = Attention.new(np.full(40, 1 / 40))
    r = np.random.default_rng(0)
    x = r.integers(0, 40, (2, 32))
    changed = x.copy()
    changed[:, 20:] = (changed[:, 20:] + 1) % 40
    assert np.allclose(model.forward(x)["pi"][:, :20], model.forward(changed)["pi"][:, :20])
    tables = model.tables()
    assert np.allclose((model.forward(x)["pi"] @ tables.T).sum(axis=2), 1, atol=1e-4)
    model.theta = {k: v.astype(np.float64) for k, v in model.theta.items()}
    y, on = r.integers(0, 40, (2, 32)), r.random((2, 32)) < 0.8
    slopes, duty, _ = model.slopes(x, y, on, tables)
    rows, wide = summed(x.ravel(), slopes["W"])
    slopes["W"] = np.zeros(model.theta["W"].shape)
    slopes["W"][rows] = wide
    assert np.allclose(duty.sum(axis=2), on, atol=1e-5)
    for name in ("Q", "K", "V", "O", "H", "M", "P", "h", "m"):
        assert _slope(model, (x, y, on, tables), name, slopes[name])
    for columns in (slice(0, WIDTH), slice(WIDTH, WIDTH + HIDDEN), slice(WIDTH + HIDDEN, None)):
        assert _slope(model, (x, y, on, tables), "W", slopes["W"], columns)


def _slope(model, batch, name, slope, columns=slice(None)):
    """Whether the steepest entry agrees with the difference of two losses."""
    part = np.abs(slope[..., columns])
    at = np.unravel_index(part.argmax(), part.shape)
    at = (*at[:-1], at[-1] + (columns.start or 0))
    both = []
    for step in (1e-3, -1e-3):
        model.theta[name][at] += step
        both.append(model.slopes(*batch)[2])
        model.theta[name][at] -= step
    return (both[0] - both[1]) / 2e-3 == pytest.approx(slope[at], rel=0.05, abs=2e-5)


def test_distributions_follow_the_duties():
    """Words that come in two kinds of texts: the model learns to tell them apart, better than any unigram."""
    r = np.random.default_rng(1)
    kind = r.integers(0, 2, (400, 1))
    x = r.integers(0, 20, (400, 33)) + 20 * kind
    model = Attention.new(np.full(40, 1 / 40))
    steps, on = Steps(model, 0.02, 0.1), np.ones((400, 32), dtype=bool)
    for at in [*range(0, 400, 40)] * 6:
        steps.take(x[at : at + 40, :-1], x[at : at + 40, 1:], on[at : at + 40])
    steps.settle()
    assert steps.duty.sum() == pytest.approx(6 * 400 * 32) and model.share.sum() == pytest.approx(1)
    assert np.allclose(model.tables().sum(axis=0), 1, atol=1e-4)
    assert model.logs(x[:, :-1], x[:, 1:], model.tables()).mean() > np.log10(1 / 40) + 0.2


# --- vectors ---


def test_near_vectors(spark):
    r = np.random.default_rng(3)
    centre = r.normal(size=16)
    vectors = [(i, (centre + r.normal(size=16) * s).tolist()) for i, s in enumerate([0.05] * 30 + [0.4] * 30)]
    vectors += [(100 + i, r.normal(size=16).tolist()) for i in range(60)]
    vectors += [(200, (centre * 3).tolist()), (201, (centre * 2).tolist())]
    odd = [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [None] * 16), (305, [1.0, 2.0]), (None, centre.tolist())]
    df = spark.createDataFrame(vectors + odd + vectors[:1], "vec_id long, embedding array<double>").withColumn("kept", F.lit("x"))
    got = rows(embedding_dedup.near_vectors(df), "vec_id")
    x = np.array([v for _, v in vectors])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    ids = [i for i, _ in vectors]
    want = brute.classes([(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked))], ids)
    for k, i in enumerate(ids):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (linked[k].sum(), want[i], want[i] == i)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(300, 306))
    assert got[None].n_links == 0 and embedding_dedup.near_vectors(df.where("vec_id = 77")).count() == 0


def test_forest_with_spark_levels(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 64)
    r = np.random.default_rng(6)
    centres = r.normal(size=(60, 32))
    x = np.concatenate([c + r.normal(size=(8, 32)) * 0.12 for c in centres])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = rows(embedding_dedup.near_vectors(df), "vec_id")
    x = x.astype("f4").astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    degree = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert sum(r.n_links for r in got.values()) >= 0.99 * degree.sum()


def test_components(spark):
    r = random.Random(1)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = brute.classes(links, {n for link in links for n in link})
    assert all(got.get(n, n) == c for n, c in want.items())


# --- urls ---


def test_url_rules(spark):
    urls = ["http://A.Net/x?q#f", "http://www.example.net/en/1", "https://example.com/de/", "x.org/fr/", "s://b.org/fr/x", None, "http://knet/", "http://net?x/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("own"))
    outcomes = spark.createDataFrame([(4, 1), (None, 1), (3, None)], "page_id long, bad int")
    got = rows(url_filter.url_verdicts(df, outcomes), "page_id")
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(8)] == [
        ("a.net", "/x", "net/"),
        ("www.example.net", "/en/1", "example.net/en/"),
        ("example.com", "/de/", "example.com/de/"),
        ("", "", None),
        ("b.org", "/fr/x", "org/fr/"),
        ("", "", None),
        ("knet", "/", None),
        ("net", "", None),
    ]
    assert [got[i].verdict for i in range(3)] == ["block", "allow", "block"] and got[5].verdict == "allow"
    assert url_filter.url_verdicts(df.where("page_id > 99"), outcomes).count() == 0


def test_a_bad_host_is_blocked(spark):
    df = spark.createDataFrame([(i, f"http://h{i % 3}.x.org/{i}") for i in range(90)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "page_id long, bad int")
    got = rows(url_filter.url_verdicts(df, outcomes), "page_id")
    assert all((got[i].verdict == "block") == (i % 3 == 0) for i in range(90))
