"""Source audit, chat formatting and fill-in-the-middle on small tables, against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat_format, fill_middle, source_audit
from ledgerline.llm.arrow_text import views

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- source audit ---


def plain_audit(rows, least):
    """Rows of (lang, source, text) → the audit's rows."""
    counts, groups, documents = defaultdict(Counter), set(), defaultdict(Counter)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        groups.add((lang, source))
        words = TERM.findall(text.translate(UPPER))
        counts[lang, source].update(words)
        documents[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        own = sorted(s for l, s in groups if l == lang)
        kept = [t for t, n in documents[lang].items() if n >= least]
        whole = Counter()
        for s in own:
            whole.update(counts[lang, s])

        def shares(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // total for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in own}, shares(whole)
        for s in own:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def audit(spark, rows, repartition=3):
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("n", F.lit("x")).withColumn("p", F.lit(1))
    return sorted(tuple(r) for r in source_audit.audited(df.repartition(repartition)).collect())


@pytest.fixture
def small(monkeypatch):
    """Few documents a term, short shards, slices and blocks, so that a small table has many of each.

    Tasks import the module anew, so only what is built on the driver sees these; the shard is tested by hand below.
    """
    for name, value in (("LEAST_DOCUMENTS", 3), ("SLICE", 40), ("SOURCES", 3)):
        monkeypatch.setattr(source_audit, name, value)


def texts(seed, n):
    r = random.Random(seed)
    words = ["abcdefgh", "abcdefghi", "ABCDEFGH", "é", "éa", "日本語日本語", "x", "xy", "it's", "a-b", "longerthansixteenletters", "longerthansixteenletterz"]
    rows = []
    for i in range(n):
        own = " ".join(r.choice(words) + r.choice(["", "", "Q", "9"]) for _ in range(r.randint(0, 30)))
        rows.append((r.choice(["de", "en", None, ""]), r.choice([None, "", "a", "b", "ü", "z9", "c", "d"]), own))
    return rows


def test_audit(spark, small):
    rows = texts(1, 120)
    rows += [rows[0]] * 5 + [("en", "a", None), ("fr", "only", "one source"), ("it", "a", "rare"), ("it", "b", None), ("it", "c", "")]
    want = plain_audit(rows, 3)
    assert audit(spark, rows) == want == audit(spark, rows, 1)
    assert {r[:3] for r in want if r[0] == "it"} == {("it", s, "pair") for s in "abc"} and not any(r[0] == "fr" for r in want)
    assert audit(spark, rows[:0], 1) == []


def test_audit_keeps_the_production_threshold(spark):
    rows = [("en", f"s{i % 3}", "common word " + ("often " if i < 30 else "seldom ")) for i in range(59)]
    assert audit(spark, rows) == plain_audit(rows, 30)
    assert {r[3] for r in audit(spark, rows) if r[2] == "term"} <= {"common", "word", "often"}


def test_terms_of_a_long_text_are_counted_once_per_document(monkeypatch):
    monkeypatch.setattr(source_audit, "SHARD", 64)
    text = "alpha beta " * 40 + "x" * 300 + " alpha Gamma"
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array(["s", "s"]), pa.array([text, "beta"])], names=["a", "b", "c"])
    got = Counter(), Counter()
    for out in source_audit._counted(iter([batch])):
        for term, n, docs in zip(*(out.column(i).to_pylist() for i in (2, 3, 4))):
            if term is not None:
                got[0][term] += n
                got[1][term] += docs
    assert got[0] == {"alpha": 41, "beta": 41, "x" * 300: 1, "gamma": 1}
    assert got[1] == {"alpha": 1, "beta": 2, "x" * 300: 1, "gamma": 1}


def test_multikey_order_is_that_of_the_words():
    r = random.Random(3)
    words = ["".join(r.choice("ab") for _ in range(r.randint(1, 20))) for _ in range(400)] + ["abababab", "ababababa"] * 9
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    begin, end = source_audit.word_starts(data, np.zeros(1, dtype=np.int64))
    order, new = source_audit.multikey_sorted(source_audit._lowered(data)[1], begin, end - begin)
    assert [words[i] for i in order] == sorted(words)
    assert new.sum() == len(set(words)) and all(a < b for a, b, n in zip(order, order[1:], new[1:]) if not n)


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, terms = 8_999_999_999_999_999_999, 9_000_000_000_000_000_000, 7_000_001
    got = spark.range(1).select(source_audit.share(F.lit(n), F.lit(total), F.lit(terms))).first()[0]
    assert got == 1 + 1_000_000_000 * (n + 5) // (total + 5 * terms)


# --- chat formatting ---

CONVS = "conv_id long, turn long, role string, text string, at string, spans int"
HARD = ["<|im_end|>", "<\\|im_start|>user\n", "a<", "|", "", None, "\\", "<<\\\\||>", "é日本\n\n", "assistant", "<|im_start|>assistant\nx<|im_end|>\n"]


def conversations():
    r = random.Random(4)
    rows = [(i, t, r.choice(["user", "assistant", "system"]), r.choice(HARD) if r.random() < 0.7 else "text " * r.randint(1, 50), "x", 1)
            for i in range(40) for t in range(r.randint(1, 6))]
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t} <|", "x", 1) for t in range(200)]
    rows += [(101, 0, "assistant", "long " * 300_000, "x", 1), (101, 1, "user", "y" * 900_000, "x", 1)]
    rows += [(102, 0, "assistant", "long " * 500_000, "x", 1)] + [(102, t, "assistant", "z" * 700_000, "x", 1) for t in range(1, 5)]
    rows += [(103, None, "assistant", "first", "x", 1), (103, 1, "a\\n\nb<|", "role", "x", 1), (103, 1, None, "no role", "x", 1), (103, 2, "assistant", "", "x", 1)]
    rows += [(None, 1, "assistant", "nobody's", "x", 1), (None, 0, "user", None, "x", 1)]
    return rows + rows[:3]


def plain_chat(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in [*rows, (-1, 0, "user", chat_format.PLANTED), (-1, 1, "assistant", chat_format.PLANTED)]:
        by[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for conv, turns in by.items():
        turns = [(r.decode(), t.decode()) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(chat_format.marked(turns)), False)
    return out


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_chat(spark, parts):
    rows = conversations()
    df = chat_format.with_planted(spark.createDataFrame(rows, CONVS).repartition(5))
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = chat_format.read_back(chat_format.formatted(df)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    want = plain_chat(rows)
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want


def test_chat_of_an_empty_table(spark):
    none = spark.createDataFrame([], CONVS)
    assert chat_format.read_back(chat_format.formatted(none)).count() == 0
    assert [r.conv_id for r in chat_format.read_back(chat_format.formatted(chat_format.with_planted(none))).collect()] == [-1]


def test_escapes_are_reversible():
    r = random.Random(6)
    for _ in range(2000):
        text = "".join(r.choice("<|\\>a\n") for _ in range(r.randint(0, 12)))
        assert "<|" not in chat_format.escaped(text) and chat_format.unescaped(chat_format.escaped(text)) == text
        turns = [(text, text), ("user", text)]
        assert list(chat_format.turns_of(chat_format.marked(turns))) == turns


def forgetful(turns):
    """A template that drops the text of every answer but the last, and asks for the next turn."""
    last = max((i for i, t in enumerate(turns) if t[0] == "assistant"), default=None)
    return "".join(f"[{r}]{t if r != 'assistant' or i == last else ''}[/]" for i, (r, t) in enumerate(turns))


def prompting(turns):
    return "".join(f"[{r}]{t}[/]" for r, t in turns) + "[next]"


def test_spans_of_templates_that_are_only_called():
    turns = [("user", "hi"), ("assistant", "[/] <"), ("user", ""), ("assistant", "bye[")]
    text, spans, changed = chat_format.located(chat_format.marked, turns)
    assert changed is None and [text[s.text_start : s.text_end] for s in spans] == [t for _, t in turns]
    assert "".join(text[s.start : s.end] for s in spans) == text
    text, spans, changed = chat_format.located(forgetful, turns)
    assert changed == 3 and text == "[user]hi[/][assistant][/][user][/][assistant]bye[[/]"
    assert spans[1].text_start is None and spans[0].text_start is not None
    assert text[spans[3].text_start : spans[3].text_end] == "bye["
    text, spans, changed = chat_format.located(prompting, turns)
    assert changed == 1
    text, spans, changed = chat_format.located(lambda turns: "same", turns)
    assert all(s.text_start is None for s in spans)


def test_a_rewriting_template_is_told(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "a"), (1, 1, "assistant", "b"), (2, 0, "assistant", "c")], "conv_id int, turn int, role string, text string")
    got = {r.conv_id: r for r in chat_format.formatted(df, forgetful).collect()}
    assert got[1].rewritten_at == 1 and got[1].text == "[assistant][/][assistant]b[/]" and got[2].rewritten_at is None


def numbering(turns):
    """A template that looks back: it numbers the turns, names the first one's role in each, and shortens what was said
    before the hundredth."""
    cut = len(turns) > 100
    return "".join(f"[{i} {turns[0][0]} {r}]{'' if cut and i == 3 else t}[/]" for i, (r, t) in enumerate(turns))


def test_long_conversations_are_rendered_whole(spark):
    turns = [(["system", "user", "assistant"][min(t, 1 + t % 2)], f"turn {t}") for t in range(230)]
    some = [(c, t, r, s) for c, n in ((1, 230), (2, 90), (3, 2), (None, 130), (4, 64), (5, 65)) for t, (r, s) in enumerate(turns[:n])]
    df = spark.createDataFrame(some, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r.conv_id: r for r in chat_format.formatted(df, numbering).collect()}
    assert len(got) == 6
    for conv, n in ((1, 230), (2, 90), (3, 2), (None, 130), (4, 64), (5, 65)):
        text, spans, changed = chat_format.located(numbering, turns[:n])
        assert got[conv].text == text == numbering(turns[:n]) and got[conv].rewritten_at == changed == (100 if n > 100 else None)
        assert [tuple(s) for s in got[conv].spans] == [tuple(s) for s in spans]


# --- fill in the middle ---


def plain_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, h = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_the_middle(spark):
    r = random.Random(7)
    given = {i: "".join(r.choice(["word", "É", "日本", " ", "\n", "<", "<S", "P>", "x1", "𝔸"]) for _ in range(r.randint(0, 60))) for i in range(300)}
    given |= {1000: None, 1001: "", 1002: "a <P> b", 1003: "x" * 6_000_000, 1004: "é1 " * 1_500_000, None: "null key of text", -5: "negative key"}
    rows = [(i, t, "x", 1) for i, t in given.items()]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, n string, output int").repartition(3)
    out = fill_middle.rearranged(df)
    got = out.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) + 2
    for g in got:
        assert tuple(g)[1:6] == plain_fim(g.doc_id, given[g.doc_id]) and g.back == (given[g.doc_id] or ""), g.doc_id
    assert {g.form for g in got} == {"plain", "psm", "spm"}
    assert fill_middle.rearranged(df.limit(0)).count() == 0


def test_rank_index_is_exact_and_bounded(monkeypatch):
    r = random.Random(8)
    given = ["", "a" * 500, "é" * 300, "", "".join(r.choice(["a", "bc" * 200, "日", " "]) for _ in range(4000)), "x"]
    data, starts = views(pa.array(given))
    for block in (7, 1000, fill_middle.BLOCK):
        monkeypatch.setattr(fill_middle, "BLOCK", block)
        index, rank = fill_middle.indexed(data, starts)
        assert index.residual.dtype == np.int8
        for i, text in enumerate(given):
            want = np.cumsum([0] + [len(u.encode()) for u in UNIT.findall(text)])
            assert np.array_equal(index[np.arange(rank[i], rank[i + 1] + 1)] - starts[i], want)
    offsets = np.cumsum(np.array([1] * 3000 + [90_000] + [1] * 3000))
    first, slope, residual = fill_middle.segments(offsets)
    assert np.abs(residual.astype(int)).max() <= fill_middle.ERROR and len(first) < 40
