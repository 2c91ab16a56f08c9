"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

Every line with a word is described by a few numbers (shares of capitals, marks and digits, repetition, length,
place). The field is fitted on the driver to at most ``train_docs`` labelled documents, all lines of each, as long as
they have ``TRAIN_LINES`` lines together: a line counts as boilerplate
if its document is labelled as low quality and the line itself repeats, shouts or is full of marks, else as content.
Viterbi decoding of every whole text then gives the likeliest marks, and a document is kept if at least
``least_share`` of its words lie in content lines and the base rules hold.

* Null text: no words, fails the base rules. A text without line ends is one line.
* No labelled document: all lines are content, the base rules decide alone.
* Repeated rows: one result each; an id is learnt from once, however many rows have it. Empty table: no rows. Columns beside the id and the text are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import scan
from ledgerline.llm.common import by_bytes, labelled, per_frame, table, whole_rows

SYMBOLS = b"#*$%&|<>"
#: Labelled documents that the field is fitted to, and lines of all of them; a document takes part whole or not at all.
TRAIN_DOCS, TRAIN_LINES = 3_000, 250_000
#: Lines of a sequence in fitting: a longer text is several sequences.
SEQUENCE = 64
LEAST_SHARE = 0.5
LEAST_WORDS, MOST_REPEATED = 50, 50
STEPS, RATE, RIDGE = 250, 0.1, 1e-5
FEATURES = 15


def _mask(chars) -> np.ndarray:
    out = np.zeros(256, dtype=np.uint8)
    out[list(chars)] = 1
    return out


_UPPER, _LOWER = _mask(range(65, 91)), _mask(range(97, 123))
_DIGIT, _SYMBOL, _SHOUT = _mask(range(48, 58)), _mask(SYMBOLS), _mask(b"!?")
_POINT = _mask(b".,;:")
_HEAD = _mask([*range(0x80), *range(0xC0, 0x100)])  # first bytes of code points


class Lines:
    """A batch of texts with its lines: counts per document and features per line."""

    def __init__(self, texts: list[bytes]):
        data, at = scan.joined(texts)
        n = len(texts)
        w0, w1, wh = scan.words(data)
        l0, l1, lh = scan.lines(data)
        word_line = np.searchsorted(l0, w0, side="right") - 1
        per_line = np.bincount(word_line, minlength=len(l0))
        if len(l0) and (per_line == 0).any():
            has = per_line > 0
            word_line = (np.cumsum(has) - 1)[word_line]
            l0, l1, lh, per_line = l0[has], l1[has], lh[has], per_line[has]
        self.doc = np.searchsorted(at, l0, side="right") - 1
        self.words = per_line
        word_doc = self.doc[word_line] if len(w0) else word_line
        self.n_words = np.bincount(word_doc, minlength=n)

        def within(mask: np.ndarray) -> np.ndarray:
            return np.add.reduceat(mask[data], l0, dtype=np.int64) if len(l0) else np.zeros(0, dtype=np.int64)

        cover = np.zeros(len(data) + 1, dtype=np.int8)
        cover[w0] = 1
        np.subtract.at(cover, w1, 1) if len(w1) else None
        inside = np.cumsum(cover[:-1], dtype=np.int8).astype(bool)
        heads = _HEAD[data].astype(bool) & inside
        in_word = np.add.reduceat(heads, l0, dtype=np.int64) if len(l0) else per_line
        self.word_chars = self._per_doc(in_word, n)
        symbols = within(_SYMBOL)
        self.n_symbols = self._per_doc(symbols, n)  # lines without a word have none

        owner = scan.mixed(self.doc.astype(np.uint64))
        again = np.ones(len(lh), dtype=bool)
        again[np.unique(lh ^ owner, return_index=True)[1]] = False
        self.n_dup_lines = self._per_doc(again, n)

        repeated = np.zeros(len(w0), dtype=bool)
        three = scan.grams(wh, 3)
        ok = np.flatnonzero(word_doc[2:] == word_doc[:-2]) if len(w0) > 2 else np.zeros(0, dtype=np.int64)
        if len(ok):
            _, back, times = np.unique(
                three[ok] ^ scan.mixed(word_doc[ok].astype(np.uint64)), return_inverse=True, return_counts=True
            )
            hit = ok[times[back] > 1]
            for i in range(3):
                repeated[hit + i] = True
        self.n_repeat_words = np.bincount(word_doc, weights=repeated, minlength=n).astype(np.int64)
        same = np.bincount(word_line, weights=repeated, minlength=len(l0)) if len(l0) else np.zeros(0)

        letters = within(_UPPER) + within(_LOWER)
        upper = within(_UPPER) / np.maximum(letters, 1)
        self.first = np.searchsorted(self.doc, np.arange(n))
        self.count = np.searchsorted(self.doc, np.arange(n), side="right") - self.first
        place = np.arange(len(l0)) - self.first[self.doc] if len(l0) else self.doc
        self.features = np.stack(
            [
                np.ones(len(l0)),
                np.log1p(per_line),
                np.where(letters >= 8, upper, 0.0),
                np.minimum(symbols / np.maximum(per_line, 1), 2.0),
                np.minimum(within(_SHOUT) / np.maximum(per_line, 1), 2.0),
                within(_DIGIT) / np.maximum(l1 - l0, 1),
                again.astype(float),
                same / np.maximum(per_line, 1),
                np.minimum(in_word / np.maximum(per_line, 1), 20.0) / 5.0,
                (per_line < 4).astype(float),
                np.minimum(within(_POINT) / np.maximum(per_line, 1), 2.0),
                (place == 0).astype(float),
                (symbols > 0.15 * per_line).astype(float),
                ((letters >= 8) & (upper > 0.6)).astype(float),
                (same > 0.5 * per_line).astype(float),
            ],
            axis=1,
        )

    def _per_doc(self, values: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.doc, weights=values, minlength=n).astype(np.int64)


def suspicious(features: np.ndarray) -> np.ndarray:
    """Lines that repeat, shout or are full of marks: of a low-quality document they count as boilerplate."""
    f = features.T
    return (f[2] > 0.6) | (f[3] > 0.15) | (f[4] > 0.5) | (f[6] > 0) | (f[7] > 0.5)


class Field:
    """A linear-chain conditional random field over two marks: 0 content, 1 boilerplate."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    @classmethod
    def plain(cls) -> Field:
        """Marks every line as content."""
        weights = np.zeros((FEATURES, 2))
        weights[0, 0] = 1.0
        return cls(weights, np.zeros((2, 2)))

    @classmethod
    def fitted(cls, lines: list[np.ndarray], marks: list[np.ndarray], steps: int = STEPS) -> Field:
        """Maximum likelihood with a ridge, by Adam on all sequences at once."""
        if not lines or not any(m.any() for m in marks):
            return cls.plain()
        rows, long = len(lines), max(map(len, lines))
        x, y, on = np.zeros((rows, long, FEATURES)), np.zeros((rows, long), dtype=int), np.zeros((rows, long), dtype=bool)
        for i, (f, m) in enumerate(zip(lines, marks)):
            x[i, : len(f)], y[i, : len(m)], on[i, : len(m)] = f, m, True
        chosen = np.eye(2)[y] * on[..., None]
        pairs = np.einsum("nti,ntj->ij", chosen[:, :-1], chosen[:, 1:])
        theta = np.zeros(FEATURES * 2 + 4)
        mean, square = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            w, a = theta[:-4].reshape(FEATURES, 2), theta[-4:].reshape(2, 2)
            e = x @ w
            ahead, back = np.zeros((rows, long, 2)), np.zeros((rows, long, 2))
            ahead[:, 0] = e[:, 0]
            for t in range(1, long):
                new = e[:, t] + np.logaddexp(ahead[:, t - 1, 0, None] + a[0], ahead[:, t - 1, 1, None] + a[1])
                ahead[:, t] = np.where(on[:, t, None], new, ahead[:, t - 1])
            for t in range(long - 2, -1, -1):
                after = e[:, t + 1] + back[:, t + 1]
                new = np.logaddexp(after[:, 0, None] + a[:, 0], after[:, 1, None] + a[:, 1])
                back[:, t] = np.where(on[:, t + 1, None], new, 0.0)
            total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
            p = np.exp(np.minimum(ahead + back - total[:, None, None], 0)) * on[..., None]
            both = ahead[:, :-1, :, None] + a + (e + back)[:, 1:, None, :] - total[:, None, None, None]
            q = np.exp(np.minimum(both, 0)) * on[:, 1:, None, None]
            slope = np.concatenate([np.einsum("ntf,ntk->fk", x, p - chosen).ravel(), (q.sum(axis=(0, 1)) - pairs).ravel()])
            slope = slope / on.sum() + RIDGE * theta
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
            theta = theta - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        return cls(theta[:-4].reshape(FEATURES, 2), theta[-4:].reshape(2, 2))

    def decode(self, features: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The likeliest marks of all lines; sequence i has ``count[i]`` lines from ``first[i]``. Ties: content."""
        e = features @ self.weights
        back = np.zeros((len(e), 2), dtype=np.int8)
        marks = np.zeros(len(e), dtype=np.int8)
        order = np.argsort(-count, kind="stable")
        order = order[count[order] > 0]
        if not len(order):
            return marks
        live = np.searchsorted(-count[order], -np.arange(1, count[order[0]] + 1), side="right")
        score = e[first[order]]
        for t in range(1, len(live)):
            k = live[t]
            at = first[order[:k]] + t
            ways = score[:k, :, None] + self.moves
            back[at] = ways[:, 1] > ways[:, 0]
            score[:k] = ways.max(axis=1) + e[at]
        state = (score[:, 1] > score[:, 0]).astype(np.int8)
        for t in range(len(live) - 1, -1, -1):
            k = live[t]
            at = first[order[:k]] + t
            marks[at] = state[:k]
            if t:
                state[:k] = back[at, state[:k]]
        return marks


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, train_docs: int = TRAIN_DOCS) -> Field:
    """The field, from at most ``train_docs`` documents with a quality label (by the hash of their id)."""
    rated = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = scan.encoded(frame["text"])
            rows = []
            for part in by_bytes(np.array([len(t) for t in texts]), scan.BLOCK):
                lines = Lines(texts[part])
                rows += [(int(c), lines.features[f : f + c].tobytes()) for f, c in zip(lines.first, lines.count)]
            units, features = zip(*rows) if rows else ((), ())
            yield pd.DataFrame({"at": frame["at"], "q": frame["q"], "units": units, "f": features})

    described = labelled(docs, rated, key, text).mapInPandas(describe, "at long, q int, units long, f binary")
    lines, marks = [], []
    for r in whole_rows(described.where("units > 0"), TRAIN_LINES):
        own = np.frombuffer(r.f).reshape(-1, FEATURES)
        for at in range(0, len(own), SEQUENCE):
            lines.append(own[at : at + SEQUENCE])
            marks.append(suspicious(lines[-1]).astype(int) * (1 - r.q))
    return Field.fitted(lines, marks)


ADDED = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "content_share": "double",
    "base_failed": "boolean",
    "kept": "boolean",
}


def verdicts(texts, field: Field, least_share: float) -> pd.DataFrame:
    """The columns of ``ADDED`` for each text."""
    raw, out = scan.encoded(texts), []
    for part in by_bytes(np.array([len(t) for t in raw]), scan.BLOCK):
        lines = Lines(raw[part])
        marks = field.decode(lines.features, lines.first, lines.count)
        content = lines._per_doc(lines.words * (marks == 0), len(lines.n_words))
        n = lines.n_words
        share = np.where(n > 0, content / np.maximum(n, 1), 0.0)
        failed = (n < LEAST_WORDS) | (100 * lines.n_repeat_words > MOST_REPEATED * n)
        kept = ~failed & (share >= least_share)
        held = (n, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words, share, failed, kept)
        out.append(pd.DataFrame(dict(zip(ADDED, held))))
    return pd.concat(out, ignore_index=True)


def judged(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text", least_share: float = LEAST_SHARE) -> DataFrame:
    """(key, counts, ``content_share``, ``base_failed``, ``kept``) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def step(frame: pd.DataFrame) -> pd.DataFrame:
        got = verdicts(frame[text], shared.value, least_share)
        got.insert(0, key, frame[key].to_numpy())
        return got

    schema = f"{key} {dict(docs.dtypes)[key]}, " + ", ".join(f"{n} {k}" for n, k in ADDED.items())
    return docs.select(key, text).mapInPandas(per_frame(step), schema)


def filtered(docs: DataFrame, field: Field, text: str = "text", least_share: float = LEAST_SHARE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = verdicts(batch.column(text).to_pylist(), shared.value, least_share)["kept"]
                yield batch.filter(pa.array(kept.to_numpy()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(docs, fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text"))
