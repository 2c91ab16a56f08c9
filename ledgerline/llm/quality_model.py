"""Quality classifier by attention over a document's passages (multiple-instance learning).

Only documents carry labels. Every passage of ``PASSAGE_WORDS`` words is encoded by a small network; a gated
attention weighs the encodings, and the weighted mean gives the document's probability of label 1. The model is
fitted by gradient descent in numpy on the driver to at most ``train_docs`` labelled documents, all passages of each,
as long as they have ``TRAIN_PASSAGES`` passages together, then scores every whole text in the tasks that read it.

* Null and empty texts: one passage without words, which gets a score as any other. Very long texts: all their
  passages are scored; a labelled one that does not fit the allowance is not learnt from.
* Empty table: no rows.
* No labelled training document, or one label only: the score is the share of label 1, 0.5 without any.
* Documents whose labels contradict each other count with the smaller one. Repeated rows: one result each; an id is
  learnt from once, however many rows have it.
* Columns beside the id and the text are ignored: label, language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import scan
from ledgerline.llm.common import by_bytes, labelled, per_frame, table, whole_rows
from ledgerline.llm.line_rules import _DIGIT, _LOWER, _POINT, _SHOUT, _SYMBOL, _UPPER

PASSAGE_WORDS = 96
BUCKETS = 32
#: Labelled documents that the model is fitted to, and passages of all of them; a document takes part whole or not at all.
TRAIN_DOCS, TRAIN_PASSAGES = 4_000, 200_000
HIDDEN, STEPS, RATE, RIDGE = 16, 300, 0.02, 1e-4
PLAIN = 14
FEATURES = PLAIN + BUCKETS


class Passages:
    """Passages of a batch of texts: ``features`` per passage, ``first`` and ``count`` per text."""

    def __init__(self, texts: list[bytes]):
        data, at = scan.joined(texts)
        n = len(texts)
        w0, w1, wh = scan.words(data)
        doc = np.searchsorted(at, w0, side="right") - 1
        first_word = np.searchsorted(doc, np.arange(n))
        n_words = np.bincount(doc, minlength=n)
        self.count = np.maximum(-(-n_words // PASSAGE_WORDS), 1)
        self.first = np.cumsum(self.count) - self.count
        total = int(self.count.sum())
        self.features = np.zeros((total, FEATURES))
        if not len(w0):
            return
        passage = self.first[doc] + (np.arange(len(w0)) - first_word[doc]) // PASSAGE_WORDS
        words = np.bincount(passage, minlength=total)
        some = np.maximum(words, 1)

        def share(values: np.ndarray) -> np.ndarray:
            return np.bincount(passage, weights=values, minlength=total)

        def marked(mask: np.ndarray) -> np.ndarray:
            return np.add.reduceat(mask[data], w0, dtype=np.int64)  # the spaces after a word hold no marks

        size = w1 - w0
        upper, lower, symbol = marked(_UPPER), marked(_LOWER), marked(_SYMBOL)
        three = scan.grams(wh, 3)
        repeated = np.zeros(len(w0))
        ok = np.flatnonzero(doc[2:] == doc[:-2])
        if len(ok):
            _, back, times = np.unique(three[ok] ^ scan.mixed(doc[ok].astype(np.uint64)), return_inverse=True, return_counts=True)
            repeated[ok] = times[back] > 1
        own = np.unique(wh ^ scan.mixed(passage.astype(np.uint64)), return_index=True)[1]
        distinct = np.bincount(passage[own], minlength=total)
        breaks = np.zeros(len(w0))
        part = np.zeros(len(data), dtype=bool)
        part[at[1:] - 1] = True  # the line ends between texts
        feeds = np.flatnonzero((data == 10) & ~part)
        near = np.searchsorted(w0, feeds, side="right") - 1
        feeds, near = feeds[near >= 0], near[near >= 0]
        near = near[np.searchsorted(at, feeds, side="right") - 1 == doc[near]]
        breaks += np.bincount(near, minlength=len(w0))
        letters = np.maximum(share(upper) + share(lower), 1)
        bytes_ = np.maximum(share(size), 1)
        plain = [
            np.log1p(words),
            share(upper) / letters,
            share(symbol) / some,
            share(symbol > 0) / some,
            share(marked(_SHOUT)) / some,
            share(marked(_DIGIT)) / bytes_,
            share(marked(_POINT)) / some,
            share(size) / some,
            np.sqrt(np.maximum(share(size * size) / some - (share(size) / some) ** 2, 0)),
            share(size <= 3) / some,
            share(size > 15) / some,
            distinct / some,
            share(repeated) / some,
            share(breaks) / some,
        ]
        self.features[:, :PLAIN] = np.stack(plain, axis=1)
        cell = passage * BUCKETS + (wh % np.uint64(BUCKETS)).astype(np.int64)
        self.features[:, PLAIN:] = np.bincount(cell, minlength=total * BUCKETS).reshape(total, BUCKETS) / some[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Encoder, gated attention and read-out."""

    NAMES = ("W", "b", "V", "bv", "U", "bu", "w", "c", "d")

    def __init__(self, share: float, mean: np.ndarray, scale: np.ndarray, theta: dict[str, np.ndarray] | None):
        self.share, self.mean, self.scale, self.theta = share, mean, scale, theta

    def _forward(self, x: np.ndarray, first: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
        t = self.theta
        h = np.tanh(x @ t["W"] + t["b"])
        a, g = np.tanh(h @ t["V"] + t["bv"]), _sigmoid(h @ t["U"] + t["bu"])
        s = (a * g) @ t["w"]
        owner = np.repeat(np.arange(len(first)), count)
        e = np.exp(s - np.maximum.reduceat(s, first)[owner])
        alpha = e / np.add.reduceat(e, first)[owner]
        z = np.add.reduceat(alpha[:, None] * h, first, axis=0)
        return {"h": h, "a": a, "g": g, "alpha": alpha, "z": z, "owner": owner, "p": _sigmoid(z @ t["c"] + t["d"])}

    def score(self, features: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each document."""
        if self.theta is None:
            return np.full(len(first), self.share)
        return self._forward((features - self.mean) / self.scale, first, count)["p"]

    @classmethod
    def fitted(cls, bags: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> Model:
        if not len(labels) or labels.min() == labels.max():
            return cls(float(labels.mean()) if len(labels) else 0.5, np.zeros(FEATURES), np.ones(FEATURES), None)
        x = np.concatenate(bags)
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - mean) / scale
        count = np.array([len(b) for b in bags])
        first = np.cumsum(count) - count
        random = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return random.normal(0, 1 / np.sqrt(shape[0]), shape)

        theta = {
            "W": start(FEATURES, HIDDEN),
            "b": np.zeros(HIDDEN),
            "V": start(HIDDEN, HIDDEN),
            "bv": np.zeros(HIDDEN),
            "U": start(HIDDEN, HIDDEN),
            "bu": np.zeros(HIDDEN),
            "w": start(HIDDEN),
            "c": start(HIDDEN),
            "d": np.zeros(()),
        }
        model = cls(float(labels.mean()), mean, scale, theta)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in theta.items()}
        for step in range(1, steps + 1):
            f = model._forward(x, first, count)
            h, a, g, alpha, owner = (f[k] for k in ("h", "a", "g", "alpha", "owner"))
            out = (f["p"] - labels) / len(labels)
            dz = (out[:, None] * theta["c"])[owner]
            pull = (h * dz).sum(axis=1)
            ds = alpha * (pull - np.add.reduceat(alpha * pull, first)[owner])
            dag = ds[:, None] * theta["w"]
            da, dg = dag * g * (1 - a * a), dag * a * g * (1 - g)
            dh = (alpha[:, None] * dz + da @ theta["V"].T + dg @ theta["U"].T) * (1 - h * h)
            slopes = {
                "W": x.T @ dh,
                "b": dh.sum(axis=0),
                "V": h.T @ da,
                "bv": da.sum(axis=0),
                "U": h.T @ dg,
                "bu": dg.sum(axis=0),
                "w": (a * g).T @ ds,
                "c": f["z"].T @ out,
                "d": out.sum(),
            }
            for k, slope in slopes.items():
                slope = slope + RIDGE * theta[k]
                m, v = moment[k]
                m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
                moment[k] = (m, v)
                theta[k] = theta[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return model


def held_out(key: str) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, train_docs: int = TRAIN_DOCS) -> Model:
    """The model, from at most ``train_docs`` labelled documents outside the held-out third (by the hash of their id)."""
    rated = labels.where("doc_id is not null and quality is not null").where(~held_out("doc_id"))
    rated = rated.groupBy("doc_id").agg(F.min("quality").alias("q"))
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, rows = scan.encoded(frame["text"]), []
            for part in by_bytes(np.array([len(t) for t in texts]), scan.BLOCK):
                got = Passages(texts[part])
                rows += [(int(c), got.features[f : f + c].astype("f4").tobytes()) for f, c in zip(got.first, got.count)]
            units, features = zip(*rows) if rows else ((), ())
            yield pd.DataFrame({"at": frame["at"], "q": frame["q"], "units": units, "f": features})

    described = labelled(docs, rated, key, text).mapInPandas(describe, "at long, q int, units long, f binary")
    got = whole_rows(described, TRAIN_PASSAGES)
    bags = [np.frombuffer(r.f, dtype="f4").reshape(-1, FEATURES).astype(float) for r in got]
    return Model.fitted(bags, np.array([float(r.q) for r in got]))


def scores(texts, model: Model) -> np.ndarray:
    """Probability of label 1 for each text."""
    raw, out = scan.encoded(texts), []
    for part in by_bytes(np.array([len(t) for t in raw]), scan.BLOCK):
        got = Passages(raw[part])
        out.append(model.score(got.features, got.first, got.count))
    return np.concatenate(out)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: frame[key], "score": scores(frame[text], shared.value)})

    out = docs.select(key, text).mapInPandas(per_frame(step), f"{key} {dict(docs.dtypes)[key]}, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def filtered(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(scores(batch.column(text).to_pylist(), shared.value) >= least))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text")
    return scored(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
