"""Language-model scores of whole texts.

A text is its words in lower case (A-Z), each with one blank before it and encoded by itself, as subword ids of a public
vocabulary, and an end. Ids are made once and kept. ``fit`` counts the ids of all training documents and trains the attention model
(``attention.py``) on all of them: in each of ``ROUNDS`` rounds every task takes gradient steps on its share of the
texts, each text in one round; the tasks' weights are averaged, and the model's word distributions are estimated from
the duties of all words of the round. No text reaches the driver. The weights depend on how the input is dealt into
partitions. ``scored`` runs all windows of every text through the model. ``word_counts`` gives the unigram base over all
training documents.

* Null and empty texts: no words, the end alone is scored. Null ids count as training documents.
* Very long texts: a row holds a text and its ids, and the windows of one text are held at a time.
* Repeated rows: each learns and each gets a result; rows that share an id but not the text are told apart.
* No training document: counts are zero, the model is the untrained one over equally likely ids. An empty table gives none.
* Columns beside the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import scan
from ledgerline.llm.attention import BATCH, STEP, STRIDE, WINDOW, Attention, Front, Steps, Vocabulary, Windows
from ledgerline.llm.bpe_codec import VOCABULARY, encoder
from ledgerline.llm.bytepair import SLICE, merges, ragged
from ledgerline.llm.common import by_bytes, saved, table
from ledgerline.llm.word_counts import lowered, unigram

SHOWN, ROUNDS, RATE = 4_096, 4, 0.04
#: Numbers in a piece of a task's answer, and input partitions that a training task reads.
PIECE, GATHERED = 1 << 12, 8
#: Ids whose windows are held together.
HELD = 1 << 20


def held_out(key: str) -> Column:
    """Rows that nothing is learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 1, F.lit(False))


class Speller:
    """Ids of words by their hash. Words met before are in a table of fixed size, of which a new word takes the place of
    another; what it does not hold is encoded again. Different words with one 64-bit hash would be taken for one."""

    BITS, ROOM = 20, 1 << 22

    def __init__(self, vocabulary: str):
        self.encoder = encoder(None, vocabulary)
        self._clear(self.ROOM)

    def _clear(self, room: int) -> None:
        self._key = np.zeros(1 << self.BITS, dtype=np.uint64)
        self._at, self._size = np.zeros((2, 1 << self.BITS), dtype=np.int32)
        self._flat, self._used = np.zeros(room, dtype=np.int32), 0

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words ``data[start:end]``, each with one blank before it, and how many each has."""
        slot = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        at, size = self._at[slot], self._size[slot]
        missed = np.flatnonzero((self._key[slot] != hashes) | (size == 0))
        if len(missed):
            new, first, which = np.unique(hashes[missed], return_index=True, return_inverse=True)
            first = missed[first]
            words = [(b" " + data[s:e].tobytes()).decode("utf-8", "replace") for s, e in zip(starts[first], ends[first])]
            held, counts = self.encoder.encode(words)
            if self._used + len(held) > len(self._flat):
                # All words are forgotten. A word has no more ids than bytes.
                self._clear(max(self.ROOM, int((ends - starts + 1).sum())))
                return self.ids(data, starts, ends, hashes)
            here = self._used + np.cumsum(counts) - counts
            self._flat[self._used : self._used + len(held)] = held
            self._used += len(held)
            to = (new >> np.uint64(64 - self.BITS)).astype(np.int64)
            self._key[to], self._at[to], self._size[to] = new, here, counts
            at[missed], size[missed] = here[which], counts[which]
        return self._flat[ragged(at, size)], size


@lru_cache(maxsize=1)
def speller(vocabulary: str) -> Speller:
    """The process's table of words; kept between tasks."""
    return Speller(vocabulary)


def encode(texts, vocabulary: str) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of texts with the ids of their words and how many each text has."""
    for part, ids, counts, _ in spelled(texts, vocabulary):
        yield part, ids, counts


def spelled(texts, vocabulary: str) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """As ``encode``, with the number of words of each text."""
    own, texts = speller(vocabulary), lowered(texts)
    for part in by_bytes([len(t) for t in texts], SLICE):
        data, at = scan.joined(texts[part])
        starts, ends, hashes = scan.words(data)
        ids, size = own.ids(data, starts, ends, hashes)
        first = np.searchsorted(starts, at)
        last = np.concatenate([[0], np.cumsum(size)])[first]
        yield part, ids, np.diff(last), np.diff(first)


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows with a text, with its ``ids`` (little-endian, two or four bytes each) and ``n_words`` in its place."""
    kind = _id_type(vocabulary)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, ids, counts, words in spelled(frame["text"], vocabulary):
                ends = np.cumsum(counts)
                ids = ids.astype(kind)
                held = [ids[e - n : e].tobytes() for e, n in zip(ends, counts)]
                yield frame.iloc[part].drop(columns="text").assign(ids=held, n_words=words)

    kept = ", ".join(f"`{n}` {k}" for n, k in docs.dtypes if n != "text")
    return docs.mapInPandas(run, f"{kept}, ids binary, n_words long")


def _id_type(vocabulary: str) -> str:
    return "<u2" if merges(public_tokenizers.path(vocabulary)).size < 1 << 16 else "<u4"


def held_ids(rows, vocabulary: str) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of rows of stored ids with their ids and how many each row has."""
    kind = np.dtype(_id_type(vocabulary))
    rows = list(rows)
    sizes = np.array([len(r) // kind.itemsize for r in rows], dtype=np.int64)
    for part in by_bytes(sizes, HELD):
        yield part, np.frombuffer(b"".join(rows[part]), dtype=kind).astype(np.int32), sizes[part]


class Scorer:
    """A fitted model with its vocabulary; ``end`` is the id after the vocabulary's last."""

    def __init__(self, model: Attention, words: Vocabulary, end: int, vocabulary: str):
        self.model, self.words, self.end, self.vocabulary = model, words, end, vocabulary

    @cached_property
    def looked_up(self) -> tuple[np.ndarray, Front]:
        """What scoring looks up; made where it is used, not sent."""
        return self.model.tables(), self.model.front()

    def windows(self, ids: np.ndarray, counts: np.ndarray, **steps: int) -> Windows:
        """Windows of entries."""
        return Windows.of(self.words.place[ids], counts, int(self.words.place[self.end]), **steps)

    def of_ids(self, rows) -> np.ndarray:
        """log10 probability of each row of stored ids."""
        out, (tables, front) = [], self.looked_up
        for _, ids, counts in held_ids(rows, self.vocabulary):
            w = self.windows(ids, counts)
            sums = np.zeros(len(w.doc))
            # A text's first window scores all its targets, each later one those that are new.
            for since, own in ((0, np.flatnonzero(w.scored[:, 0])), (WINDOW - STRIDE, np.flatnonzero(~w.scored[:, 0]))):
                for at in range(0, len(own), BATCH):
                    # The last batch is filled up: a product's rounding depends on its number of rows, and equal windows
                    # must score the same in every batch. For the same reason a text's windows are added up at once.
                    cut = own[np.minimum(np.arange(at, at + BATCH), len(own) - 1)]
                    logs = self.model.logs(w.inputs[cut], w.targets[cut, since:], tables, front, since)
                    sums[cut] = (logs * w.scored[cut, since:]).sum(axis=1, dtype=float)
            shares = np.bincount(np.repeat(np.arange(len(counts)), counts), self.words.share[ids], len(counts))
            out.append(np.bincount(w.doc, sums, len(counts)) + shares + self.words.share[self.end])
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, texts) -> np.ndarray:
        """log10 probability of each text."""
        kind = _id_type(self.vocabulary)
        parts = encode(texts, self.vocabulary)
        return self.of_ids([x.astype(kind).tobytes() for _, ids, n in parts for x in np.split(ids, np.cumsum(n)[:-1])])


def _pieces(vector: np.ndarray, weight: float) -> pd.DataFrame:
    """A task's vector in rows of ``PIECE`` numbers."""
    rows = [(i, vector[at : at + PIECE].tobytes(), weight) for i, at in enumerate(range(0, len(vector), PIECE))]
    return pd.DataFrame(rows, columns=["k", "sums", "weight"])


def _added(texts: DataFrame, task, kind: str) -> tuple[np.ndarray, float]:
    """Weighted sum of the vectors of numbers of ``kind`` that the tasks send in pieces, and the sum of the weights.
    Pieces are added as they arrive, so a task holds its sums and one batch of pieces, however many tasks send some."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for frame in frames:
            for k, piece, weight in zip(frame["k"], frame["sums"], frame["weight"]):
                own = np.frombuffer(piece, dtype=kind).astype("f8") * weight
                held = sums.setdefault(int(k), [np.zeros(len(own)), 0.0])
                held[0] += own
                held[1] += weight
        rows = [(k, total.tobytes(), weight) for k, (total, weight) in sums.items()]
        yield pd.DataFrame(rows, columns=["k", "sums", "weight"])

    schema = "k int, sums binary, weight double"
    got = texts.mapInPandas(task, schema).repartition("k").mapInPandas(add, schema).collect()
    got.sort(key=lambda r: r.k)
    return np.concatenate([np.frombuffer(bytes(r.sums)) for r in got] or [np.zeros(0)]), got[0].weight if got else 0.0


def learnt(rows: DataFrame) -> DataFrame:
    """(mark, ids) of all training documents, several input partitions to a task: each task answers with a model."""
    rows = rows.where("train").select("mark", "ids")
    parts = rows.rdd.getNumPartitions()
    return rows.coalesce(max(1, parts // GATHERED, min(parts, rows.sparkSession.sparkContext.defaultParallelism)))


def counted(texts: DataFrame, end: int, vocabulary: str) -> np.ndarray:
    """How often each id, the end included, occurs in all training documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(end + 1)
        for frame in frames:
            for _, ids, counts in held_ids(frame["ids"], vocabulary):
                count += np.bincount(ids, minlength=len(count))
                count[end] += len(counts)
        if count.any():
            yield _pieces(count, 1.0)

    total, _ = _added(texts, run, "f8")
    return total if len(total) else np.zeros(end + 1)


def trained(texts: DataFrame, scorer: Scorer, pace: float, mix: float, turn: int) -> Scorer:
    """The model after one round: each task takes gradient steps on all windows of its texts, beginning with the same
    weights. The new weights are the means of theirs, by windows; the new distributions are what all words of the
    round, by the duties found in those steps, make of them."""
    shared = texts.sparkSession.sparkContext.broadcast(scorer)
    shapes = {**{k: v.shape for k, v in scorer.model.theta.items()}, "duty": scorer.model.share.shape}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, random, seen = shared.value, np.random.default_rng(turn), 0
        model = Attention({k: v.copy() for k, v in own.model.theta.items()}, own.model.share)
        steps = Steps(model, pace, mix)
        for frame in frames:
            for _, ids, counts in held_ids(frame["ids"], own.vocabulary):
                w = own.windows(ids, counts, stride=WINDOW)
                order = random.permutation(len(w.doc))
                seen += len(order)
                for at in range(0, len(order), STEP):
                    rows = order[at : at + STEP]
                    steps.take(w.inputs[rows], w.targets[rows], w.scored[rows])
        if seen:
            steps.settle()
            found = [*(model.theta[k].ravel() for k in model.theta), steps.duty.ravel() / seen]
            yield _pieces(np.concatenate(found).astype("f4"), float(seen))

    total, weight = _added(texts, run, "f4")
    if not weight:
        return scorer
    ends = np.cumsum([int(np.prod(s)) for s in shapes.values()])
    parts = {k: x.reshape(s) for (k, s), x in zip(shapes.items(), np.split(total / weight, ends[:-1]))}
    duty = parts.pop("duty")
    model = Attention({k: x.astype(np.float32) for k, x in parts.items()}, duty / duty.sum())
    return Scorer(model, scorer.words, scorer.end, scorer.vocabulary)


def fit(rows: DataFrame, rounds: int = ROUNDS, vocabulary: str = VOCABULARY) -> Scorer:
    """The model from all training rows of (mark, train, ids): the shown ids are the most frequent of all texts, and
    every text takes part in the gradient steps of one of the ``rounds``, by its hash."""
    texts = learnt(rows)
    end = merges(public_tokenizers.path(vocabulary)).size
    count = counted(texts, end, vocabulary)
    words = Vocabulary.of(count, SHOWN)
    entry = np.bincount(words.place, weights=count + 0.1, minlength=words.entries)
    scorer = Scorer(Attention.new(entry / entry.sum()), words, end, vocabulary)
    for turn in range(rounds):
        own = texts.where(F.pmod(F.xxhash64("mark"), F.lit(rounds)) == turn)
        scorer = trained(own, scorer, RATE * (1 - 0.9 * turn / rounds), 0.2 / (1 + 2 * turn), turn)
    return scorer


def scored(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, mark, n_words, score) of every row of (doc_id, mark, n_words, ids)."""
    shared = rows.sparkSession.sparkContext.broadcast(scorer)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["doc_id", "mark", "n_words"]].assign(score=shared.value.of_ids(frame["ids"]))

    kind = dict(rows.dtypes)["doc_id"]
    rows = rows.select("doc_id", "mark", "n_words", "ids")
    return rows.mapInPandas(run, f"doc_id {kind}, mark long, n_words long, score double")


def language_scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("doc_id", "text")).withColumn("train", ~held_out("doc_id"))
    kept = saved(encoded(rows))
    results = scored(kept, fit(kept))
    per_mark, distinct = unigram(rows)
    results = saved(results)
    sums = results.where(~held_out("doc_id")).agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    ends, tokens = sums[0], sums[0] + sums[1]
    spread = float(np.log10(tokens + 0.5 * (distinct + (ends > 0) + 1)))
    copies = results.groupBy("mark").agg(F.count("*").alias("copies"))
    per_mark = copies.join(per_mark, "mark", "left")
    joined = results.join(per_mark, "mark")
    base = F.coalesce(F.col("base"), F.lit(0.0)) / F.col("copies") + float(np.log10(ends + 0.5))
    known = (F.coalesce(F.col("known"), F.lit(0)) / F.col("copies")).cast("long")
    return joined.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        (F.col("n_words") + 1).alias("n_tokens"),
        (known + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (base - (F.col("n_words") + 1) * spread).alias("base_score"),
        "score",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))
