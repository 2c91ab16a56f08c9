"""Counts of every word of a corpus, and from them each document's unigram score.

A task counts the words of a batch of documents by 64-bit hash and sends each shuffle partition the hashes that fall
to it, with the documents they occur in, as one compressed row. The partition adds up the counts of its words over
all batches and answers with each document's share of the score. So no list of words is gathered anywhere, and a
frequent word costs a partition one entry per batch and document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import scan
from ledgerline.llm.bytepair import ragged
from ledgerline.llm.common import by_bytes, saved, tasks

#: Bytes of text whose words are counted together.
BATCH = 1 << 23


def lowered(texts) -> list[bytes]:
    """UTF-8 with A-Z in lower case."""
    return [t.lower() for t in scan.encoded(texts)]


def _pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Compressed arrays, of each number the first bytes of all values together, then the second ones, and so on."""
    head = np.array([len(arrays), *[len(a) for a in arrays]], dtype=np.int64)
    kinds = "".join(a.dtype.str[1:] for a in arrays).encode().ljust(16)
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=level).compress(head.tobytes() + kinds + b"".join(planes))


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
    sizes = np.frombuffer(raw, dtype=np.int64, count=n, offset=8)
    at = 8 + 8 * n
    kinds = raw[at : at + 16].decode().strip()
    at, out = at + 16, []
    for i, size in enumerate(sizes):
        kind = np.dtype(kinds[2 * i : 2 * i + 2])
        planes = np.frombuffer(raw, dtype=np.uint8, count=int(size) * kind.itemsize, offset=at)
        at += planes.nbytes
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind))
    return out


def requests(docs: DataFrame, parts: int) -> DataFrame:
    """(part, batch, blob) rows from (mark, train, text): words of a batch by shuffle partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = lowered(frame["text"])
            marks, train = frame["mark"].to_numpy(np.int64), frame["train"].to_numpy(bool)
            for piece in by_bytes(np.array([len(t) for t in texts]), BATCH):
                data, at = scan.joined(texts[piece])
                w0, _, wh = scan.words(data)
                if not len(w0):
                    continue
                doc = np.searchsorted(at, w0, side="right") - 1
                known, word = np.unique(wh, return_inverse=True)
                own = train[piece]
                learnt = np.bincount(word, weights=own[doc], minlength=len(known)).astype(np.uint32)
                part = (known % np.uint64(parts)).astype(np.int64)
                pair, times = np.unique(word * np.int64(len(own)) + doc, return_counts=True)
                word, doc = pair // len(own), (pair % len(own)).astype(np.uint32)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                first = np.searchsorted(word, np.arange(len(known) + 1))
                rows, batch = [], int(np.frombuffer(hashlib.blake2b(marks[piece].tobytes(), digest_size=8).digest(), dtype=np.int64)[0])
                for p in range(parts):
                    w = order[cuts[p] : cuts[p + 1]]
                    if not len(w):
                        continue
                    size = first[w + 1] - first[w]
                    at_ = ragged(first[w], size)
                    local, short = np.unique(doc[at_], return_inverse=True)
                    blob = _pack(known[w], learnt[w], size.astype(np.uint32), short.astype(np.uint32), times[at_].astype(np.uint32), marks[piece][local])
                    rows.append((p, batch, blob))
                yield pd.DataFrame(rows, columns=["part", "batch", "blob"])

    return docs.select("mark", "train", "text").mapInPandas(run, "part int, batch long, blob binary")


def answers(sent: DataFrame, parts: int) -> DataFrame:
    """(batch, blob): each request's sums by document, over the words of one partition; ``batch`` names the documents.

    ``base`` adds up log10(count + 0.5) over a document's words, ``known`` those of a count above 0. The row without
    a batch holds the partition's number of distinct training words.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for frame in frames for b in zip(frame["batch"].tolist(), frame["blob"])]
        if not rows:
            return
        held = [_unpack(b)[:2] for _, b in rows]
        words, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([h[1] for h in held]), minlength=len(words))
        del held, back
        logs = np.log10(counts + 0.5)
        for batch, blob in rows:
            own, _, size, doc, times, marks = _unpack(blob)
            at = np.repeat(np.searchsorted(words, own), size)
            base = np.bincount(doc, weights=times * logs[at], minlength=len(marks))
            known = np.bincount(doc, weights=times * (counts[at] > 0), minlength=len(marks)).astype(np.int64)
            yield pd.DataFrame({"batch": [batch], "blob": [_pack(marks, base, known)]}).astype({"batch": "Int64"})
        distinct = _pack(np.array([(counts > 0).sum()], dtype=np.int64))
        yield pd.DataFrame({"batch": [None], "blob": [distinct]}).astype({"batch": "Int64"})

    return sent.repartition(parts, "part").mapInPandas(run, "batch long, blob binary")


def added(answered: DataFrame, parts: int) -> DataFrame:
    """(mark, base, known, distinct): the answers added up by document, and the number of distinct words (no mark)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for frame in frames for b in zip(frame["batch"].astype("Int64").tolist(), frame["blob"])]
        distinct = sum(int(_unpack(b)[0][0]) for batch, b in rows if batch is pd.NA)
        yield pd.DataFrame({"mark": [None], "base": [None], "known": [None], "distinct": [distinct]})
        for batch in sorted({batch for batch, _ in rows if batch is not pd.NA}):
            held = [_unpack(b) for other, b in rows if other is not pd.NA and other == batch]
            marks, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            base = np.bincount(back, weights=np.concatenate([h[1] for h in held]))
            known = np.bincount(back, weights=np.concatenate([h[2] for h in held])).astype(np.int64)
            yield pd.DataFrame({"mark": marks, "base": base, "known": known, "distinct": None})

    dealt = answered.repartition(parts, "batch")
    return dealt.mapInPandas(run, "mark long, base double, known long, distinct long")


def unigram(docs: DataFrame) -> tuple[DataFrame, int]:
    """(mark, base, known) of every document of (mark, train, text), and the number of distinct training words.

    ``mark`` names the document; rows with the same mark must be equal, and their sums count all of them together.
    """
    parts = tasks(docs.sparkSession)
    got = added(answers(requests(docs, parts), parts), parts)
    got = saved(got.groupBy("mark").agg(*[F.sum(c).alias(c) for c in ("base", "known", "distinct")]))
    distinct = got.where("mark is null").agg(F.sum("distinct")).first()[0] or 0
    return got.where("mark is not null").drop("distinct"), int(distinct)
