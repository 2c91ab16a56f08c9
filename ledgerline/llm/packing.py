"""Packing of tokenised documents into fixed-length sequences, best fit decreasing.

A document longer than a sequence is first cut into full windows; its rest, like every shorter document, is one
piece. Pieces are dealt at random, by a hash of document and start, into groups of about ``per_group``; each group is
packed on its own, its longest piece first, into the open sequence that it fills most tightly. A segment tree over
the remaining capacities finds that sequence in a number of steps that depends on the capacity only. Every group
leaves few sequences partly filled, so the padding stays small however many groups there are.

* Null text: as empty. With the closing id every document has at least one id, hence a piece.
* Repeated documents: each row is packed; equal pieces are told apart by their order. Null ids pack like others.
* Ties in length: the smaller id, then the smaller start, goes first. Empty table: no rows.
* Columns beside the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.bpe_codec import VOCABULARY, encode_batches
from ledgerline.llm.bytepair import whole
from ledgerline.llm.common import saved, table

CAPACITY = 2048
END_ID = 1
#: Pieces that are packed together: what a packing task holds.
PER_GROUP = 20_000


class OpenSequences:
    """Open sequences by remaining capacity: a segment tree of how many there are below each node."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.held: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, left: int, sequence: int) -> None:
        self.held[left].append(sequence)
        self._change(left, 1)

    def _change(self, left: int, by: int) -> None:
        node, count = left + self.size, self.count
        while node:
            count[node] += by
            node >>= 1

    def tightest(self, need: int) -> int:
        """The smallest remaining capacity of at least ``need`` that an open sequence has, or -1."""
        node, count = need + self.size, self.count
        if not count[node]:
            while node and (node & 1 or not count[node + 1]):
                node >>= 1
            if not node:
                return -1
            node += 1
            while node < self.size:
                node *= 2
                if not count[node]:
                    node += 1
        return node - self.size

    def take(self, left: int) -> int:
        self._change(left, -1)
        return self.held[left].pop()


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; the pieces come longest first."""
    opened, n = OpenSequences(capacity), 0
    sequences, offsets = [], []
    for length in lengths:
        left = opened.tightest(length)
        if left < 0:
            left, sequence = capacity, n
            n += 1
        else:
            sequence = opened.take(left)
        sequences.append(sequence)
        offsets.append(capacity - left)
        if left > length:
            opened.add(left - length, sequence)
    return sequences, offsets


def pieces(docs: DataFrame, key: str, text: str, capacity: int, vocabulary: str) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens): full windows of ``capacity`` ids from the front, then the rest."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, out = frame[key].tolist(), []
            for i, ids in encode_batches(whole(frame[text]), None, vocabulary):
                held = np.append(ids, END_ID).astype("<u4").tobytes()
                n = len(held) // 4
                for start in range(0, n, capacity):
                    part = held[4 * start : 4 * (start + capacity)]
                    out.append((keys[i], start, len(part) // 4, zlib.crc32(part), n))
            got = pd.DataFrame(out, columns=[key, "start", "length", "ids_crc32", "doc_tokens"])
            yield got.astype({key: "Int64"}) if str(frame[key].dtype).lower().startswith(("int", "float")) else got

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInPandas(
        run, f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    )


def packed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    per_group: int = PER_GROUP,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Pieces of every document with ``sequence_id`` and ``offset``; ids are read again with ``bpe_codec.encoded``.

    Only the pieces' numbers travel, never ids. ``sequence_id`` is the group's number times 2**32 plus the
    sequence's number in its group. A full window fills a sequence of its own.
    """
    cut = saved(pieces(docs, key, text, capacity, vocabulary))
    groups = max(1, -(-cut.count() // per_group))
    names = [key, "start", "length", "ids_crc32", "doc_tokens"]
    schema = ", ".join(f"`{n}` {k}" for n, k in cut.select(*names).dtypes) + ", sequence_id long, offset long"

    def fill(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", key, "start"], ascending=[False, True, True], kind="stable")
        sequences, offsets = best_fit(frame["length"].tolist(), capacity)
        base = int(group[0]) << 32
        return frame[names].assign(sequence_id=[base + s for s in sequences], offset=offsets)

    dealt = cut.withColumn("_group", F.pmod(F.xxhash64(key, "start", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(fill, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
