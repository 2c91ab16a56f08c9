"""BPE encoding and decoding of whole texts with a lexicon of frequent words.

``frequent_words`` counts the words of all texts; the most frequent are compiled into a minimal acyclic transducer
(``lexicon.py``) whose file goes to the shared folder and from there, by ``addFile``, to every executor, also to one
that joins later. ``encoded`` looks words up in it and merges all others exactly, so the ids do not depend on which
words the lexicon holds.

* Null text: as empty, no ids. Empty table: no rows. Repeated rows: one result each.
* A text is held whole, with its ids, by the task that encodes it; texts are taken about half a million characters at a time.
* The vocabulary's special tokens count as such in a text, as in the tokenizer library's default.
* Columns beside the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.bytepair import Encoder, Words, merges, ragged, slices, whole
from ledgerline.llm.common import saved, table
from ledgerline.llm.lexicon import Lexicon, compiled
from ledgerline.session import fresh_dir

VOCABULARY = "byte_bpe_50k.json"
#: Words in the lexicon: the bound on what is gathered on the driver.
LEXICON_WORDS = 50_000


def _count(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = merges(public_tokenizers.path(vocabulary)).special
        for batch in batches:
            texts = whole(batch.column(0).to_pylist())
            for part in slices(texts):
                words = Words(texts[part], special)
                _, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
                starts, size = words.starts[first], (words.ends - words.starts)[first]
                flat = words.data[ragged(starts, size)]
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                held = pa.Array.from_buffers(
                    pa.binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())]
                )
                yield pa.RecordBatch.from_arrays([held, pa.array(n.astype(np.int64))], names=["word", "n"])

    return run


def frequent_words(docs: DataFrame, text: str, most: int, vocabulary: str = VOCABULARY) -> list[bytes]:
    """The most frequent words of all texts, at most ``most``.

    A table of how many words there are of each magnitude of count (eighths of a power of two) tells down to which
    magnitude they can be taken; so no task sends more than its share of them.
    """
    counted = docs.select(F.col(text)).mapInArrow(_count(vocabulary), "word binary, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    counted = saved(counted.withColumn("size", F.floor(F.log2("n") * 8).cast("int")))
    held, least = 0, None
    for size, n in sorted(counted.groupBy("size").count().collect(), reverse=True):
        held += n
        if held > most:
            break
        least = size
    return [] if least is None else [bytes(r.word) for r in counted.where(F.col("size") >= least).select("word").collect()]


def share_lexicon(spark: SparkSession, words: list[bytes], vocabulary: str = VOCABULARY) -> str:
    """Writes the transducer to the shared folder and sends it to all executors; returns the file's name."""
    folder = fresh_dir(spark, "lexicon")
    target, at = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    target.create_dir(at, recursive=True)
    with target.open_output_stream(f"{at}/{name}") as f:
        f.write(compiled(words, merges(public_tokenizers.path(vocabulary))))
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


@lru_cache(maxsize=2)
def encoder(name: str | None, vocabulary: str) -> Encoder:
    """The process's encoder; kept between tasks."""
    path = public_tokenizers.path(vocabulary)
    return Encoder(path, Lexicon(SparkFiles.get(name)) if name else None)


def encode_batches(texts: list[str], name: str | None, vocabulary: str) -> Iterator[tuple[int, np.ndarray]]:
    """(place, ids) of each text, in order."""
    own = encoder(name, vocabulary)
    for part in slices(texts):
        ids, counts = own.encode(texts[part])
        ends = np.cumsum(counts)
        for i, (end, n) in enumerate(zip(ends, counts)):
            yield part.start + i, ids[end - n : end]


def encoded(docs: DataFrame, key: str, text: str, lexicon: str | None, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids array<int>) of every row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = whole(frame[text])
            ids = [got for _, got in encode_batches(texts, lexicon, vocabulary)]
            yield pd.DataFrame({key: frame[key], "ids": ids})

    return docs.select(key, text).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, ids array<int>")


def decoded(rows: DataFrame, key: str, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, text) from rows of ids; null ids give an empty text, bytes that are no UTF-8 replacement characters."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = encoder(None, vocabulary)
            texts = [own.decode(np.asarray(x if x is not None else [], dtype=np.int64)).decode("utf-8", "replace") for x in frame[ids]]
            yield pd.DataFrame({key: frame[key], "text": texts})

    return rows.select(key, ids).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, text string")


@lru_cache(maxsize=1)
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shown = [b"%d," % i for i in range(size)]
    n = np.array([len(x) for x in shown])
    return np.frombuffer(b"".join(shown), dtype=np.uint8), np.cumsum(n) - n, n


def digests(docs: DataFrame, key: str, text: str, lexicon: str | None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Of every row: key, n_tokens, SHA-256 of the ids (decimal, with commas) and of the text decoded from them.

    Encodes and decodes in the same task, so that ids need not travel.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = encoder(lexicon, vocabulary)
            flat, at, size = _decimals(own.merges.size)
            n, sha, back = [], [], []
            for _, ids in encode_batches(whole(frame[text]), lexicon, vocabulary):
                shown = flat[ragged(at[ids], size[ids])].tobytes()[:-1]
                n.append(len(ids))
                sha.append(hashlib.sha256(shown).hexdigest())
                back.append(hashlib.sha256(own.decode(ids).decode("utf-8", "replace").encode()).hexdigest())
            yield pd.DataFrame({key: frame[key], "n_tokens": n, "ids_sha256": sha, "decoded_sha256": back})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInPandas(
        run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    name = share_lexicon(spark, frequent_words(docs, "text", LEXICON_WORDS))
    return digests(docs, "doc_id", "text", name)
