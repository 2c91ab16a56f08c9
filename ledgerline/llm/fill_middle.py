"""Fill-in-the-middle: a text is cut at two token boundaries and its parts are put in another order.

Tokens are runs of ASCII letters and single other characters. The boundaries of all texts of a shard (about ``SHARD``
bytes of an Arrow batch) are kept in a ``RankIndex``: straight segments that tell a boundary's offset from its rank to
within ``ERROR`` bytes, and one stored byte per boundary that corrects the rest. A cut is looked up by its rank: the
segment predicts the offset and the residual makes it exact.

* Null text: as empty, which is left plain. Empty table: no rows. Repeated rows: one result each, all equal.
* Null key: the hash is that of ``1:`` alone.
* A text that holds one of the marks is left plain, so that what is written can always be read back.
* A very long text is indexed block by block; beside the text itself a task holds one byte per boundary.
* Columns beside the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.arrow_text import IS_LETTER, strings, views
from ledgerline.llm.common import by_bytes, table

#: Fixed marks of the written forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
#: Of a hundred texts, how many are rearranged, and how many of those with the suffix in front.
REARRANGED, SUFFIX_FIRST = 90, 20
#: Most bytes by which a segment may be wrong: what a stored residual can hold.
ERROR = 127
#: Ranks of a segment at first; it is halved until it is within the error.
RANKS = 1024
#: Bytes of text whose boundaries are found at a time, and bytes of text that share an index.
BLOCK, SHARD = 1 << 21, 1 << 23


@dataclass(frozen=True)
class RankIndex:
    """Offset of every boundary by rank: straight segments, and residuals that make them exact."""

    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def __getitem__(self, ranks: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.first, ranks, side="right") - 1
        return _predicted(self.offset[s], self.slope[s], ranks - self.first[s]) + self.residual[ranks]


def _predicted(offset: np.ndarray, slope: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return offset + np.rint(slope * steps).astype(np.int64)


def segments(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first rank, slope, residuals) of segments over ascending ``offsets``, none off by more than ``error``.

    A segment is the line through its two ends; those that are off by more are halved, all at once, until none is.
    """
    residual = np.zeros(len(offsets), dtype=np.int8)
    first = np.arange(0, len(offsets), RANKS, dtype=np.int64)
    end = np.append(first[1:], len(offsets))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(first):
        size = end - first
        slope = (offsets[end - 1] - offsets[first]) / np.maximum(size - 1, 1)
        begin = np.cumsum(size) - size
        steps = np.arange(size.sum()) - np.repeat(begin, size)
        ranks = np.repeat(first, size) + steps
        off = offsets[ranks] - _predicted(np.repeat(offsets[first], size), np.repeat(slope, size), steps)
        good = np.maximum.reduceat(np.abs(off), begin) <= error
        each = np.repeat(good, size)
        residual[ranks[each]] = off[each]
        done.append((first[good], slope[good]))
        a, b = first[~good], end[~good]
        half = (a + b) // 2
        first, end = np.concatenate([a, half]), np.concatenate([half, b])
    heads = np.concatenate([f for f, _ in done]) if done else first
    order = np.argsort(heads)
    return heads[order], np.concatenate([s for _, s in done])[order] if done else heads.astype(float), residual


def indexed(data: np.ndarray, starts: np.ndarray) -> tuple[RankIndex, np.ndarray]:
    """The index of all token boundaries of texts that lie one after the other, and the rank of each text's first.

    The end of a text is the beginning of the next one, so the boundaries of text ``i`` are the ranks from its own
    first to that of text ``i + 1``, both included.
    """
    firsts, offsets, slopes, residuals = [], [], [], []
    ranks, held = np.zeros(len(starts), dtype=np.int64), 0
    for a in range(0, len(data) + 1, BLOCK):
        b = min(a + BLOCK, len(data))
        part = data[max(a - 1, 0) : b]
        letter = IS_LETTER[part]
        begins = (part & 0xC0) != 0x80
        begins[1:] &= ~(letter[1:] & letter[:-1])
        begins = begins[min(a, 1) :]
        own = starts[(starts >= a) & (starts < b)]
        begins[own - a] = True
        found = np.flatnonzero(begins) + a
        if b == len(data):
            found = np.append(found, b)
        here = (starts >= a) & (starts <= b if b == len(data) else starts < b)
        ranks[here] = held + np.searchsorted(found, starts[here])
        first, slope, residual = segments(found)
        firsts.append(first + held)
        offsets.append(found[first])
        slopes.append(slope)
        residuals.append(residual)
        held += len(found)
        if b == len(data):
            break
    joined = [np.concatenate(x) for x in (firsts, offsets, slopes, residuals)]
    return RankIndex(*joined), ranks


def _rearranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        h = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
        everything, at = views(texts)
        for part in by_bytes(np.diff(at), SHARD):
            data, starts = everything[at[part.start] : at[part.stop]], at[part.start : part.stop + 1] - at[part.start]
            index, rank = indexed(data, starts)
            n = np.diff(rank)
            h1, h2, h3, h4 = (x[part] for x in h)
            one, two = h1 % (n + 1), h2 % (n + 1)
            first, second = index[rank[:-1] + np.minimum(one, two)], index[rank[:-1] + np.maximum(one, two)]
            out, form, chars = [], [], []
            for i in range(len(n)):
                whole = data[starts[i] : starts[i + 1]].tobytes()
                if not whole or h3[i] % 100 >= REARRANGED or any(m in whole for m in MARKS):
                    out.append(whole)
                    form.append("plain")
                    chars.append((None, None))
                    continue
                a, b = int(first[i] - starts[i]), int(second[i] - starts[i])
                p, m, s = whole[:a], whole[a:b], whole[b:]
                spm = h4[i] % 100 < SUFFIX_FIRST
                form.append("spm" if spm else "psm")
                given = ((SUFFIX, s), (PREFIX, p)) if spm else ((PREFIX, p), (SUFFIX, s))
                out.append(b"".join(mark.encode() + x for mark, x in (*given, (MIDDLE, m))))
                chars.append((len(p.decode()), len(m.decode())))
            yield pa.RecordBatch.from_arrays(
                [
                    keys.slice(part.start, len(n)),
                    pa.array(n, type=pa.int64()),
                    pa.array(form, type=pa.string()),
                    pa.array([c for c, _ in chars], type=pa.int64()),
                    pa.array([c for _, c in chars], type=pa.int64()),
                    strings(out),
                ],
                names=["key", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def rearranged(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row; the key's hash decides form and cuts."""
    sha = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(sha, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    given = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *h)
    kind = given.schema["key"].dataType.simpleString()
    out = given.mapInArrow(
        _rearranged, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )
    return out.withColumnRenamed("key", key)


def restored(output: Column, form: Column) -> Column:
    """The text that ``rearranged`` was given, from what it wrote and the form."""

    def parted(second: str) -> list[Column]:
        rest = F.substr(output, F.lit(4))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + 4)
        two = F.substring_index(rest, MIDDLE, 1)
        return [one, two, F.substr(rest, F.length(two) + 4)]

    p, s, m = parted(SUFFIX)
    s2, p2, m2 = parted(PREFIX)
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rearranged(table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


SQL = r"""
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), cut AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM given
), formed AS (
  SELECT doc_id, text, units, len(units) AS n,
    least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p,
    array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s
  FROM formed
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
