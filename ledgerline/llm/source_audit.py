"""How far the sources of a language are apart: smoothed shares of every frequent term, by source and language.

A shard is the texts of an Arrow batch, about ``SHARD`` bytes at a time. Pointers to all word starts are taken from
its buffers and cut into one slice per (lang, source). ``multikey_sorted`` sorts a slice by eight bytes of the words at
a time: pointers that agree so far stay together and only those whose words go on are sorted by the next eight. In
sorted order equal words are runs; a run's length is the term's count in the source and the number of documents
that its pointers lie in the document frequency. Spark adds these up by (lang, source, term); no list of terms is held
by a task or the driver.

The shares are exact whole numbers: products and quotients are taken in decimals of up to 38 digits. A term that a
source lacks has one and the same share for all such terms, so a pair of sources needs the terms of either only: the
distance is that of the missing term times the number of terms, and a correction for every term that one of them
has. Terms are dealt into slices of about ``SLICE`` rows and sources into blocks of about ``SOURCES``, so that a task
compares two blocks over one slice, whatever the number of terms and sources.

* Null text, lang, source: as empty. A row is a document; repeated rows are several documents.
* Ties: equal values are ranked by the item's UTF-8 bytes.
* A lang without a kept term: its pairs have value 0 and there are no term rows. Empty table: no rows.
* A very long text is sorted in stretches; the terms that it has shown so far are held.
* Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.arrow_text import BYTES, IS_LETTER, LOWER, views
from ledgerline.llm.bytepair import ragged
from ledgerline.llm.common import by_bytes, saved, table

#: Documents of its language that a kept term occurs in at least, and term rows of a group.
LEAST_DOCUMENTS, TERM_ROWS = 30, 50
#: What a share is a multiple of, and the count that every term is given beforehand.
SCALE, PRIOR = 1_000_000_000, 5
#: Bytes of text sorted together.
SHARD = 1 << 24
#: Rows of a slice of terms, and sources of a block, about.
SLICE, SOURCES = 500_000, 128
#: Terms compared at a time.
TERMS = 2048

IS_TERM = IS_LETTER | (BYTES >= 128)
_SHOWN = np.array([(0xFFFFFFFFFFFFFFFF << (64 - 8 * n)) & 0xFFFFFFFFFFFFFFFF for n in range(9)], dtype=np.uint64)


# --- pointers and their order ---


def word_starts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms of texts that lie one after the other; no term crosses from text to text."""
    term = IS_TERM[data]
    begins, ends = term.copy(), term.copy()
    begins[1:] &= ~term[:-1]
    ends[:-1] &= ~term[1:]
    edges = starts[(starts > 0) & (starts < len(data))]
    begins[edges] = term[edges]
    ends[edges - 1] = term[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def multikey_sorted(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by their words, stable, and whether each place in it begins a new word.

    ``symbols[p]`` are the eight bytes from ``p`` on as a number that sorts like them. A word shorter than the bytes
    looked at is filled with zeros, which no word holds.
    """
    order = np.arange(len(starts))
    new = np.zeros(len(starts), dtype=bool)
    new[:1] = True
    run = np.zeros(len(starts), dtype=np.int64)  # by place: number of the run of pointers that agree so far
    places, depth = order.copy(), 0
    while len(places):
        own = order[places]
        left = np.minimum(sizes[own] - 8 * depth, 8)
        key = symbols[starts[own] + 8 * depth] & _SHOWN[left]
        by = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, run[places]))
        order[places] = own[by]
        key = key[by]
        new[places[1:]] |= (key[1:] != key[:-1]) | (run[places[1:]] != run[places[:-1]])
        run = np.cumsum(new)
        on = sizes[order[places]] >= 8 * (depth + 1)  # also a word that ends here: longer ones may follow it in its run
        places, depth = places[on], depth + 1
    return order, new


def _lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in lower case, and the eight bytes from every place on (also the end) as big-endian numbers."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = LOWER[data]
    return padded, np.ndarray(len(data) + 1, dtype=">u8", buffer=padded, strides=(1,))


class _Out:
    """Rows (lang, source, term, n, docs) as Arrow batches."""

    def __init__(self):
        self.groups, self.times, self.flat, self.sizes, self.n, self.docs = [], [], [], [], [], []

    def add(self, group: tuple[str, str], flat: np.ndarray, sizes: np.ndarray, n: np.ndarray, docs: np.ndarray) -> None:
        self.groups.append(group)
        self.times.append(len(sizes) + 1)  # one row without a term: the group occurs
        self.flat.append(flat)
        self.sizes += [np.array([-1]), sizes]
        self.n += [np.array([0]), n]
        self.docs += [np.array([0]), docs]

    def batch(self) -> pa.RecordBatch:
        size = np.concatenate(self.sizes)
        ends = np.concatenate([[0], np.cumsum(np.maximum(size, 0))]).astype(np.int32)
        known = np.packbits(size >= 0, bitorder="little")
        flat = np.concatenate(self.flat)
        terms = pa.Array.from_buffers(
            pa.string(), len(size), [pa.py_buffer(known.tobytes()), pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())]
        )
        group = np.repeat(np.arange(len(self.groups), dtype=np.int32), self.times)
        named = [pa.DictionaryArray.from_arrays(group, pa.array(x, type=pa.string())).cast(pa.string()) for x in zip(*self.groups)]
        counts = [pa.array(np.concatenate(x).astype(np.int64)) for x in (self.n, self.docs)]
        return pa.RecordBatch.from_arrays([*named, terms, *counts], names=["lang", "source", "term", "n", "docs"])


def _runs(low: np.ndarray, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, document: np.ndarray):
    """(flat bytes, sizes, counts, documents) of the different terms under the pointers; documents ascend."""
    sizes = ends - starts
    order, new = multikey_sorted(symbols, starts, sizes)
    heads = np.flatnonzero(new)
    where = document[order]
    other = new.copy()
    other[1:] |= where[1:] != where[:-1]
    first = order[heads]
    docs = np.add.reduceat(other.astype(np.int64), heads) if len(heads) else heads
    return low[ragged(starts[first], sizes[first])], sizes[first], np.diff(np.append(heads, len(order))), docs


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pair = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        code: dict[tuple[str, str], int] = {}
        group = np.array([code.setdefault(p, len(code)) for p in pair], dtype=np.int64)
        names = list(code)
        everything, at = views(batch.column(2))
        for part in by_bytes(np.diff(at), SHARD):
            a, b = at[part.start], at[part.stop]
            if b - a > SHARD:
                yield from _long(names[group[part.start]], everything[a:b])
                continue
            data, starts = everything[a:b], at[part.start : part.stop] - a
            begin, end = word_starts(data, starts)
            document = np.searchsorted(starts, begin, side="right") - 1
            of = group[part][document]
            by = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[by], np.arange(len(names) + 1))
            shown, out = _lowered(data), _Out()
            for g in np.unique(group[part]):
                own = by[cuts[g] : cuts[g + 1]]
                out.add(names[g], *_runs(*shown, begin[own], end[own], document[own]))
            yield out.batch()


def _long(group: tuple[str, str], data: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A text of more than ``SHARD`` bytes, in stretches that end behind a byte that is no term's."""
    seen: set[bytes] = set()
    at = 0
    while at < len(data):
        until = min(at + SHARD, len(data))
        while until < len(data) and IS_TERM[data[until - 1]]:
            later = np.flatnonzero(~IS_TERM[data[until : until + SHARD]])
            until = until + int(later[0]) + 1 if len(later) else min(until + SHARD, len(data))
        own = data[at:until]
        begin, end = word_starts(own, np.zeros(1, dtype=np.int64))
        flat, sizes, n, _ = _runs(*_lowered(own), begin, end, np.zeros(len(begin), dtype=np.int64))
        cut = np.concatenate([[0], np.cumsum(sizes)])
        raw = flat.tobytes()
        docs = np.zeros(len(sizes), dtype=np.int64)
        for i in range(len(sizes)):
            word = raw[cut[i] : cut[i + 1]]
            if word not in seen:
                seen.add(word)
                docs[i] = 1
        out = _Out()
        out.add(group, flat, sizes, n, docs)
        yield out.batch()
        at = until


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; one row without a term for every group."""
    given = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    rows = docs.select(*given).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- shares and distances ---


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms)), exactly; null without a term."""
    over = total.cast("decimal(20,0)") + terms.cast("decimal(17,0)") * F.lit(PRIOR).cast("decimal(1,0)")
    times = (n.cast("decimal(19,0)") + F.lit(PRIOR).cast("decimal(1,0)")) * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(terms > 0, F.call_function("div", times, over) + 1)


def _distances(rows: pd.DataFrame) -> pd.DataFrame:
    """Part of the distance of every two sources of one or two blocks, over one slice of the terms.

    Rows without a term tell a source's block, its share of a missing term and how often the missing terms'
    distance is to be added here.
    """
    told = rows[rows["term"].isna()].drop_duplicates("source").sort_values("source", ignore_index=True)
    missing = told["p"].to_numpy(np.int64)
    block = told["block"].to_numpy(np.int64)
    apart = np.abs(missing[:, None] - missing[None, :])
    total = apart * int(told["terms"].iloc[0])
    had = rows[rows["term"].notna()]
    source = pd.Index(told["source"]).get_indexer(had["source"])
    word, names = pd.factorize(had["term"])
    p = had["p"].to_numpy(np.int64)
    by = np.argsort(word, kind="stable")
    cuts = np.searchsorted(word[by], np.arange(0, len(names) + TERMS, TERMS))
    for k in range(len(cuts) - 1):
        own = by[cuts[k] : cuts[k + 1]]
        shares = np.repeat(missing[:, None], min(TERMS, len(names) - k * TERMS), axis=1)
        shares[source[own], word[own] - k * TERMS] = p[own]
        for i in range(len(missing)):
            total[i] += np.abs(shares[i] - shares).sum(axis=1) - apart[i] * shares.shape[1]
    first, last = int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
    i, j = np.triu_indices(len(told), 1)
    if first != last:  # sources of one block are compared where both blocks are that one
        keep = block[i] != block[j]
        i, j = i[keep], j[keep]
    name = told["source"].to_numpy()
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "one": name[i], "two": name[j], "value": total[i, j]})


def pair_rows(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, both ways."""
    size = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / SOURCES).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.sum("rows") / SLICE), F.lit(1)).cast("int").alias("slices"),
    )
    own = groups.join(size, "lang").withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int"))
    told = own.select(
        "lang", "source", "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        F.lit(None).cast("string").alias("term"), F.coalesce("missing", F.lit(0)).alias("p"), "terms",
    )
    told = told.withColumn("terms", F.when(F.col("slice") == 0, F.col("terms")).otherwise(0))
    had = kept.join(own.select("lang", "source", "block", "blocks", "slices"), ["lang", "source"])
    had = had.select(
        "lang", "source", "block", "blocks", F.pmod(F.xxhash64("term"), "slices").cast("int").alias("slice"),
        "term", "p", F.lit(0).cast("long").alias("terms"),
    )
    rows = told.unionByName(had).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    parts = rows.drop("blocks", "other").groupBy("lang", "low", "high", "slice").applyInPandas(
        _distances, "lang string, one string, two string, value long"
    )
    both = parts.select("lang", F.explode(F.array(
        F.struct(F.col("one").alias("source"), F.col("two").alias("item"), "value"),
        F.struct(F.col("two").alias("source"), F.col("one").alias("item"), "value"),
    )).alias("r")).select("lang", "r.*")
    return both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audited(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): distances of the sources, and terms that a source has more of."""
    counts = saved(term_counts(docs, lang, source, text))
    terms = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"))
    terms = terms.where(F.col("docs") >= LEAST_DOCUMENTS).drop("docs")
    kept = saved(counts.where("term is not null").drop("docs").join(terms, ["lang", "term"]))

    every = counts.where("term is null").select("lang", "source")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    langs = kept.groupBy("lang", "term").agg(F.max("all").alias("all"))
    langs = langs.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("lang_total"))
    groups = every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = saved(groups.withColumn("missing", share(F.lit(0), F.col("total"), F.col("terms"))))

    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("all"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TERM_ROWS)
    pairs = pair_rows(shares.drop("q"), groups).withColumn("rank", F.row_number().over(order))
    out = pairs.withColumn("part", F.lit("pair")).unionByName(more.withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"))


SQL = r"""
WITH given AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM given
), kept AS (
  SELECT lang, term, count(*) AS everywhere FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 30
), groups AS (SELECT DISTINCT lang, source FROM given
), cells AS (
  SELECT g.lang, g.source, k.term, k.everywhere, coalesce(w.n, 0) AS n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL) w
    ON w.lang = g.lang AND w.source = g.source AND w.term = k.term
), totals AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source) AS over_group,
    sum(everywhere) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source) AS over_lang
  FROM cells
), shares AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 5) // over_group AS p,
    1 + 1000000000::HUGEINT * (everywhere + 5) // over_lang AS q
  FROM totals
), distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
