"""Near-duplicate documents by weighted MinHash over five-word shingles.

A document is the multiset of its five-word runs; two are near copies if the sum of the smaller counts is at least
``least`` of the sum of the larger ones. Documents with equal multisets are one class from the start, so a text that
a third of the corpus repeats is one row afterwards. Classes get BagMinHash signatures; those that share a band are
candidates. Within a band each class is first compared with the one that meets most others in all its bands, which in a
group of copies is the original or close to it; then, while that finds many links, those still unconnected with
another one, chosen at random. So a large group of near copies is joined by as many comparisons as it has members.
Once the pairs of a band's unconnected classes are few, or such rounds find little, all of these are compared, in
blocks. Every link is verified on the whole texts.

* Null and empty texts, and texts of white space, have no shingle: they are near copies of nothing.
* Fewer than five words: all of them are one shingle.
* Null ids: class null, kept; they take no part. Rows that repeat an id are one document and stay or go together.
* Ties: a class is named after its smallest id, and that document stays. Empty table: no rows.
* Columns beside the id and the text are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import scan
from ledgerline.llm.bag_minhash import band_keys, signatures
from ledgerline.llm.common import by_bytes, components, saved, table

SHINGLE = 5
LEAST = 0.8
#: A pair of similarity 0.8 shares a band of six values with probability 0.99994, one of 0.5 with 0.4.
BANDS, ROWS = 32, 6
#: Members of a band that are compared with each other in one task.
BLOCK = 512


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct shingle of each text, in that order."""
    data, at = scan.joined(texts)
    w0, _, wh = scan.words(data)
    doc = np.searchsorted(at, w0, side="right") - 1
    n = np.bincount(doc, minlength=len(texts))
    runs = scan.grams(wh, SHINGLE)
    ok = doc[SHINGLE - 1 :] == doc[: len(doc) - SHINGLE + 1] if len(doc) >= SHINGLE else np.zeros(0, dtype=bool)
    owner, run = doc[: len(runs)][ok], runs[ok]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        first = np.searchsorted(doc, short)
        whole = [scan.grams(wh[f : f + n[d]], int(n[d]))[0] for f, d in zip(first, short)]
        owner, run = np.concatenate([owner, short]), np.concatenate([run, np.array(whole, dtype=np.uint64)])
    order = np.lexsort((run, owner))
    owner, run = owner[order], run[order]
    new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (run[1:] != run[:-1]))) if len(run) else order
    return owner[new], run[new], np.diff(np.append(new, len(run)))


def described(docs: DataFrame, key: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, n, f1, f2, bands): each document's number of shingles, a 128-bit hash of their multiset, band keys."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = scan.encoded(frame["text"])
            for part in by_bytes(np.array([len(t) for t in texts]), scan.BLOCK):
                owner, runs, count = shingles(texts[part])
                some = part.stop - part.start
                keys = band_keys(signatures(owner, runs, count, some, bands * rows), bands, rows).view(np.int64)
                prints = np.zeros((2, some), dtype=np.uint64)
                for i, extra in enumerate((np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))):
                    np.add.at(prints[i], owner, scan.mixed(runs ^ extra) * count.astype(np.uint64))
                total = np.bincount(owner, weights=count, minlength=some).astype(np.int64)
                yield pd.DataFrame(
                    {
                        "node": frame["node"].iloc[part].to_numpy(),
                        "n": total,
                        "f1": prints[0].view(np.int64),
                        "f2": prints[1].view(np.int64),
                        "bands": list(keys),
                    }
                )

    rows_ = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).where("node is not null")
    return rows_.mapInPandas(run, "node long, n long, f1 long, f2 long, bands array<long>")


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' distinct shingles and their counts."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(x[1][i], y[1][j]).sum())
    total = int(x[1].sum() + y[1].sum()) - both
    return both / total if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts, ``packed`` by ``node``, are similar enough."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grow = zstandard.ZstdDecompressor()
        for frame in frames:
            for at in range(0, len(frame), 2_000):
                part = frame.iloc[at : at + 2_000]
                blobs = dict(zip(part["a"], part["x"])) | dict(zip(part["b"], part["y"]))
                raw, held = [grow.decompress(b) for b in blobs.values()], {}
                nodes = list(blobs)
                for cut in by_bytes(np.array([len(t) for t in raw]), scan.BLOCK):
                    owner, runs, count = shingles(raw[cut])
                    ends = np.searchsorted(owner, np.arange(cut.stop - cut.start + 1))
                    for i, (c, d) in enumerate(zip(ends, ends[1:])):
                        held[nodes[cut.start + i]] = runs[c:d], count[c:d]
                good = [similarity(held[x], held[y]) >= least for x, y in zip(part["a"], part["b"])]
                yield part.loc[good, ["a", "b"]]

    x = texts.select(F.col("node").alias("a"), F.col("packed").alias("x"))
    y = texts.select(F.col("node").alias("b"), F.col("packed").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def _blocks_compared(least: float):
    """Links between the rows of two blocks of one band, each pair in the first band that it shares."""

    def links(x: pd.DataFrame, y: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        if not len(x) or not len(y):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        bands = [np.stack([np.asarray(b) for b in f["bands"]]) for f in (x, y)]
        band = int(x["band"].iloc[0])
        here = int(np.flatnonzero(bands[0][0] == band)[0])
        n, c, node = ([f[name].to_numpy() for f in (x, y)] for name in ("n", "component", "node"))
        ask = (c[0][:, None] != c[1]) & (node[0][:, None] < node[1])
        ask &= (n[1] >= least * n[0][:, None]) & (n[0][:, None] >= least * n[1])
        for k in range(here):
            ask &= bands[0][:, k, None] != bands[1][:, k]
        some = [np.flatnonzero(ask.any(axis=1)), np.flatnonzero(ask.any(axis=0))]
        if not len(some[0]):
            return some[0], some[0]
        grow, rows, cells = zstandard.ZstdDecompressor(), [], []
        texts = [grow.decompress(f["packed"].iloc[i]) for f, own in zip((x, y), some) for i in own]
        for cut in by_bytes(np.array([len(t) for t in texts]), scan.BLOCK):
            owner, runs, count = shingles(texts[cut])
            turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            rows.append(np.repeat(owner + cut.start, count))
            cells.append(scan.mixed(np.repeat(runs, count) + turn.astype(np.uint64)))
        row, (_, cell) = np.concatenate(rows), np.unique(np.concatenate(cells), return_inverse=True)
        many = np.bincount(cell)[cell] > 1
        row, cell = row[many], np.unique(cell[many], return_inverse=True)[1]
        width, both = int(cell.max(initial=-1)) + 1, np.zeros((len(some[0]), len(some[1])))
        for low in range(0, width, 4096):
            own = (cell >= low) & (cell < low + 4096)
            held = np.zeros((len(texts), 4096), dtype=np.float32)
            held[row[own], cell[own] - low] = 1
            both += held[: len(some[0])] @ held[len(some[0]) :].T
        total = n[0][some[0]][:, None] + n[1][some[1]] - both
        i, j = np.nonzero((both >= least * total) & ask[np.ix_(*some)])
        return node[0][some[0][i]], node[1][some[1][j]]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame["block"] == frame["i"]
        a, b = links(frame[first], frame[frame["block"] == frame["j"]])
        c, d = links(frame[frame["block"] == frame["j"]], frame[first]) if not first.all() else (a[:0], b[:0])
        return pd.DataFrame({"a": np.concatenate([a, c]), "b": np.concatenate([b, d])}).astype("int64")

    return run


def shipped(open_: DataFrame, least: float, block: int) -> DataFrame:
    """(band, node, n, component, block, other): each member once for every block that its own is compared with."""
    parts = open_.groupBy("band", "component").agg(F.count("*").alias("m"), F.min("n").alias("low"), F.max("n").alias("high"))
    main = parts.groupBy("band").agg(F.max(F.struct("m", "component")).alias("main"))
    parts = parts.join(main.select("band", F.col("main.component").alias("main")), "band")
    outside, inside = F.col("component") != F.col("main"), F.col("component") == F.col("main")
    sizes = parts.groupBy("band", "main").agg(
        F.ceil(F.sum(F.when(outside, F.col("m"))) / block).cast("int").alias("outer"),
        F.ceil(F.sum(F.when(inside, F.col("m"))) / block).cast("int").alias("inner"),
        F.sum("m").alias("members"),
        (F.min(F.when(outside, F.col("low"))) * least).alias("low"),
        (F.max(F.when(outside, F.col("high"))) / least).alias("high"),
    )
    rows = open_.join(sizes, "band").where(outside | F.col("n").between(F.col("low") - 1, F.col("high") + 1))
    small = F.col("members") <= block
    place = F.when(small, 0).when(outside, F.pmod(F.xxhash64("node"), F.col("outer")))
    place = place.otherwise(F.col("outer") + F.pmod(F.xxhash64("node"), F.col("inner"))).cast("int")
    met = F.sequence(F.lit(0), F.when(small, 1).when(outside, F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1)
    return rows.select("band", "node", "n", "component", place.alias("block"), F.explode(met).alias("other"))


def exhausted(open_: DataFrame, reps: DataFrame, texts: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between unconnected members of a band (band, node, n, component): all are compared, in blocks.

    A band is mostly one large component, whose members need no comparison with each other, and some outsiders. A
    block of outsiders meets every block of its band, a block of the large component those of the outsiders only; so
    the rows sent are about the band's members, once per block of outsiders, and the outsiders, once per block of
    members. Members of the large component that are too long or too short for every outsider are not sent. No pair
    leaves its task unless it is a link. A band that fits a block is one.
    """
    rows = shipped(open_, least, block).join(reps.select("node", "bands"), "node").join(texts, "node")
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")
    return rows.groupBy("band", "i", "j").applyInPandas(_blocks_compared(least), "a long, b long").distinct()


def packed_texts(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """(node, packed): compressed texts of the nodes, one of each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for frame in frames:
            yield pd.DataFrame({"node": frame["node"], "packed": [press.compress(t) for t in scan.encoded(frame["text"])]})

    rows = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).where("node is not null")
    small = rows.mapInPandas(run, "node long, packed binary")
    return small.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after more links (a, b): only components that these join are worked on."""

    def label(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))

    ends = links.join(label("a"), "a", "left").join(label("b"), "b", "left")
    ends = saved(ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).distinct())
    moved = components(ends, "a", "b").select(F.col("node").alias("_old"), F.col("component").alias("_new"))
    placed = labels.join(moved, labels["component"] == moved["_old"], "left")
    placed = placed.select("node", F.coalesce("_new", "component").alias("component"))
    fresh = moved.select(F.col("_old").alias("node"), F.col("_new").alias("component"))
    return saved(placed.unionByName(fresh.join(placed.select("node"), "node", "left_anti")))


def near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(key, class_id, kept) of every row of ``docs``: the smallest id reachable over near copies."""
    marks = saved(described(docs, key, text, bands, rows))
    same = marks.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("node").alias("first"))
    same = marks.where("n > 0").join(same, ["n", "f1", "f2"]).select("node", F.col("first").alias("rep")).distinct()
    same = saved(same.groupBy("node").agg(F.min("rep").alias("rep")))
    reps = marks.join(same.where("node = rep").select("node"), "node", "left_semi").where("n > 0")
    banded = reps.select("node", "n", F.explode(F.array_distinct("bands")).alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("m")).where("m > 1")
    banded = saved(banded.join(sizes, "band"))
    rank = banded.groupBy("node").agg(F.sum("m").alias("rank"))
    banded = saved(banded.drop("m").join(rank, "node"))
    texts = saved(packed_texts(docs, banded.select("node").distinct(), key, text))
    head = F.max(F.struct("rank", -F.col("node"))).alias("r")
    heads = banded.groupBy("band").agg(head).select("band", (-F.col("r.col2")).alias("b"))
    star = banded.select("band", F.col("node").alias("a")).join(heads, "band").where("a <> b").select("a", "b").distinct()
    links = saved(verified(star, texts, least))
    fits = (F.col("nb") >= least * F.col("na")) & (F.col("na") >= least * F.col("nb")) & (F.col("ca") != F.col("cb"))
    turn, new, tried = 0, 0, 0
    # An id with several texts may stand for copies of one of them and be a copy by another.
    own = same.where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    chained = own.join(same.select(F.col("rep").alias("a")).distinct(), "a", "left_semi")
    labels = components(links.unionByName(chained), "a", "b")
    while True:
        placed = banded.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        split = placed.groupBy("band").agg(F.min("component").alias("_l"), F.max("component").alias("_h")).where("_l < _h")
        open_ = saved(placed.join(split.select("band"), "band", "left_semi").select("band", "node", "n", "component"))
        sizes = open_.groupBy("band", "component").agg(F.count("*").cast("double").alias("m")).groupBy("band")
        sizes = sizes.agg(F.sum("m").alias("m"), (F.pow(F.sum("m"), 2) - F.sum(F.col("m") * F.col("m"))).alias("p"))
        members, crossing = sizes.agg(F.coalesce(F.sum("m"), F.lit(0.0)), F.coalesce(F.sum("p"), F.lit(0.0)) / 2).first()
        if not members:
            break
        if crossing <= 2 * members or turn > 0 and new < 0.1 * tried:
            labels = joined(labels, saved(exhausted(open_, reps, texts, least)))
            break
        turn += 1
        left = open_.select("band", F.col("node").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
        chosen = F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "n", "component")).alias("r")
        right = open_.groupBy("band").agg(chosen)
        right = right.select("band", F.col("r.node").alias("b"), F.col("r.n").alias("nb"), F.col("r.component").alias("cb"))
        pairs = saved(left.join(right, "band").where(fits).select("a", "b").distinct())
        more = saved(verified(pairs, texts, least))
        new, tried, labels = more.count(), pairs.count(), joined(labels, more)
    # A representative has the smallest id of its equal texts, so its component's smallest id is that of all of them.
    alike = same.groupBy("rep").agg(F.count("*").alias("m")).where("m > 1").select(F.col("rep").alias("node"))
    found = alike.withColumn("component", F.col("node")).join(labels, "node", "left_anti").unionByName(labels)
    found = same.join(found, F.col("rep") == found["node"]).select(same["node"], "component")
    out = docs.select(F.col(key)).join(found, F.col(key) == F.col("node"), "left")
    return out.select(
        key,
        F.coalesce("component", F.col(key)).alias("class_id"),
        (F.col("component").isNull() | (F.col("component") == F.col(key))).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
