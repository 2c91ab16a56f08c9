"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the vectors again and again at the median of a random projection; the vectors next to the median go
to both sides, so a close pair is rarely parted, and never in all trees. The first splits are Spark jobs over all
vectors, one per level (a tree has one direction per level there, each cell its own median); once cells are of about
``CELL`` vectors, tasks split them on, each cell with directions of its own, down to leaves of ``LEAF``. Vectors are
compared within leaves, in double precision, and the linked ones united.

Links lie within the components found, so their numbers are counted there: vectors within half the linking angle of
their component's first vector are all linked with each other and need no comparison, the others are compared with
their whole component in blocks. A group of n near copies costs n steps, not n squared.

* Null or empty vectors, zero vectors, and those with a null or non-finite component link with nothing.
* Vectors of different length link with nothing of each other. Vectors of equal direction (to nine decimals) are one
  vector in the forest and count as links of each other.
* Rows that repeat an id count once, with the row whose direction sorts first, and get the same result; null ids
  get no links and a null component. Empty table: no rows. Columns beside id and vector are passed by.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import components, saved, table

LEAST = 0.9
TREES, SPILL = 8, 0.06
#: Vectors that a task splits on its own, and vectors of a leaf.
CELL, LEAF = 4096, 96
BLOCK = 1024


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(node, size, mark, unit): the vectors that can link, as unit vectors in double precision, one row per id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for node, raw in zip(frame["node"], frame["v"]):
                v = np.array(raw, dtype=np.float64)
                if not len(v) or not np.isfinite(v).all():
                    continue
                most = np.abs(v).max()
                if most == 0:
                    continue
                v = v / most
                v = v / np.linalg.norm(v)
                mark = hashlib.blake2b((np.round(v, 9) + 0.0).tobytes(), digest_size=16).digest()
                out.append((node, len(v), mark, v.tobytes()))
            yield pd.DataFrame(out, columns=["node", "size", "mark", "unit"])

    rows = vectors.select(F.col(key).cast("long").alias("node"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("node").isNotNull() & F.col("v").isNotNull() & F.expr("forall(v, x -> x is not null)"))
    units = rows.mapInPandas(run, "node long, size int, mark binary, unit binary")
    return units.groupBy("node").agg(F.min(F.struct("mark", "size", "unit")).alias("r")).select("node", "r.*")


def _direction(seed: int, size: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal(size)


def cells(reps: DataFrame, levels: int, trees: int, spill: float) -> DataFrame:
    """(tree, cell, node): the vectors after the splits that Spark makes; those near a median are in several cells."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, part in frame.groupby("size"):
                x = np.stack([np.frombuffer(u) for u in part["unit"]])
                for tree in range(trees):
                    way = np.stack([_direction((tree << 16) + 2 * level + 1, int(size)) for level in range(levels)], axis=1)
                    at = x @ way
                    yield pd.DataFrame({"tree": tree, "cell": int(size), "node": part["node"].to_numpy(), "at": list(at)})

    rows = reps.select("node", "size", "unit")
    if not levels:
        return rows.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.col("size").cast("long").alias("cell"), "node")
    placed = saved(rows.mapInPandas(run, "tree int, cell long, node long, at array<double>"))
    for level in range(levels):
        at = F.col("at")[level]
        cuts = placed.groupBy("tree", "cell").agg(F.percentile_approx(at, [0.5 - spill, 0.5 + spill], 1000).alias("q"))
        split = placed.join(cuts, ["tree", "cell"])
        sides = F.array_compact(F.array(F.when(at <= F.col("q")[1], F.lit(0)), F.when(at >= F.col("q")[0], F.lit(1))))
        split = split.withColumn("side", F.explode(sides))
        placed = saved(split.select("tree", F.expr("cell * 2 + side").alias("cell"), "node", "at"))
    return placed.select("tree", "cell", "node")


def leaves(x: np.ndarray, seed: int, leaf: int, spill: float) -> Iterator[np.ndarray]:
    """Row numbers of each leaf of a tree over the rows of ``x``; rows near a median are in several leaves."""
    random, open_ = np.random.default_rng(seed), [np.arange(len(x))]
    while open_:
        rows = open_.pop()
        n = len(rows)
        if n <= leaf:
            yield rows
            continue
        order = rows[np.argsort(x[rows] @ random.standard_normal(x.shape[1]), kind="stable")]
        more = int(spill * n)
        open_ += [order[: (n + 1) // 2 + more], order[n // 2 - more :]]


def roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row reachable from it."""
    first = np.arange(len(linked))
    while True:
        near = np.where(linked, first[None, :], len(first)).min(axis=1)
        new = np.minimum(first, near)
        new = new[new]
        if (new == first).all():
            return first
        first = new


def found_links(placed: DataFrame, reps: DataFrame, least: float, leaf: int, spill: float) -> DataFrame:
    """(a, b): vectors that links within a leaf connect, as links to the smallest of them."""

    def run(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        node, x = frame["node"].to_numpy(), np.stack([np.frombuffer(u) for u in frame["unit"]])
        seed = int(group[1]) * 1009 + int(group[0])
        pairs = set()
        for rows in leaves(x, seed, leaf, spill):
            rows = np.sort(rows)
            linked = x[rows] @ x[rows].T >= least
            if linked.sum() > len(rows):
                top = roots(linked)
                moved = np.flatnonzero(top != np.arange(len(rows)))
                pairs.update(zip(node[rows[moved]].tolist(), node[rows[top[moved]]].tolist()))
        return pd.DataFrame(sorted(pairs), columns=["a", "b"]).astype("int64")

    rows = placed.join(reps.select("node", "unit"), "node")
    return rows.groupBy("tree", "cell").applyInPandas(run, "a long, b long").distinct()


def counted(members: DataFrame, least: float) -> DataFrame:
    """(node, links): how many vectors each member links with, from (component, node, copies, unit).

    Within half the linking angle of a component's first vector (``ball``) all are linked with each other; the
    others (``outer``) are compared with all members, in blocks.
    """
    half = math.cos(math.acos(least) / 2) + 1e-9
    first = members.where("node = component").select("component", F.col("unit").alias("pivot"))

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            close = [float(np.frombuffer(u) @ np.frombuffer(p)) >= half for u, p in zip(frame["unit"], frame["pivot"])]
            yield frame[["component", "node", "copies", "unit"]].assign(ball=close)

    schema = "component long, node long, copies long, unit binary, ball boolean"
    rows = saved(members.join(first, "component").select("component", "node", "copies", "unit", "pivot").mapInPandas(near, schema))
    sums = rows.groupBy("component").agg(
        F.sum(F.when(F.col("ball"), F.col("copies")).otherwise(0)).alias("inside"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("mb"),
        F.ceil(F.sum(F.when(F.col("ball"), 0).otherwise(1)) / BLOCK).cast("int").alias("ob"),
    )
    plain = rows.join(sums, "component").select("node", F.when(F.col("ball"), F.col("inside")).otherwise(F.col("copies")).alias("links"))
    some = saved(rows.join(sums.where("ob > 0"), "component"))
    block = F.pmod(F.xxhash64("node"), F.col("mb")).cast("int").alias("m")
    left = some.select("component", "node", "copies", "unit", "ball", block, F.explode(F.expr("sequence(0, ob - 1)")).alias("o"))
    own = F.pmod(F.xxhash64("node"), F.col("ob")).cast("int").alias("o")
    right = saved(some.where("not ball")).select("component", "node", "copies", "unit", F.explode(F.expr("sequence(0, mb - 1)")).alias("m"), own)

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"node": [], "links": []}).astype("int64")
        x, y = (np.stack([np.frombuffer(u) for u in f["unit"]]) for f in (a, b))
        linked = (x @ y.T >= least) & (a["node"].to_numpy()[:, None] != b["node"].to_numpy())
        inner = a["ball"].to_numpy()
        one = pd.DataFrame({"node": a["node"][inner], "links": (linked @ b["copies"].to_numpy())[inner]})
        two = pd.DataFrame({"node": b["node"], "links": a["copies"].to_numpy() @ linked})
        return pd.concat([one, two]).astype("int64")

    keys = ("component", "m", "o")
    more = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "node long, links long")
    return plain.unionByName(more).groupBy("node").agg((F.sum("links") - 1).alias("links"))


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST, trees: int = TREES
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    units = saved(usable(vectors, key, vector))
    same = units.groupBy("size", "mark").agg(F.min("node").alias("rep"), F.count("*").alias("copies"))
    reps = saved(
        units.join(same.select(F.col("rep").alias("node"), "copies"), "node").select("node", "size", "unit", "copies")
    )
    levels = max(0, math.ceil(math.log2(max(reps.count(), 1) / CELL)))
    pairs = found_links(cells(reps, levels, trees, SPILL), reps, least, LEAF, SPILL)
    united = components(pairs, "a", "b")
    members = saved(reps.join(united, "node").select("component", "node", "copies", "unit"))
    links = counted(members, least)
    found = reps.join(united, "node", "left").join(links, "node", "left").select(
        F.col("node").alias("rep"),
        F.coalesce("component", "node").alias("component_id"),
        F.coalesce(F.col("links"), F.col("copies") - 1).alias("n_links"),
    )
    named = units.join(same.select("size", "mark", "rep"), ["size", "mark"]).join(found, "rep")
    out = vectors.select(F.col(key)).join(named.select("node", "component_id", "n_links"), F.col(key) == F.col("node"), "left")
    component = F.coalesce("component_id", F.col(key))
    return out.select(
        key,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.coalesce(component == F.col(key), F.lit(True))).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
