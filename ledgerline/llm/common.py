"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shared_root


#: Links of a graph that a task takes, about.
LINKS = 50_000
#: Rows of whole texts that a Python task is given at a time, and Spark's setting for it.
BATCH_ROWS, ARROW_ROWS = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, most: int = BATCH_ROWS) -> None:
    """Python tasks of the session get at most ``most`` rows at a time. Spark's default of 10,000 whole texts is held
    several times over, by the executor and by each of its Python workers, whatever a step then cuts out of it."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= most:
        spark.conf.set(ARROW_ROWS, str(most))


def saved(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder, so that lost executors lose nothing."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the number of tasks that work is dealt over."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labelled(docs: DataFrame, rated: DataFrame, key: str, text: str) -> DataFrame:
    """(at, q, text) from the labels (doc_id, q): one row for each labelled id that ``docs`` has, however often an id
    repeats; of an id's different texts the one with the smallest hash. ``at`` is the hash of the id."""
    rows = docs.select(F.col(key).alias("_key"), F.struct(F.xxhash64(text).alias("h"), F.col(text).alias("text")).alias("_text"))
    rows = rows.join(F.broadcast(rated), F.col("_key") == F.col("doc_id"))
    return rows.groupBy("doc_id", "q").agg(F.min("_text").alias("t")).select(F.xxhash64("doc_id").alias("at"), "q", "t.text")


def whole_rows(rows: DataFrame, most: int) -> list[Row]:
    """Rows of (at, units, ...) on the driver in order of ``at``, as many as have ``most`` units together. A row that
    does not fit any more is left out, never cut. The number of rows is bounded by the caller."""
    rows, held, taken = saved(rows), 0, []
    for r in sorted(rows.select("at", "units").collect()):
        if held + r.units <= most:
            held += r.units
            taken.append(r.at)
    return sorted(rows.where(F.col("at").isin(taken)).collect(), key=lambda r: r.at)


def per_frame(step: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``step`` on every batch of a ``mapInPandas``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield step(frame)

    return run


def by_bytes(sizes: np.ndarray, most: int) -> list[slice]:
    """Consecutive slices of rows that hold at most ``most`` bytes each; a larger row stands alone."""
    cuts, start, held = [], 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            cuts.append(slice(start, i))
            start, held = i, 0
        held += n
    if start < len(sizes):
        cuts.append(slice(start, len(sizes)))
    return cuts


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node reachable over the links, for every node that has one.

    Alternating large-star and small-star steps: each moves links to the smallest neighbour, by a group minimum
    that is taken before the shuffle and a join that may be split, so a node with many links is not one task.
    Each step is checkpointed, and the loop ends when a step changes no link. Links are taken ``LINKS`` to a task,
    whatever the number of shuffle partitions, as a step has many small exchanges.
    """
    edges = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    parts = max(1, -(-edges.count() // LINKS))
    links = saved(edges.coalesce(parts).distinct().coalesce(parts))
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        least = least.coalesce(parts)
        large = both.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.coalesce(parts).distinct().coalesce(parts)
        small = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k").coalesce(parts)
        joined = large.join(small, F.col("a") == F.col("k"))
        links = saved(
            joined.select("a", F.col("m").alias("b"))
            .unionByName(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .coalesce(parts)
            .distinct()
            .coalesce(parts)
        )
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    own = links.groupBy("b").agg(F.min("b").alias("component")).select(F.col("b").alias("node"), "component")
    return own.unionByName(links.select(F.col("a").alias("node"), F.col("b").alias("component")))
