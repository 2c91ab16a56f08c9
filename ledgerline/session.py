"""Spark sessions and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RETAINED = "spark.sql.streaming.minBatchesToRetain"

DEFAULTS = {
    # Event dates are calendar days in UTC whatever the host's zone is.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dedup state is unbounded, so it lives off-heap and on disk.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Checkpoint what changed per micro-batch instead of whole snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, conf: dict[str, str] | None = None, master: str | None = None) -> SparkSession:
    """Session with the library's defaults; catalog, object-store and credential settings come in through ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(
    spark: SparkSession, state_partitions: int | None = None, count_state: bool = True, spare_disk: bool = False
) -> SparkSession:
    """A session on the same cluster whose streaming settings do not leak into ``spark``.

    ``state_partitions`` is frozen into a query's checkpoint on its first start, so size it for the
    stream's whole life; it defaults to the cores of the cluster. Without ``count_state`` a progress tells 0 rows of
    state: to count them, every key is looked up once more before it is put. With ``spare_disk`` the files that a
    micro-batch shuffled go when it is done, and a checkpoint keeps what its last two micro-batches need instead of the
    last hundred, so that a job can be restarted where it stopped, but not further back.
    """
    session = spark.newSession()
    for key, value in DEFAULTS.items():
        session.conf.set(key, value)
    session.conf.set(
        "spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism)
    )
    if not count_state:
        session.conf.set(COUNTED, "false")
    if spare_disk:
        session.conf.set(CLEANED, "true")
        session.conf.set(RETAINED, "2")
    return session


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The files that a query of ``spark`` shuffles go when it is done, not when the driver finds them unused."""
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANED, before)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``, or a temporary one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
