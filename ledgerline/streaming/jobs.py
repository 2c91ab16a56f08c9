"""Streaming jobs: message log → bronze → silver, alerts, dashboards, scoring.

Every job takes a checkpoint folder. Sinks are append-only: native parquet files where rows are only added
(exactly once through the sink's own log), a keyed upsert per micro-batch for silver (harmless to repeat).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterable, Mapping

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerline import schemas
from ledgerline.functions.columns import exact_sum
from ledgerline.operators import dedup, scoring
from ledgerline.operators.clean import clean
from ledgerline.operators.drift import to_bronze_open
from ledgerline.operators.parse import dead_letters, to_bronze
from ledgerline.operators.risk import suspicious
from ledgerline.operators.tables import UpsertResult, append_change, insert_new, overwrite_partitions, upsert
from ledgerline.schemas import EventStream
from ledgerline.streaming.progress import measured

Trigger = Mapping[str, object]
# Default of the bronze jobs: the next micro-batch starts when the last one is done.
AS_FAST_AS_POSSIBLE: Trigger = {}
SILVER_TRIGGER: Trigger = {"processingTime": schemas.SILVER_TRIGGER}
ALL_AVAILABLE: Trigger = {"availableNow": True}


def _start(writer: DataStreamWriter, name: str | None, checkpoint: str, trigger: Trigger) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def to_files(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = AS_FAST_AS_POSSIBLE,
    partition: str | None = "dt",
    name: str | None = None,
    measure: bool = False,
) -> StreamingQuery:
    """Append-only parquet sink. With ``measure`` the listeners learn what each micro-batch wrote
    (:mod:`~ledgerline.streaming.progress`)."""
    writer = (measured(rows) if measure else rows).writeStream.format("parquet").option("path", path)
    if partition:
        writer = writer.partitionBy(partition)
    return _start(writer, name, checkpoint, trigger)


def run_bronze(
    envelope: DataFrame,
    stream: EventStream,
    path: str,
    checkpoint: str,
    trigger: Trigger = AS_FAST_AS_POSSIBLE,
    partition: str | None = "dt",
    name: str | None = None,
    measure: bool = False,
) -> StreamingQuery:
    """One topic of the message log into its bronze table: parse, type the event time, append. No shuffle and no
    Python callback in the path.

    A task writes one file per date it meets. A replay of many years is better landed with ``partition=None``.
    """
    return to_files(to_bronze(envelope, stream), path, checkpoint, trigger, partition, name, measure)


def run_bronze_open(
    envelope: DataFrame,
    stream: EventStream,
    path: str,
    checkpoint: str,
    trigger: Trigger = AS_FAST_AS_POSSIBLE,
    partition: str | None = "dt",
    name: str | None = None,
) -> StreamingQuery:
    """As :func:`run_bronze`, with what the wire schema does not read kept in ``extra``."""
    return to_files(to_bronze_open(envelope, stream), path, checkpoint, trigger, partition, name)


def run_dead_letters(
    envelope: DataFrame, stream: EventStream, path: str, checkpoint: str, trigger: Trigger = AS_FAST_AS_POSSIBLE
) -> StreamingQuery:
    """Payloads of a topic that hold none of its fields, kept beside the bronze table."""
    return to_files(dead_letters(envelope, stream), path, checkpoint, trigger, "topic")


def silver_rows(
    bronze: DataFrame,
    stream: EventStream,
    watermark: str = schemas.WATERMARK,
    bounded: bool = False,
    salts: int = 0,
) -> DataFrame:
    """Watermarked, cleaned and deduplicated stream. Late rows are dropped by the stateful dedup."""
    cleaned = clean(bronze.withWatermark("timestamp", watermark), stream)
    if bounded:
        return dedup.stream_one_per_key_bounded(cleaned, stream.keys)
    return dedup.stream_one_per_key(cleaned, stream.keys, salts)


def _upsert_batch(
    session: SparkSession,
    stream: EventStream,
    path: str,
    checkpoint: str,
    undated_path: str | None,
    log_path: str | None,
    buckets: int,
) -> Callable[[DataFrame, int], None]:
    # Batches are counted from zero under each checkpoint.
    run = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def logged(batch: DataFrame, batch_id: int) -> None:
        if log_path is not None and not batch.isEmpty():
            append_change(batch, log_path, batch_id, run)

    def write(batch: DataFrame, batch_id: int) -> None:
        if undated_path is None and log_path is None:
            upsert(batch, path, stream.keys, buckets=buckets, session=session)
            return
        # Held for both writes, so that the state is asked once and a measured job counts each row once.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if undated_path is None:
                upsert(batch, path, stream.keys, buckets=buckets, session=session)
                logged(batch, batch_id)
                return
            undated = batch.filter(F.col("dt").isNull()).drop("dt").withColumn("batch_id", F.lit(batch_id))
            overwrite_partitions(undated, f"{undated_path}/run={run}", "batch_id")
            upsert(batch.filter(F.col("dt").isNotNull()), path, stream.keys, buckets=buckets, session=session)
            logged(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def run_silver(
    bronze: DataFrame,
    stream: EventStream,
    path: str,
    checkpoint: str,
    trigger: Trigger = SILVER_TRIGGER,
    watermark: str = schemas.WATERMARK,
    bounded: bool = False,
    salts: int = 0,
    undated_path: str | None = None,
    log_path: str | None = None,
    buckets: int = 1,
    name: str | None = None,
    measure: bool = False,
) -> StreamingQuery:
    """Bronze appends into the silver table: the first arrival of a key is written; a replay under a new
    checkpoint overwrites by key.

    ``bounded`` lets dedup state expire with the watermark (copies further apart are then written again, over the
    earlier ones). ``salts`` spreads hot keys. Rows without a readable time never match a key, so a replay adds
    them again; with ``undated_path`` they go to that folder instead, one sub-folder per checkpoint and micro-batch,
    so that a repeated micro-batch replaces its own rows.

    ``log_path`` is an append-only log of the accepted rows, one folder per micro-batch. Streams over silver read
    it (:func:`~ledgerline.sources.streams.change_log`): the table's own files are replaced by upserts and
    compaction, and a stream of them would see rows again. ``buckets`` divides each date of the table. ``measure`` as
    in :func:`to_files`.
    """
    rows = silver_rows(bronze, stream, watermark, bounded, salts)
    if measure:
        rows = measured(rows)
    writer = rows.writeStream.foreachBatch(_upsert_batch(bronze.sparkSession, stream, path, checkpoint, undated_path, log_path, buckets))
    return _start(writer, name, checkpoint, trigger)


def run_silver_stateless(
    bronze: DataFrame,
    stream: EventStream,
    path: str,
    checkpoint: str,
    trigger: Trigger = SILVER_TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """Same table without dedup state: each micro-batch is reduced to one row per key and only keys the table does
    not hold yet are added. Late rows are kept, and copies of one key are reduced before the shuffle."""

    def write(batch: DataFrame, batch_id: int) -> None:
        insert_new(dedup.one_per_key(batch, stream.keys), path, stream.keys, session=bronze.sparkSession)

    return _start(clean(bronze, stream).writeStream.foreachBatch(write), name, checkpoint, trigger)


def run_alerts(
    silver_auth: DataFrame, path: str, checkpoint: str, trigger: Trigger = AS_FAST_AS_POSSIBLE
) -> StreamingQuery:
    """Suspicious login events, as they arrive, out of the change log of silver."""
    return to_files(suspicious(silver_auth), path, checkpoint, trigger)


def alert_messages(silver_auth: DataFrame) -> DataFrame:
    """The same alerts as ``(key, value)`` messages: event id and JSON."""
    return suspicious(silver_auth).select(F.col("event_id").alias("key"), F.to_json(F.struct("*")).alias("value"))


def run_alerts_to_kafka(
    silver_auth: DataFrame, servers: str, topic: str, checkpoint: str, trigger: Trigger = AS_FAST_AS_POSSIBLE
) -> StreamingQuery:
    """Alerts as messages (needs Spark's Kafka connector on the classpath)."""
    writer = alert_messages(silver_auth).writeStream.format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return _start(writer, None, checkpoint, trigger)


def hourly_merchant(silver: DataFrame, watermark: str = schemas.WATERMARK) -> DataFrame:
    """Sales per merchant and hour; as a stream an hour is emitted once the watermark has passed its end."""
    return (
        silver.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", "1 hour"), "merchant")
        .agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("amount")).alias("total"))
        .select(F.col("window.start").alias("hour"), "merchant", "n", "total")
    )


def run_hourly_merchant(
    silver: DataFrame, path: str, checkpoint: str, trigger: Trigger = AS_FAST_AS_POSSIBLE
) -> StreamingQuery:
    return to_files(hourly_merchant(silver), path, checkpoint, trigger, None)


def run_scoring(
    model: PipelineModel, silver: DataFrame, path: str, checkpoint: str, trigger: Trigger = AS_FAST_AS_POSSIBLE
) -> StreamingQuery:
    """Fraud scores for transactions as they arrive."""
    return to_files(scoring.score(model, silver), path, checkpoint, trigger, None)


def drained(start: Callable[..., StreamingQuery], *args, **options) -> None:
    """Runs one query to the end of its input; a failure surfaces here."""
    start(*args, trigger=ALL_AVAILABLE, **options).awaitTermination()


def wait_for_all(queries: Iterable[StreamingQuery]) -> None:
    """Blocks while any of the queries runs and raises as soon as one has failed, whichever it is."""
    running = list(queries)
    while running:
        running = [q for q in running if not q.awaitTermination(timeout=1)]


def replay_dates(
    spark: SparkSession, bronze_path: str, stream: EventStream, path: str, first: dt.date, last: dt.date
) -> UpsertResult:
    """Bronze of a range of event dates once more into silver, as one batch: only those partitions are read, and
    rows that are there already are replaced by key."""
    bronze = spark.read.schema(stream.bronze).parquet(bronze_path).filter(F.col("dt").between(first, last))
    return upsert(dedup.one_per_key(clean(bronze, stream), stream.keys), path, stream.keys)
