"""Numbers that grow while events arrive: user sessions, and hourly totals that late rows revise."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline import schemas
from ledgerline.functions.columns import exact_sum
from ledgerline.operators.tables import append_change, upsert
from ledgerline.streaming.jobs import AS_FAST_AS_POSSIBLE, Trigger, to_files

SESSIONS = "user_id INT, first TIMESTAMP, last TIMESTAMP, events BIGINT, logins BIGINT, failures BIGINT, devices BIGINT"
# Merges the sessions of a micro-batch before the shuffle, so that a busy user costs one row a task.
_MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
HOUR_KEYS = ("hour", "merchant", "month")
# Estimate of distinct devices: 2^12 registers, a standard error of about 1.6 %.
_REGISTERS = 12


def user_sessions(auth: DataFrame, gap: str, watermark: str = schemas.WATERMARK) -> DataFrame:
    """Sessions of a user: events each less than ``gap`` after the one before. Rows without a user or a time belong
    to none. Works on batch and stream; a stream emits a session once the watermark has passed its end.

    The state of an open session is its counts and a sketch of its devices, whose estimate is exact for few devices.
    """
    if auth.isStreaming:
        auth.sparkSession.conf.set(_MERGE_FIRST, "true")
        auth = auth.withWatermark("timestamp", watermark)
    rows = auth.filter(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull())
    login = F.col("action") == "login"
    return (
        rows.groupBy("user_id", F.session_window("timestamp", gap))
        .agg(
            F.min("timestamp").alias("first"),
            F.max("timestamp").alias("last"),
            F.count(F.lit(1)).alias("events"),
            F.count_if(login).alias("logins"),
            F.count_if(login & (F.col("is_success") == 0)).alias("failures"),
            F.hll_sketch_estimate(F.hll_sketch_agg("device_id", _REGISTERS)).alias("devices"),
        )
        .select("user_id", "first", "last", "events", "logins", "failures", F.coalesce("devices", F.lit(0)).alias("devices"))
    )


def run_user_sessions(
    silver_auth: DataFrame, path: str, checkpoint: str, gap: str, watermark: str = schemas.WATERMARK, trigger: Trigger = AS_FAST_AS_POSSIBLE
) -> StreamingQuery:
    """Closed sessions, each once."""
    return to_files(user_sessions(silver_auth, gap, watermark), path, checkpoint, trigger, None)


def hour_totals(silver: DataFrame, watermark: str) -> DataFrame:
    """Sales per hour and merchant so far; as a stream in update mode an hour comes again whenever rows change it."""
    if silver.isStreaming:
        silver = silver.withWatermark("timestamp", watermark)
    return (
        silver.filter(F.col("timestamp").isNotNull() & F.col("merchant").isNotNull())
        .groupBy(F.window("timestamp", "1 hour"), "merchant")
        .agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("amount")).alias("total"))
        .select(
            F.col("window.start").alias("hour"),
            "merchant",
            "n",
            "total",
            F.date_format("window.start", "yyyy-MM").alias("month"),
        )
    )


def run_hour_totals(
    silver: DataFrame,
    path: str,
    log_path: str,
    checkpoint: str,
    watermark: str = schemas.WATERMARK,
    buckets: int = 1,
    trigger: Trigger = AS_FAST_AS_POSSIBLE,
) -> StreamingQuery:
    """Keeps the table at ``path`` at the totals so far, and logs every revision at ``log_path``.

    A micro-batch carries the whole new total of the hours it changed, never a difference, so a repeated one changes
    nothing. The watermark says how late a row may be and still revise its hour; the state of older hours goes.
    The table is divided by month, and by ``buckets`` within it, and a revision rewrites those it touches only.
    """
    spark = silver.sparkSession
    run = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        # Held for both writes: the log is written from the same totals.
        held = batch.persist()
        try:
            if held.isEmpty():
                return
            upsert(held, path, HOUR_KEYS, "month", buckets, session=spark)
            append_change(held, log_path, batch_id, run)
        finally:
            held.unpersist()

    writer = hour_totals(silver, watermark).writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def revisions(spark: SparkSession, log_path: str, keys: Sequence[str] = HOUR_KEYS) -> DataFrame:
    """How often each hour was written."""
    return spark.read.parquet(log_path).groupBy(*keys).agg(F.count(F.lit(1)).alias("revisions"))
