"""What streaming jobs wrote, batch by batch: rows, lateness and failures as a table.

A job started with ``measure`` counts its rows on their way into the sink, so nothing is read twice. Spark tells the
:class:`Recorder` of each finished micro-batch and of each query's end; it keeps one small JSON file for each.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerline.sources import files

MEASURES = "written"
_RECORDED = (
    "query STRING, name STRING, batch_id BIGINT, at TIMESTAMP, input_rows BIGINT, rows BIGINT, oldest BIGINT, "
    "newest BIGINT, dropped BIGINT, state_rows BIGINT, millis BIGINT, error STRING"
)


def measured(rows: DataFrame, time: str = "timestamp") -> DataFrame:
    """The same rows; each micro-batch's number of rows and its oldest and newest event time go to the listeners."""
    clock = F.unix_micros(F.col(time)) if time in rows.columns else F.lit(None).cast("bigint")
    return rows.observe(
        MEASURES, F.count(F.lit(1)).alias("rows"), F.min(clock).alias("oldest"), F.max(clock).alias("newest")
    )


def told(exception: str) -> str:
    """An exception's text without the lines of its stack traces."""
    return "\n".join(line for line in exception.splitlines() if line and not line[0].isspace())


class Recorder(StreamingQueryListener):
    """Keeps what the queries of a session do, below ``path``: ``session.streams.addListener(Recorder(spark, path))``.

    A batch's file is named by the query's checkpoint and the batch, so that it is held once. Nothing here starts a
    Spark job: Spark calls from the thread that serves all listeners.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._open: set[str] = set()
        self._changed = threading.Condition()

    def _keep(self, query: str, file: str, entry: dict) -> None:
        files.put_text(self._spark, f"{self._path}/{query}-{file}.json", json.dumps({"query": query, **entry}))

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(MEASURES)
        entry = {
            "name": p.name,
            "batch_id": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            "dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "millis": p.batchDuration,
        }
        self._keep(str(p.id), f"batch-{p.batchId}", {**entry, **(seen.asDict() if seen else {})})

    def onQueryIdle(self, event) -> None:
        """Nothing was written."""

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
            self._keep(str(event.id), f"failed-{event.runId}", {"at": now, "error": told(event.exception)})
        with self._changed:
            self._open.discard(str(event.runId))
            self._changed.notify_all()

    def settle(self, seconds: float = 60) -> None:
        """Waits until the end of every query that was started has been recorded."""
        with self._changed:
            if not self._changed.wait_for(lambda: not self._open, seconds):
                raise TimeoutError(f"{len(self._open)} queries still run")


@contextmanager
def recording(session: SparkSession, path: str) -> Iterator[Recorder]:
    """Records the queries that are started on ``session`` and end within the block."""
    recorder = Recorder(session, path)
    session.streams.addListener(recorder)
    try:
        yield recorder
        recorder.settle()
    finally:
        session.streams.removeListener(recorder)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch, and one per failure.

    ``rows`` were written, ``dropped`` came behind the watermark; ``late_by`` is how many seconds the batch's oldest
    event lies behind the newest of the batches before it (0 if it does not, or nothing came before), NULL without
    events that have a time. A failure has the number of the batch that it left undone and an ``error``; jobs that do not measure
    have ``rows`` NULL.
    """
    recorded = spark.read.schema(_RECORDED).json(path)
    # The listener may hear of a failure within the same millisecond as of the batch before; a failure comes after.
    so_far = Window.partitionBy("query").orderBy("at", F.col("error").isNotNull())
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    undone = F.coalesce(F.max(F.when(F.col("error").isNull(), F.col("batch_id"))).over(earlier) + 1, F.lit(0))
    behind = F.greatest(F.max("newest").over(earlier) - F.col("oldest"), F.lit(0)) / 1_000_000
    return recorded.select(
        "query",
        "name",
        F.when(F.col("error").isNull(), F.col("batch_id")).otherwise(undone).alias("batch_id"),
        "at",
        "input_rows",
        "rows",
        F.timestamp_micros("oldest").alias("oldest"),
        F.timestamp_micros("newest").alias("newest"),
        F.when(F.col("oldest").isNotNull(), behind).alias("late_by"),
        "dropped",
        "state_rows",
        "millis",
        "error",
    )
