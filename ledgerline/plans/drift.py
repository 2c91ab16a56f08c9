"""Drifting payloads: login messages with fields that the wire schema lacks and values that it cannot read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import drift
from ledgerline.plans import fixtures
from ledgerline.plans.registry import query
from ledgerline.schemas import AUTH_LOGS
from ledgerline.session import fresh_dir, streaming_session
from ledgerline.sources.streams import message_log
from ledgerline.streaming import jobs

# Fields beside the wire's: (condition on ``k``, JSON text in Spark).
ADDED = {
    "risk": [("k % 5 = 0", "CAST(k AS STRING)"), ("k % 5 = 1", "concat(CAST(k AS STRING), '.5')")],
    "channel": [("k % 3 = 0", "'\"app\"'")],
    "note": [("k % 4 = 0", "CAST(k AS STRING)"), ("k % 4 = 1", "concat('\"n', CAST(k AS STRING), '\"')")],
    "trusted": [("k % 7 = 1", "'true'"), ("k % 7 = 2", "'null'")],
    "user_id": [("k >= 90", "concat('\"u', CAST(user_id AS STRING), '\"')")],
}
TYPES = {"risk": "DOUBLE", "channel": "STRING", "note": "STRING", "trusted": "BOOLEAN", "user_id": "STRING"}
_EVENTS = f"(SELECT *, {fixtures.K} AS k FROM events)"


def _any(name: str) -> str:
    return "(" + " OR ".join(condition for condition, _ in ADDED[name]) + ")"


def _drifting(spark, sf_dir):
    columns = {**fixtures.AUTH_COLUMNS, "user_id": "CASE WHEN k >= 90 THEN NULL ELSE CAST(user_id AS INT) END"}
    proper = F.to_json(F.struct(*[F.expr(e).alias(c) for c, e in columns.items()]))
    text = F.substring(proper, F.lit(1), F.length(proper) - 1)
    for name, forms in ADDED.items():
        for condition, value in forms:
            text = F.concat(text, F.when(F.expr(condition), F.expr(f"concat(',\"{name}\":', {value})")).otherwise(""))
    return fixtures.messages(fixtures.source_rows(spark, sf_dir, AUTH_LOGS), AUTH_LOGS, F.concat(text, F.lit("}")))


def _bronze(spark, sf_dir):
    """The messages in two halves, each landed by a run of the job on one checkpoint; the first half has no news."""
    log, path, checkpoint = (fresh_dir(spark, label) for label in ("log", "bronze", "checkpoint"))
    rows = fixtures.envelope(fixtures.raw(spark, sf_dir, AUTH_LOGS), AUTH_LOGS)
    for batch in (rows, _drifting(spark, sf_dir)):
        batch.write.mode("append").partitionBy("topic").parquet(log)
        envelope = message_log(streaming_session(spark), "parquet", path=log)
        jobs.drained(jobs.run_bronze_open, envelope, AUTH_LOGS, path, checkpoint, partition=None)
    return spark.read.schema(drift.open_schema(AUTH_LOGS)).parquet(path)


@query(
    "drift_fields",
    " UNION ALL ".join(
        f"SELECT '{name}' AS field, count(*) AS n, count(*) FILTER (WHERE {'k % 7 = 2' if name == 'trusted' else 'false'}) "
        f"AS nulls, '{kind}' AS column_type FROM {_EVENTS} WHERE {_any(name)}"
        for name, kind in TYPES.items()
    ),
)
def drift_fields(spark, sf_dir):
    """What the messages hold beside the wire schema, and the columns it could become."""
    return drift.found_fields(_bronze(spark, sf_dir))


_USER = "CAST(CAST(user_id AS INT) AS VARCHAR)"


@query(
    "drift_promoted",
    "SELECT event_id, action, user_id, risk, channel, note, trusted, nothing_left FROM ("
    f"SELECT concat('E', CAST(event_id AS VARCHAR)) AS event_id, {fixtures.AUTH_COLUMNS['action']} AS action, "
    f"CASE WHEN k <> 7 THEN {_USER} END AS user_id, CAST(NULL AS DOUBLE) AS risk, CAST(NULL AS VARCHAR) AS channel, "
    f"CAST(NULL AS VARCHAR) AS note, CAST(NULL AS BOOLEAN) AS trusted, true AS nothing_left FROM {_EVENTS} UNION ALL "
    f"SELECT concat('E', CAST(event_id AS VARCHAR)), {fixtures.AUTH_COLUMNS['action']}, "
    f"CASE WHEN k >= 90 THEN concat('u', {_USER}) ELSE {_USER} END, "
    "CASE WHEN k % 5 = 0 THEN CAST(k AS DOUBLE) WHEN k % 5 = 1 THEN k + CAST(0.5 AS DOUBLE) END, "
    "CASE WHEN k % 3 = 0 THEN 'app' END, "
    "CASE WHEN k % 4 = 0 THEN CAST(k AS VARCHAR) WHEN k % 4 = 1 THEN concat('n', CAST(k AS VARCHAR)) END, "
    f"CASE WHEN k % 7 = 1 THEN true END, true FROM {_EVENTS})",
)
def drift_promoted(spark, sf_dir):
    """All found fields as columns; the user's column widens to text, and nothing is left over."""
    rows = _bronze(spark, sf_dir)
    rows = drift.promote(rows, drift.promotions(rows, 0.01))
    shown = ["event_id", "action", "user_id", "risk", "channel", "note", "trusted"]
    return rows.select(*shown, F.col(drift.EXTRA).isNull().alias("nothing_left"))
