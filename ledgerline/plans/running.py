"""Sessions and running totals, each filled in several steps with a restart between them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators.tables import append_change, read_merged
from ledgerline.plans import fixtures, sql
from ledgerline.plans.alerts import STATE_PARTITIONS, in_steps
from ledgerline.plans.registry import query
from ledgerline.plans.rows import silver_frame
from ledgerline.schemas import AUTH_LOGS, TRANSACTIONS
from ledgerline.session import fresh_dir, streaming_session
from ledgerline.sources.streams import change_log
from ledgerline.streaming import jobs, running

GAP_MINUTES = 240

_SESSIONS = (
    'WITH e AS (SELECT *, "timestamp" AS t FROM ({silver}) WHERE "timestamp" IS NOT NULL), '
    f"s AS (SELECT *, CASE WHEN t < lag(t) OVER w + INTERVAL {GAP_MINUTES} MINUTE THEN 0 ELSE 1 END AS fresh "
    "FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)), "
    "b AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t RANGE UNBOUNDED PRECEDING) AS b FROM s) "
    'SELECT user_id, min(t) AS "first", max(t) AS "last", count(*) AS events, '
    "count(*) FILTER (WHERE action = 'login') AS logins, "
    "count(*) FILTER (WHERE action = 'login' AND is_success = 0) AS failures, count(DISTINCT device_id) AS devices "
    "FROM b GROUP BY user_id, b"
).format(silver=sql.silver(AUTH_LOGS))


@query("user_sessions", _SESSIONS)
def user_sessions(spark, sf_dir):
    return running.user_sessions(silver_frame(spark, sf_dir, AUTH_LOGS), f"{GAP_MINUTES} minutes")


@query(
    "stream_user_sessions",
    f"{_SESSIONS} HAVING max(t) + INTERVAL {GAP_MINUTES} MINUTE <= "
    "(SELECT max(date_trunc('milliseconds', t)) FROM e) - INTERVAL 1 HOUR",
)
def stream_user_sessions(spark, sf_dir):
    """Closed sessions, those that span a restart among them."""
    path, checkpoint = fresh_dir(spark, "sessions"), fresh_dir(spark, "checkpoint")

    def run(log, partitions):
        silver = change_log(streaming_session(spark, partitions), AUTH_LOGS.silver, log)
        jobs.drained(running.run_user_sessions, silver, path, checkpoint, gap=f"{GAP_MINUTES} minutes")

    in_steps(spark, silver_frame(spark, sf_dir, AUTH_LOGS), run)
    return spark.read.schema(running.SESSIONS).parquet(path)


# Payments arrive in three steps: by time, but those of every third order of the 60 days before a cut come one later.
PAYMENT_CUTS = ("1996-01-01", "2000-01-01")
_LATE_DAYS = 60


def _step(time: str, number: str) -> str:
    steps = [
        f"CASE WHEN {time} >= CAST('{cut}' AS TIMESTAMP) OR ({number} % 3 = 0 AND "
        f"{time} >= CAST('{cut}' AS TIMESTAMP) - INTERVAL '{_LATE_DAYS}' DAY) THEN 1 ELSE 0 END"
        for cut in PAYMENT_CUTS
    ]
    return " + ".join(steps)


_ORDER = r"CAST(regexp_extract(transaction_id, 'T([0-9]+)-', 1) AS BIGINT)"


@query(
    "bi_running_hours",
    f"SELECT date_trunc('hour', \"timestamp\") AS hour, merchant, count(*) AS n, {sql.MONEY} AS total, "
    f"count(DISTINCT {_step('"timestamp"', _ORDER)}) AS revisions FROM ({sql.silver(TRANSACTIONS)}) "
    'WHERE "timestamp" IS NOT NULL GROUP BY 1, 2',
)
def bi_running_hours(spark, sf_dir):
    """The table of totals after late payments have revised hours that had been written, and how often each was."""
    changes, path, log, checkpoint = (fresh_dir(spark, n) for n in ("changes", "hours", "revisions", "checkpoint"))
    sides, step = {TRANSACTIONS.topic: silver_frame(spark, sf_dir, TRANSACTIONS)}, F.expr(_step("timestamp", _ORDER))
    # An hour of a step is one slice's, so a step revises it once however many slices it has.
    partitions, batches = fixtures.in_slices(spark, sides, step, 24 * (_LATE_DAYS + 1) + 1, STATE_PARTITIONS)
    for number, rows in batches:
        append_change(rows[TRANSACTIONS.topic], changes, number, "fixture")
        session = streaming_session(spark, partitions, count_state=False, spare_disk=True)
        silver = change_log(session, TRANSACTIONS.silver, changes)
        jobs.drained(running.run_hour_totals, silver, path, log, checkpoint, watermark=f"{_LATE_DAYS + 1} days")
    table = read_merged(spark, path).withColumn("month", F.date_format("hour", "yyyy-MM"))
    return table.join(running.revisions(spark, log), list(running.HOUR_KEYS)).drop("month")
