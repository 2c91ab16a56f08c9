"""Streaming queries: each runs its stream over everything available and returns what the sink holds."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from ledgerline.operators import scoring
from ledgerline.operators.enrich import enrich_stream
from ledgerline.operators.parse import to_bronze, with_event_date
from ledgerline.operators.tables import append, append_change, compact, upsert
from ledgerline.plans import fixtures, sql
from ledgerline.plans.registry import query
from ledgerline.plans.rows import silver_frame
from ledgerline.plans.tables import read
from ledgerline.schemas import AUTH_LOGS, STREAMS, SYSTEM_LOGS, TRANSACTIONS
from ledgerline.session import fresh_dir, streaming_session
from ledgerline.sources import files
from ledgerline.sources.streams import change_log, message_log, table_appends
from ledgerline.streaming import jobs


def _several(spark, log, batches=4):
    """Bounds a micro-batch, so that a query takes about so many of them, however many files the log has: what a
    micro-batch costs beside its rows, as reading the master data, is then paid no more often for a longer log."""
    held = files.data_files(spark, log).count()
    return {"maxFilesPerTrigger": str(max(1, math.ceil(held / batches)))}


def _log_of(spark, messages):
    """A message log in files, one folder per topic."""
    path = fresh_dir(spark, "log")
    messages.write.partitionBy("topic").parquet(path)
    return path


def _bronze_of(spark, rows, partition="dt"):
    path = fresh_dir(spark, "bronze")
    append(with_event_date(rows), path, partition)
    return path


def _silver_run(spark, bronze_path, stream, path, checkpoint=None, **options):
    # Nobody reads this job's progress.
    bronze = table_appends(streaming_session(spark, count_state=False), stream.bronze, bronze_path)
    jobs.drained(jobs.run_silver, bronze, stream, path, checkpoint or fresh_dir(spark, "checkpoint"), **options)


_BRONZE_TX = (
    f'SELECT * REPLACE ({sql.TS} AS "timestamp"), CAST(CAST({sql.TS} AS DATE) AS VARCHAR) AS dt '
    f"FROM ({fixtures.raw_sql(TRANSACTIONS)})"
)


@query("stream_route_transactions", _BRONZE_TX)
def stream_route_transactions(spark, sf_dir):
    """One topic out of a log of three, into bronze."""
    log = _log_of(spark, fixtures.all_topics(spark, sf_dir))
    path = fresh_dir(spark, "bronze")
    envelope = message_log(streaming_session(spark), "parquet", path=log)
    jobs.drained(jobs.run_bronze, envelope, TRANSACTIONS, path, fresh_dir(spark, "checkpoint"), partition=None)
    return spark.read.schema(TRANSACTIONS.bronze).parquet(path)


@query(
    "stream_bronze_partitioned",
    f'SELECT * REPLACE ({sql.TS} AS "timestamp"), CAST(CAST({sql.TS} AS DATE) AS VARCHAR) AS dt '
    f"FROM ({fixtures.raw_sql(AUTH_LOGS)})",
)
def stream_bronze_partitioned(spark, sf_dir):
    """The same into one folder per event date, rows without a readable time among them."""
    log = _log_of(spark, fixtures.envelope(fixtures.raw(spark, sf_dir, AUTH_LOGS), AUTH_LOGS))
    path = fresh_dir(spark, "bronze")
    envelope = message_log(streaming_session(spark), "parquet", path=log)
    jobs.drained(jobs.run_bronze, envelope, AUTH_LOGS, path, fresh_dir(spark, "checkpoint"))
    return spark.read.schema(AUTH_LOGS.bronze).parquet(path)


@query(
    "stream_three_queries",
    " UNION ALL ".join(
        f"SELECT '{s.bronze_table}' AS table_name, count(*) AS n FROM ({fixtures.raw_sql(s)})" for s in STREAMS.values()
    ),
)
def stream_three_queries(spark, sf_dir):
    """Three bronze queries at once over one log."""
    log = _log_of(spark, fixtures.all_topics(spark, sf_dir))
    session = streaming_session(spark)
    paths, running = {}, []
    for stream in STREAMS.values():
        paths[stream.bronze_table] = (path := fresh_dir(spark, "bronze")), stream.bronze
        envelope = message_log(session, "parquet", path=log)
        running.append(
            jobs.run_bronze(
                envelope, stream, path, fresh_dir(spark, "checkpoint"), jobs.ALL_AVAILABLE, None, stream.topic
            )
        )
    jobs.wait_for_all(running)
    counts = [
        spark.read.schema(schema).parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        for t, (path, schema) in paths.items()
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@query(
    "stream_dead_letters",
    "SELECT topic, payload FROM (SELECT 'auth_logs' AS topic, CASE k "
    + " ".join(f"WHEN {k} THEN {fixtures.BROKEN_PAYLOADS[k]}" for k in fixtures.UNREADABLE)
    + f" END AS payload FROM (SELECT *, {fixtures.K} AS k FROM events)) WHERE payload IS NOT NULL",
)
def stream_dead_letters(spark, sf_dir):
    log = _log_of(spark, fixtures.faulty_auth_envelope(spark, sf_dir))
    path = fresh_dir(spark, "dead")
    envelope = message_log(streaming_session(spark), "parquet", path=log)
    jobs.drained(jobs.run_dead_letters, envelope, AUTH_LOGS, path, fresh_dir(spark, "checkpoint"))
    return spark.read.schema("payload STRING, topic STRING").parquet(path)


@query(
    "stream_silver_transactions",
    f"SELECT transaction_id, CAST(dt AS VARCHAR) AS dt, count(*) AS n "
    f"FROM ({sql.silver(TRANSACTIONS)}) GROUP BY 1, 2",
)
def stream_silver_transactions(spark, sf_dir):
    """Which of the few natural copies survives is left open, so keys are compared."""
    path = fresh_dir(spark, "silver")
    _silver_run(spark, _bronze_of(spark, fixtures.raw(spark, sf_dir, TRANSACTIONS), None), TRANSACTIONS, path)
    return read(spark, path, TRANSACTIONS).groupBy(*TRANSACTIONS.keys).agg(F.count(F.lit(1)).alias("n"))


def _register_stream_silver(stream, name):
    @query(name, sql.shown(sql.silver(stream)))
    def run(spark, sf_dir):
        path = fresh_dir(spark, "silver")
        _silver_run(spark, _bronze_of(spark, fixtures.raw(spark, sf_dir, stream)), stream, path)
        return read(spark, path, stream)


_register_stream_silver(AUTH_LOGS, "stream_silver_auth")
_register_stream_silver(SYSTEM_LOGS, "stream_silver_system")

_DISTINCT_KEYS = (
    "SELECT event_id, CAST(dt AS VARCHAR) AS dt, count(*) AS n "
    f"FROM ({sql.silver(AUTH_LOGS, fixtures.raw_with_copies_sql(AUTH_LOGS))}) GROUP BY 1, 2"
)


def _keys_once(spark, path):
    return read(spark, path, AUTH_LOGS).groupBy(*AUTH_LOGS.keys).agg(F.count(F.lit(1)).alias("n"))


def _register_stream_dedup(name, **options):
    @query(name, _DISTINCT_KEYS)
    def run(spark, sf_dir):
        path = fresh_dir(spark, "silver")
        bronze = _bronze_of(spark, fixtures.raw_with_copies(spark, sf_dir, AUTH_LOGS))
        _silver_run(spark, bronze, AUTH_LOGS, path, **options)
        return _keys_once(spark, path)


_register_stream_dedup("stream_dedup")
_register_stream_dedup("stream_dedup_salted", salts=4)


@query("stream_dedup_stateless", _DISTINCT_KEYS)
def stream_dedup_stateless(spark, sf_dir):
    path = fresh_dir(spark, "silver")
    bronze = _bronze_of(spark, fixtures.raw_with_copies(spark, sf_dir, AUTH_LOGS))
    # Several micro-batches, so that copies, also of rows without a date, meet rows that the table holds already.
    source = table_appends(streaming_session(spark), AUTH_LOGS.bronze, bronze, {"maxFilesPerTrigger": "12"})
    jobs.drained(jobs.run_silver_stateless, source, AUTH_LOGS, path, fresh_dir(spark, "checkpoint"))
    return _keys_once(spark, path)


@query(
    "stream_dedup_bounded",
    f"SELECT log_id, CAST(dt AS VARCHAR) AS dt, count(*) AS n "
    f"FROM ({sql.silver(SYSTEM_LOGS, fixtures.raw_with_copies_sql(SYSTEM_LOGS))}) GROUP BY 1, 2",
)
def stream_dedup_bounded(spark, sf_dir):
    """State that expires with the watermark; all copies here lie within it."""
    path = fresh_dir(spark, "silver")
    bronze = _bronze_of(spark, fixtures.raw_with_copies(spark, sf_dir, SYSTEM_LOGS))
    _silver_run(spark, bronze, SYSTEM_LOGS, path, bounded=True)
    return read(spark, path, SYSTEM_LOGS).groupBy(*SYSTEM_LOGS.keys).agg(F.count(F.lit(1)).alias("n"))


# Arrival of system logs in three waves: by week, except that DEBUG and WARN messages come one wave late.
WAVE = (
    "LEAST(3, CASE WHEN \"timestamp\" < '2024-01-11' THEN 1 WHEN \"timestamp\" < '2024-01-21' THEN 2 ELSE 3 END "
    "+ CASE WHEN severity IN ('DEBUG', 'WARN') THEN 1 ELSE 0 END)"
)


def _wave(df, number):
    return df.filter(F.expr(WAVE.replace('"timestamp"', "`timestamp`")) == number)


@query(
    "stream_late_data",
    f"WITH r AS (SELECT *, {WAVE} AS wave, {sql.TS} AS ts FROM ({fixtures.raw_sql(SYSTEM_LOGS)}) "
    "WHERE log_id IS NOT NULL AND message IS NOT NULL), "
    "m AS (SELECT wave, max(date_trunc('milliseconds', ts)) AS latest FROM r GROUP BY wave) "
    "SELECT log_id FROM r WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.wave < r.wave AND "
    "r.ts <= m.latest - INTERVAL 1 HOUR)",
)
def stream_late_data(spark, sf_dir):
    """Rows more than an hour behind what earlier waves have shown are dropped.

    Every wave is one run on the same checkpoint. A run ends with a micro-batch without data, so the next wave
    meets the watermark of all waves before it.
    """
    stream = SYSTEM_LOGS
    bronze, path, checkpoint = (fresh_dir(spark, label) for label in ("bronze", "silver", "checkpoint"))
    rows = fixtures.raw(spark, sf_dir, stream)
    for number in (1, 2, 3):
        append(with_event_date(_wave(rows, number)), bronze)
        _silver_run(spark, bronze, stream, path, checkpoint)
    return read(spark, path, stream).select("log_id")


@query("stream_restart", sql.shown(sql.silver(AUTH_LOGS)))
def stream_restart(spark, sf_dir):
    """Stopped and started again on one checkpoint, with new files in between: nothing lost, nothing twice."""
    stream = AUTH_LOGS
    bronze, path, checkpoint = (fresh_dir(spark, label) for label in ("bronze", "silver", "checkpoint"))
    rows = fixtures.raw(spark, sf_dir, stream)
    early = "timestamp < '2024-01-16' OR timestamp = 'not-a-time'"
    # The second half repeats the last hours of the first, which the state must still know.
    late = f"NOT ({early}) OR timestamp BETWEEN '2024-01-15 23' AND '2024-01-16'"
    for part in (rows.filter(early), rows.filter(late)):
        append(with_event_date(part), bronze)
        _silver_run(spark, bronze, stream, path, checkpoint)
    return read(spark, path, stream)


@query("replay_all", sql.shown(sql.silver(SYSTEM_LOGS)))
def replay_all(spark, sf_dir):
    """All of bronze once more under a fresh checkpoint, into a filled table: by key, so nothing changes."""
    stream = SYSTEM_LOGS
    path = fresh_dir(spark, "silver")
    bronze = _bronze_of(spark, fixtures.raw(spark, sf_dir, stream))
    for _ in range(2):
        _silver_run(spark, bronze, stream, path)
    return read(spark, path, stream)


@query("replay_range", sql.shown(sql.silver(AUTH_LOGS)))
def replay_range(spark, sf_dir):
    """Silver is filled without the events of ten days, which are then replayed from bronze."""
    stream, path = AUTH_LOGS, fresh_dir(spark, "silver")
    bronze = _bronze_of(spark, fixtures.raw(spark, sf_dir, stream))
    first, last = dt.date(2024, 1, 11), dt.date(2024, 1, 20)
    gap = F.coalesce(F.col("dt").between(first, last), F.lit(False))
    upsert(silver_frame(spark, sf_dir, stream).filter(~gap), path, stream.keys)
    jobs.replay_dates(spark, bronze, stream, path, first, last)
    return read(spark, path, stream)


def _silver_log(spark, sf_dir, stream):
    """A change log of silver in two batches, the second of which was repeated."""
    path, rows = fresh_dir(spark, "changes"), silver_frame(spark, sf_dir, stream)
    batches = fixtures.steps_of(spark, rows, F.pmod(F.xxhash64(stream.key), F.lit(2)))
    for number, batch in ((0, batches(0)), (1, batches(1)), (1, rows)):
        append_change(batch, path, number, "fixture")
    return path


@query(
    "alerts_suspicious",
    'SELECT event_id, user_id, "timestamp", action, ip_address, CAST(dt AS VARCHAR) AS dt '
    f"FROM ({sql.silver(AUTH_LOGS)}) WHERE is_suspicious = 1",
)
def alerts_suspicious(spark, sf_dir):
    """Silver is filled in two runs of its job, the second with copies of rows of the first, corrected by an upsert
    and compacted; alerts run after each step on one checkpoint and come once per event."""
    stream = AUTH_LOGS
    bronze, path, log, alerts = (fresh_dir(spark, label) for label in ("bronze", "silver", "changes", "alerts"))
    cleaning, alerting = fresh_dir(spark, "checkpoint"), fresh_dir(spark, "checkpoint")
    rows = with_event_date(fixtures.raw(spark, sf_dir, stream))
    early = F.coalesce(F.col("dt") < dt.date(2024, 1, 16), F.lit(True))
    again = F.col("dt").between(dt.date(2024, 1, 14), dt.date(2024, 1, 15))
    silver = silver_frame(spark, sf_dir, stream)

    def alert():
        changes = change_log(streaming_session(spark), stream.silver, log)
        jobs.drained(jobs.run_alerts, changes, alerts, alerting)

    for part in (rows.filter(early), rows.filter(~early | again)):
        append(part, bronze)
        _silver_run(spark, bronze, stream, path, cleaning, log_path=log)
        alert()
    upsert(silver.filter(F.col("dt") == dt.date(2024, 1, 20)), path, stream.keys)
    compact(spark, path, values=[dt.date(2024, 1, 21)])
    alert()
    schema = "event_id STRING, user_id INT, timestamp TIMESTAMP, action STRING, ip_address STRING, dt DATE"
    return spark.read.schema(schema).parquet(alerts)


@query(
    "stream_enrich_customer",
    f"SELECT event_id, user_id, CAST(dt AS VARCHAR) AS dt, c_mktsegment, c_nationkey FROM ({sql.silver(AUTH_LOGS)}) "
    "LEFT JOIN customer ON user_id = c_custkey",
)
def stream_enrich_customer(spark, sf_dir):
    session, path = streaming_session(spark), fresh_dir(spark, "enriched")
    log = _silver_log(spark, sf_dir, AUTH_LOGS)
    silver = change_log(session, AUTH_LOGS.silver, log, _several(spark, log))
    master = fixtures.table(session, sf_dir, "customer")
    events = silver.select("event_id", "user_id", "dt")
    rows = enrich_stream(events, master, ("user_id", "c_custkey"), ["c_mktsegment", "c_nationkey"], "event_id")
    jobs.drained(jobs.to_files, rows, path, fresh_dir(spark, "checkpoint"), partition=None)
    return spark.read.parquet(path)


@query(
    "bi_hourly_merchant",
    f"WITH s AS ({sql.silver(TRANSACTIONS)}) SELECT date_trunc('hour', \"timestamp\") AS hour, merchant, count(*) AS n, "
    f"{sql.MONEY} AS total FROM s GROUP BY 1, 2 "
    "HAVING date_trunc('hour', \"timestamp\") + INTERVAL 1 HOUR <= (SELECT max(\"timestamp\") FROM s) - INTERVAL 1 HOUR",
)
def bi_hourly_merchant(spark, sf_dir):
    """Hours whose end the watermark has passed."""
    path = fresh_dir(spark, "bi")
    silver = change_log(
        streaming_session(spark), TRANSACTIONS.silver, _silver_log(spark, sf_dir, TRANSACTIONS)
    )
    jobs.drained(jobs.run_hourly_merchant, silver, path, fresh_dir(spark, "checkpoint"))
    return spark.read.schema("hour TIMESTAMP, merchant STRING, n BIGINT, total DOUBLE").parquet(path)


@query(
    "fraud_scores",
    f"SELECT transaction_id, CAST(dt AS VARCHAR) AS dt, is_fraud AS prediction FROM ({sql.silver(TRANSACTIONS)})",
)
def fraud_scores(spark, sf_dir):
    """Boosted trees fitted on silver, then applied to silver as a stream. Here an unreadable place gives the
    fraud away, so the model has to find every label."""
    stream = TRANSACTIONS
    log, path = _silver_log(spark, sf_dir, stream), fresh_dir(spark, "scores")
    model = scoring.train_fraud_model(spark.read.parquet(log))
    silver = change_log(streaming_session(spark), stream.silver, log, _several(spark, log))
    jobs.drained(jobs.run_scoring, model, silver, path, fresh_dir(spark, "checkpoint"))
    return spark.read.parquet(path).select("transaction_id", F.col("dt").cast("date").alias("dt"), "prediction")


@query(
    "bronze_from_log",
    f'SELECT event_id, {sql.TS} AS "timestamp", result FROM ({fixtures.raw_sql(AUTH_LOGS)})',
)
def bronze_from_log(spark, sf_dir):
    """The batch form of the same path, out of the same log."""
    log = _log_of(spark, fixtures.all_topics(spark, sf_dir))
    messages = spark.read.schema("value BINARY, topic STRING").parquet(log)
    return to_bronze(messages, AUTH_LOGS).select("event_id", "timestamp", "result")
