"""Streaming jobs: late rows, restarts, repeats, equality with batch."""

import datetime as dt
import inspect

import pytest
from pyspark.sql import functions as F

from ledgerline import session as S
from ledgerline.operators import tables as T
from ledgerline.operators.clean import clean
from ledgerline.operators.dedup import one_per_key
from ledgerline.operators.parse import to_bronze, with_event_date
from ledgerline.plans import fixtures
from ledgerline.schemas import AUTH_LOGS, STREAMS, SYSTEM_LOGS
from ledgerline.sources.streams import change_log, kafka_options, message_log, table_appends
from ledgerline.streaming import jobs
from tests.conftest import SF_DIR


def log_rows(spark, *rows):
    """System-log bronze rows from (id, time, message)."""
    wire = [(i, t, "api", "cache", "INFO", m) for i, t, m in rows]
    return with_event_date(spark.createDataFrame(wire, SYSTEM_LOGS.wire))


def run(spark, bronze, path, checkpoint, stream=SYSTEM_LOGS, job=jobs.run_silver, options=None, **settings):
    source = table_appends(S.streaming_session(spark, 4), stream.bronze, bronze, options)
    query = job(source, stream, path, checkpoint, trigger=jobs.ALL_AVAILABLE, **settings)
    query.awaitTermination()
    return query


def silver(spark, path, stream=SYSTEM_LOGS):
    return spark.read.schema(stream.silver).parquet(path)


def ids(spark, path):
    return sorted(r.log_id for r in silver(spark, path).collect())


def test_checkpoint_and_path_have_no_default():
    for job in (jobs.to_files, jobs.run_bronze, jobs.run_silver, jobs.run_alerts, jobs.run_scoring):
        parameters = inspect.signature(job).parameters
        assert parameters["checkpoint"].default is inspect.Parameter.empty
        assert parameters["path"].default is inspect.Parameter.empty
    assert jobs.SILVER_TRIGGER == {"processingTime": "10 seconds"} and jobs.AS_FAST_AS_POSSIBLE == {}


def test_kafka_options():
    assert kafka_options("h:9092", ["a", "b"]) == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
    }


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == S.ROCKSDB
    assert S.fresh_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert S.streaming_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_silver_holds_no_batch_for_an_empty_table(spark, folder, monkeypatch):
    """The state is asked once: without a log the first micro-batch goes straight into the table."""
    rows = [(f"l{i % 50}", "2024-01-01 10:00:00", "m") for i in range(100)]
    T.append(log_rows(spark, *rows), folder("bronze"))
    held = []
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda df, *_: held.append(df) or df)
    source = table_appends(S.streaming_session(spark, 2, count_state=False), SYSTEM_LOGS.bronze, folder("bronze"))
    jobs.drained(jobs.run_silver, source, SYSTEM_LOGS, folder("silver"), folder("checkpoint"))
    # What is held is the micro-batch without rows that ends the run.
    assert len(held) == 1 and ids(spark, folder("silver")) == sorted(f"l{i}" for i in range(50))


def test_state_rows_are_counted_unless_told_not_to(spark):
    assert S.streaming_session(spark, 2, count_state=False).conf.get(S.COUNTED) == "false"
    assert S.streaming_session(spark, 2).conf.get(S.COUNTED, "true") == "true"


def test_late_rows_one_file_per_batch(spark, folder):
    """Within one run a batch is filtered by the watermark of the batch before last: late1 still passes."""
    bronze = folder("bronze")
    batches = [
        [("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:10:00")],
        [("c", "2024-01-01 20:00:00")],
        [("late1", "2024-01-01 10:20:00"), ("vlate", "2024-01-01 08:00:00")],
        [("late2", "2024-01-01 10:30:00")],
    ]
    for rows in batches:
        T.append(log_rows(spark, *[(i, t, "m") for i, t in rows]).coalesce(1), bronze, None)
    run(spark, bronze, folder("silver"), folder("ck"), options={"maxFilesPerTrigger": 1})
    assert ids(spark, folder("silver")) == ["a", "b", "c", "late1"]


def test_late_rows_across_runs(spark, folder):
    """A run ends with a batch without data, so the next one meets the full watermark."""
    bronze = folder("bronze")
    for rows in ([("a", "2024-01-01 10:00:00")], [("late", "2024-01-01 08:59:00"), ("ok", "2024-01-01 09:01:00")]):
        T.append(log_rows(spark, *[(i, t, "m") for i, t in rows]), bronze, None)
        run(spark, bronze, folder("silver"), folder("ck"))
    assert ids(spark, folder("silver")) == ["a", "ok"]


@pytest.mark.parametrize("salts", [0, 3])
def test_first_arrival_wins_until_the_checkpoint_is_lost(spark, folder, salts):
    bronze, path = folder("bronze"), folder("silver")
    for message in ("first", "second"):
        T.append(log_rows(spark, *[("a", "2024-01-01 10:00:00", message)] * 20), bronze, None)
        run(spark, bronze, path, folder("ck"), salts=salts)
    assert [r.message for r in silver(spark, path).collect()] == ["first"]
    # Only the second message is replayed under a new checkpoint: the last write wins.
    T.append(log_rows(spark, ("a", "2024-01-01 10:00:00", "third")), folder("again"), None)
    run(spark, folder("again"), path, folder("ck2"), salts=salts)
    assert [r.message for r in silver(spark, path).collect()] == ["third"]


def test_stateless_job_keeps_the_first_write(spark, folder):
    bronze, path = folder("bronze"), folder("silver")
    for number, message in enumerate(("first", "second")):
        T.append(log_rows(spark, *[("a", "2024-01-01 10:00:00", message)] * 5), bronze, None)
        run(spark, bronze, path, folder(f"ck{number}"), job=jobs.run_silver_stateless)
    assert [r.message for r in silver(spark, path).collect()] == ["first"]


def test_undated_rows_can_be_diverted(spark, folder):
    bronze, path, undated = folder("bronze"), folder("silver"), folder("undated")
    T.append(log_rows(spark, ("a", "2024-01-01 10:00:00", "m"), ("b", "never", "m")), bronze, None)
    run(spark, bronze, path, folder("ck"), undated_path=undated)
    assert ids(spark, path) == ["a"]
    assert [r.log_id for r in spark.read.parquet(undated).collect()] == ["b"]
    run(spark, bronze, path, folder("ck2"))
    assert ids(spark, path) == ["a", "b"]


def test_repeated_micro_batch(spark, folder):
    """What Spark does after a crash between the sink and the commit log."""
    path, undated = folder("silver"), folder("undated")
    write = jobs._upsert_batch(spark, SYSTEM_LOGS, path, "checkpoint", undated, folder("log"), 1)
    batch = clean(log_rows(spark, ("a", "2024-01-01 10:00:00", "m"), ("b", None, "m")), SYSTEM_LOGS)
    for _ in range(2):
        write(batch, 7)
    assert ids(spark, path) == ["a"] and spark.read.parquet(undated).count() == 1
    assert spark.read.parquet(folder("log")).count() == 2


@pytest.mark.parametrize("stream", STREAMS.values(), ids=STREAMS)
def test_stream_equals_batch(spark, folder, stream):
    """Log → bronze → silver as streams and the same functions as a batch, on rows of a single month."""
    rows = fixtures.raw(spark, SF_DIR, stream).filter(
        F.col("timestamp").between("2000-01-01", "2000-02-01") | F.col("timestamp").startswith("2024")
    )
    fixtures.envelope(rows, stream).write.parquet(folder("log"))
    envelope = message_log(S.streaming_session(spark, 4), "parquet", path=folder("log"))
    jobs.run_bronze(envelope, stream, folder("bronze"), folder("ck1"), jobs.ALL_AVAILABLE).awaitTermination()
    run(spark, folder("bronze"), folder("silver"), folder("ck2"), stream)
    messages = spark.read.schema("topic STRING, value BINARY").parquet(folder("log"))
    batch = one_per_key(clean(to_bronze(messages, stream), stream), stream.keys)
    streamed = silver(spark, folder("silver"), stream)
    assert batch.count() == streamed.count() > 50
    assert batch.exceptAll(streamed.select(*batch.columns)).isEmpty()


def test_restart_neither_loses_nor_repeats(spark, folder):
    rows = with_event_date(fixtures.raw(spark, SF_DIR, AUTH_LOGS)).filter("dt IS NOT NULL")
    for early in (True, False):
        T.append(rows.filter((F.col("dt") < "2024-01-15") == early), folder("bronze"))
        run(spark, folder("bronze"), folder("silver"), folder("ck"), AUTH_LOGS)
    run(spark, folder("bronze"), folder("silver"), folder("ck"), AUTH_LOGS)
    expected = one_per_key(clean(rows, AUTH_LOGS), AUTH_LOGS.keys)
    got = silver(spark, folder("silver"), AUTH_LOGS)
    assert got.count() == expected.count() and expected.exceptAll(got.select(*expected.columns)).isEmpty()


def test_a_failing_query_is_noticed(spark, folder):
    T.append(log_rows(spark, ("a", "2024-01-01 10:00:00", "m")), folder("bronze"), None)
    session = S.streaming_session(spark, 4)
    source = table_appends(session, SYSTEM_LOGS.bronze, folder("bronze"))
    broken = source.withColumn("message", F.raise_error(F.lit("boom")).cast("string"))
    queries = [
        jobs.to_files(source, folder("fine"), folder("ck1"), {"processingTime": "1 second"}),
        jobs.to_files(broken, folder("broken"), folder("ck2"), {"processingTime": "1 second"}),
    ]
    try:
        with pytest.raises(Exception, match="boom"):
            jobs.wait_for_all(queries)
    finally:
        for query in queries:
            query.stop()


def test_hourly_windows_wait_for_the_watermark(spark, folder):
    rows = [("m", dt.datetime(2024, 1, 1, h), 1.25) for h in (1, 1, 2, 5)]
    df = spark.createDataFrame(rows, "merchant STRING, timestamp TIMESTAMP, amount DOUBLE")
    df.write.parquet(folder("in"))
    source = S.streaming_session(spark, 4).readStream.schema(df.schema).parquet(folder("in"))
    jobs.run_hourly_merchant(source, folder("out"), folder("ck"), jobs.ALL_AVAILABLE).awaitTermination()
    got = sorted((r.hour.hour, r.n, r.total) for r in spark.read.parquet(folder("out")).collect())
    assert got == [(1, 2, 2.5), (2, 1, 1.25)]


def test_alert_messages(spark):
    columns = "event_id STRING, user_id INT, timestamp TIMESTAMP, action STRING, ip_address STRING, dt DATE, is_suspicious INT"
    rows = spark.createDataFrame([("e1", 1, None, "login", "1.1.1.1", None, 1), ("e2", 1, None, "login", None, None, 0)], columns)
    out = jobs.alert_messages(rows)
    assert out.dtypes == [("key", "string"), ("value", "string")]
    assert [r.key for r in out.collect()] == ["e1"] and '"action":"login"' in out.first().value


def test_consumers_of_silver_see_each_row_once(spark, folder):
    """Upserts and compaction replace the table's files; the change log only grows."""
    bronze, path, log = folder("bronze"), folder("silver"), folder("log")
    seen = folder("seen")
    for n in (1, 2):
        T.append(log_rows(spark, *[(f"e{n}{i}", f"2024-01-0{n} 10:00:00", "m") for i in range(3)], ("e10", "2024-01-01 10:00:00", "again")), bronze, None)
        source = table_appends(S.streaming_session(spark, 4), SYSTEM_LOGS.bronze, bronze)
        jobs.run_silver(source, SYSTEM_LOGS, path, folder("ck"), jobs.ALL_AVAILABLE, log_path=log).awaitTermination()
        T.compact(spark, path)
        T.upsert(spark.read.schema(SYSTEM_LOGS.silver).parquet(path).limit(2), path, SYSTEM_LOGS.keys)
        changes = change_log(S.streaming_session(spark, 4), SYSTEM_LOGS.silver, log)
        jobs.to_files(changes, seen, folder("ck2"), jobs.ALL_AVAILABLE, None).awaitTermination()
    assert sorted(r.log_id for r in spark.read.parquet(seen).collect()) == ["e10", "e11", "e12", "e20", "e21", "e22"]
