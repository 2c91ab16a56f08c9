"""What the listener records: counts, lateness, dropped rows, failures; and that a batch held twice is counted once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import tables as T
from ledgerline.schemas import AUTH_LOGS
from ledgerline.session import streaming_session
from ledgerline.sources import files
from ledgerline.streaming import jobs
from ledgerline.streaming.progress import batches, recording

DAY = dt.date(2024, 1, 1)


def bronze(spark, path, *rows):
    """(event_id, user, hour) into the bronze folder; an hour of None is an unreadable time."""
    rows = [(e, u, dt.datetime(2024, 1, 1, h) if h is not None else None, DAY if h is not None else None) for e, u, h in rows]
    names = {"event_id": "string", "user_id": "int", "timestamp": "timestamp", "dt": "date"}
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in names.items()))
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in AUTH_LOGS.bronze.fields if f.name not in names]
    frame = frame.select(*[F.col(n).cast(AUTH_LOGS.bronze[n].dataType) for n in names], *rest)
    frame.select(*AUTH_LOGS.bronze.names).write.mode("append").parquet(path)


def silver(spark, folder, **options):
    session = streaming_session(spark, 2)
    with recording(session, folder("record")):
        stream = session.readStream.schema(AUTH_LOGS.bronze).parquet(folder("bronze"))
        jobs.drained(jobs.run_silver, stream, AUTH_LOGS, folder("silver"), folder("cp"), measure=True, **options)


def written(spark, folder):
    return [
        (r.batch_id, r.rows, r.late_by, r.dropped)
        for r in batches(spark, folder("record")).filter("error IS NULL AND (rows > 0 OR input_rows > 0)").orderBy("batch_id").collect()
    ]


@pytest.mark.parametrize("options", [{}, {"buckets": 2}, {"log_path": "log"}, {"log_path": "log", "undated_path": "undated"}])
def test_counts_lateness_and_dropped_rows(spark, folder, options):
    options = {k: folder(v) if isinstance(v, str) else v for k, v in options.items()}
    bronze(spark, folder("bronze"), ("a", 1, 3), ("b", 1, 5), ("b", 1, 5), ("n", 1, None))
    silver(spark, folder, watermark="2 hours", **options)
    bronze(spark, folder("bronze"), ("c", 1, 4), ("late", 1, 1), ("d", 1, 9))
    silver(spark, folder, watermark="2 hours", **options)
    bronze(spark, folder("bronze"), ("n2", 1, None))
    silver(spark, folder, watermark="2 hours", **options)
    got = written(spark, folder)
    assert [(n, late, dropped) for _, n, late, dropped in got] == [(3, 0.0, 0), (2, 3600.0, 1), (1, None, 0)]
    assert len({number for number, *_ in got}) == 3


def test_a_failed_batch_shows_and_comes_again(spark, folder):
    bronze(spark, folder("bronze"), ("a", 1, 3))
    silver(spark, folder)
    bronze(spark, folder("bronze"), ("b", 1, 4))
    held = folder("silver")
    with pytest.raises(Exception, match="nosuch"):
        silver(spark, lambda name: "nosuch://x" if name == "silver" else folder(name))
    silver(spark, folder)
    rows = batches(spark, folder("record")).filter("rows > 0 OR error IS NOT NULL").collect()
    failed = [r for r in rows if r.error]
    assert len(failed) == 1 and "nosuch" in failed[0].error and failed[0].rows is None
    assert failed[0].batch_id == max(r.batch_id for r in rows)
    assert sorted(r.rows for r in rows if not r.error) == [1, 1]
    assert spark.read.parquet(held).count() == 2


def test_a_job_that_does_not_measure_is_listed_without_rows(spark, folder):
    bronze(spark, folder("bronze"), ("a", 1, 3))
    session = streaming_session(spark, 2)
    with recording(session, folder("record")):
        stream = session.readStream.schema(AUTH_LOGS.bronze).parquet(folder("bronze"))
        jobs.to_files(stream, folder("out"), folder("cp"), jobs.ALL_AVAILABLE, None).awaitTermination()
    assert [(r.input_rows, r.rows, r.late_by) for r in batches(spark, folder("record")).collect()] == [(1, None, None)]


def test_rows_without_an_event_time_are_counted(spark, folder):
    spark.range(5).write.parquet(folder("in"))
    session = streaming_session(spark, 2)
    with recording(session, folder("record")):
        stream = session.readStream.schema("id long").parquet(folder("in"))
        jobs.to_files(stream, folder("out"), folder("cp"), jobs.ALL_AVAILABLE, None, measure=True).awaitTermination()
    assert [(r.rows, r.oldest) for r in batches(spark, folder("record")).collect()] == [(5, None)]


def test_a_small_file_is_written_once(spark, folder):
    files.put_text(spark, folder("a.json"), "x")
    files.put_text(spark, folder("a.json"), "y")
    assert [r.value for r in spark.read.text(folder("a.json")).collect()] == ["x"]


def test_an_upsert_leaves_a_held_batch_held(spark, folder):
    batch = spark.createDataFrame([("a", DAY)], "id string, dt date").persist()
    T.upsert(batch, folder("t"), ["id", "dt"])
    assert batch.storageLevel.useMemory
    batch.unpersist()
