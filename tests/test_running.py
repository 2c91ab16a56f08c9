"""Sessions, running totals and the join of two streams: late rows, restarts, repeated micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.tables import append_change, read_merged
from ledgerline.plans import QUERIES, fixtures
from ledgerline.schemas import AUTH_LOGS, TRANSACTIONS
from ledgerline.session import CLEANED, streaming_session
from ledgerline.sources.streams import change_log
from ledgerline.streaming import followups, jobs, running
from tests.conftest import SF_DIR
from tests.oracle import compare, duck

NOON = dt.datetime(2024, 1, 1, 12)


def at(minutes):
    return NOON + dt.timedelta(minutes=minutes) if minutes is not None else None


def wide(spark, stream, rows, names):
    """Silver rows of some columns, NULL in the others."""
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {stream.silver[n].dataType.simpleString()}" for n in names))
    missing = [f for f in stream.silver.fields if f.name not in names]
    return frame.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]).select(*stream.silver.names)


def logins(spark, rows):
    """(event_id, user, minute, suspicious, device)"""
    rows = [(e, u, at(m), "login", d, 0 if s else 1, s) for e, u, m, s, d in rows]
    names = ["event_id", "user_id", "timestamp", "action", "device_id", "is_success", "is_suspicious"]
    return wide(spark, AUTH_LOGS, rows, names)


def payments(spark, rows):
    """(transaction_id, customer, minute, amount)"""
    rows = [(t, c, at(m), a, "M") for t, c, m, a in rows]
    return wide(spark, TRANSACTIONS, rows, ["transaction_id", "customer_id", "timestamp", "amount", "merchant"])


def drained(spark, job, streams, steps, logs, path, checkpoint, first=0, **options):
    """Runs the job after each step on one checkpoint; a step is one batch for each stream."""
    for number, batches in enumerate(steps, first):
        for stream, log, batch in zip(streams, logs, batches):
            append_change(batch, log, number, "t")
        session = streaming_session(spark, 2)
        sources = [change_log(session, s.silver, log) for s, log in zip(streams, logs)]
        jobs.drained(job, *sources, path, checkpoint=checkpoint, **options)


def test_sessions_over_restarts(spark, folder):
    steps = [
        [("a", 1, 0, 0, "d"), ("b", 1, 10, 1, "e"), ("c", None, 5, 0, "d"), ("n", 1, None, 0, "d"), ("x", 2, 0, 0, None)],
        [("d", 1, 25, 0, "d"), ("e", 2, 200, 0, "d")],  # joins user 1's open session; user 2's first one closes
        [("f", 1, 20, 1, "late"), ("g", 9, 900, 0, "d")],  # behind the watermark: left out
    ]
    steps = [[logins(spark, s)] for s in steps]
    drained(spark, running.run_user_sessions, [AUTH_LOGS], steps, [folder("log")], folder("out"), folder("cp"), gap="30 minutes")
    got = sorted(spark.read.schema(running.SESSIONS).parquet(folder("out")).collect())
    assert [tuple(r) for r in got] == [
        (1, at(0), at(25), 3, 3, 1, 2),
        (2, at(0), at(0), 1, 1, 0, 0),
        (2, at(200), at(200), 1, 1, 0, 1),
    ]


def test_sessions_merge_before_the_shuffle(spark, folder):
    logins(spark, [("a", 1, 0, 0, "d")]).write.parquet(folder("rows"))
    session = streaming_session(spark, 2)
    stream = session.readStream.schema(AUTH_LOGS.silver).parquet(folder("rows"))
    query = jobs.to_files(running.user_sessions(stream, "30 minutes"), folder("out"), folder("cp"), jobs.ALL_AVAILABLE, None)
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    below = plan[plan.rindex("Exchange") :] if "Exchange" in plan else ""
    assert "MergingSessions" in below


def test_sessions_of_nothing(spark):
    assert running.user_sessions(logins(spark, []), "30 minutes").collect() == []


def hours(spark, path):
    return {(r.hour, r.merchant): (r.n, r.total) for r in read_merged(spark, path).collect()}


@pytest.mark.parametrize("buckets", [1, 3])
def test_late_payments_revise_an_hour(spark, folder, buckets):
    streams, logs = [TRANSACTIONS], [folder("log")]
    table, revised = folder("hours"), folder("revisions")
    common = {"log_path": revised, "watermark": "2 hours", "buckets": buckets}

    def run(rows, number):
        batch = [[payments(spark, rows)]]
        drained(spark, running.run_hour_totals, streams, batch, logs, table, folder("cp"), number, **common)

    run([("a", 1, 0, 1.1), ("b", 1, 30, 2.2), ("c", 1, 60, 4.0), ("n", 1, None, 9.0)], 0)
    assert hours(spark, table) == {(at(0), "M"): (2, 3.3), (at(60), "M"): (1, 4.0)}
    run([("d", 1, 40, 0.1), ("e", 1, 300, 5.0)], 1)
    assert hours(spark, table)[(at(0), "M")] == (3, 3.4)
    # The watermark is at 180 now: hour 0 is closed.
    run([("f", 1, 50, 7.0), ("g", 1, 240, 1.0)], 2)
    assert hours(spark, table) == {
        (at(0), "M"): (3, 3.4),
        (at(60), "M"): (1, 4.0),
        (at(240), "M"): (1, 1.0),
        (at(300), "M"): (1, 5.0),
    }
    hours_before = hours(spark, table)
    counts = {r.hour: r.revisions for r in running.revisions(spark, revised).collect()}
    assert counts == {at(0): 2, at(60): 1, at(240): 1, at(300): 1}
    # Once more under a new checkpoint: whole totals by key, so nothing doubles; the closed hour takes its late row.
    drained(spark, running.run_hour_totals, streams, [[payments(spark, [])]], logs, table, folder("cp2"), 3, **common)
    again = hours(spark, table)
    assert again == {**hours_before, (at(0), "M"): (4, 10.4)}


def test_payments_follow_logins(spark, folder):
    streams, logs = [AUTH_LOGS, TRANSACTIONS], [folder("l"), folder("p")]
    steps = [
        # p1 lies on the login itself, p2 on the end of its range, p3 behind; the first payment comes before its login.
        (
            [("a", 1, 0, 1, "d"), ("b", 2, 0, 1, "d"), ("ok", 1, 1, 0, "d"), ("n", None, 0, 1, "d"), ("m", 3, None, 1, "d")],
            [("p1", 1, 0, 1.0), ("p0", 4, 41, 6.0), ("pn", None, 1, 1.0), ("pt", 1, None, 1.0)],
        ),
        ([("c", 4, 40, 1, "d")], [("p2", 1, 30, 2.0), ("p3", 1, 31, 4.0)]),
        ([("z", 9, 500, 1, "d")], [("pz", 8, 500, 1.0)]),
    ]
    steps = [(logins(spark, a), payments(spark, p)) for a, p in steps]
    drained(spark, followups.run_login_payments, streams, steps, logs, folder("out"), folder("cp"), minutes=30)
    got = {(r.event_id, r.transaction_id) for r in spark.read.schema(followups.PAIRS).parquet(folder("out")).collect()}
    assert got == {("a", "p1"), ("a", "p2"), ("b", None), ("c", "p0")}
    batch = [spark.read.schema(s.silver).parquet(log) for s, log in zip(streams, logs)]
    whole = {(r.event_id, r.transaction_id) for r in followups.login_payments(*batch, minutes=30).collect()}
    assert whole == got | {("z", None)}


@pytest.mark.parametrize("salts", [1, 4])
def test_followed_logins_once_each(spark, folder, salts):
    streams, logs = [AUTH_LOGS, TRANSACTIONS], [folder("l"), folder("p")]
    many = [(f"p{i}", 1, i / 100, 0.1) for i in range(1000)]
    steps = [
        ([("a", 1, 0, 1, "d"), ("b", 2, 0, 1, "d")], many[:500]),
        ([("c", 1, 5, 1, "d")], many[500:]),
        ([("z", 9, 500, 1, "d")], [("pz", 8, 500, 1.0)]),
    ]
    steps = [(logins(spark, a), payments(spark, p)) for a, p in steps]
    job, options = followups.run_followed_logins, {"minutes": 30, "salts": salts}
    drained(spark, job, streams, steps, logs, folder("out"), folder("cp"), **options)
    rows = spark.read.schema(followups.FOLLOWED).parquet(folder("out")).collect()
    assert sorted((r.event_id, r.payments, r.total) for r in rows) == [("a", 1000, 100.0), ("b", 0, None), ("c", 500, 50.0)]
    batch = [spark.read.schema(s.silver).parquet(log) for s, log in zip(streams, logs)]
    whole = followups.followed_logins(*batch, **options).collect()
    assert {r.event_id: r.payments for r in whole} == {"a": 1000, "b": 0, "c": 500, "z": 0}


def test_no_salts_is_an_error(spark):
    with pytest.raises(ValueError):
        followups.followed_logins(logins(spark, []), payments(spark, []), 30, salts=0)


def test_slices_hold_all_rows_in_order_and_little_at_once(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "SLICE_ROWS", 40)
    monkeypatch.setattr(fixtures, "STATE_ROWS", 10)
    rows = payments(spark, [(f"T{i}", 1, 7 * i, 1.0) for i in range(500)] + [("T-", 1, None, 1.0)])
    others = logins(spark, [(f"E{i}", 1, 60 * i, 1, "d") for i in range(50)])
    step = F.coalesce((F.col("timestamp") >= F.lit(at(1500))).cast("int"), F.lit(0))
    before = spark.conf.get(CLEANED)
    partitions, batches = fixtures.in_slices(spark, {"p": rows, "a": others}, step, 4, 4)
    assert spark.conf.get(CLEANED) == before
    # 59 hours of about ten rows: three or four slices in the state, however many there are; 55 for all rows.
    assert 4 <= partitions <= 16
    held, newest = {"p": [], "a": []}, None
    for number, batch in batches:
        got = {name: df.collect() for name, df in batch.items()}
        assert number < 5 or sum(map(len, got.values())) <= 40
        times = [r.timestamp for part in got.values() for r in part if r.timestamp]
        assert newest is None or min(times) > newest
        newest = max(times)
        for name, part in got.items():
            held[name] += part
    assert number > 10 and sorted(map(str, held["p"])) == sorted(map(str, rows.collect()))
    assert sorted(map(str, held["a"])) == sorted(map(str, others.collect()))


def test_slices_of_an_empty_table(spark):
    _, batches = fixtures.in_slices(spark, {"p": payments(spark, [])}, F.lit(0), 4, 4)
    assert [(n, b["p"].count()) for n, b in batches] == [(0, 0)]


@pytest.mark.parametrize("name, most", [("stream_followed_logins", 800), ("stream_login_payments", 800), ("bi_running_hours", 1200)])
def test_streams_in_slices_agree_with_sql(spark, monkeypatch, name, most):
    monkeypatch.setattr(fixtures, "SLICE_ROWS", most)
    assert compare(spark, duck(SF_DIR), name, QUERIES[name], SF_DIR) is None


def test_a_job_that_spares_disk_drops_what_it_shuffled(spark):
    assert streaming_session(spark).conf.get(CLEANED) == spark.conf.get(CLEANED) == "false"
    assert streaming_session(spark, spare_disk=True).conf.get(CLEANED) == "true"
