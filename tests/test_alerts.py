"""Alert patterns: bursts and jumps as the state machines see them, and the burst stream with restarts."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerline.operators.tables import append_change
from ledgerline.schemas import AUTH_LOGS
from ledgerline.session import streaming_session
from ledgerline.sources.streams import change_log
from ledgerline.streaming import alerts, jobs

NOON = dt.datetime(2024, 1, 1, 12)


class Handle:
    """The state of one key in memory."""

    def __init__(self):
        self.value, self.items, self.timers = None, [], set()

    def getListState(self, name, schema):
        return self

    getValueState = getListState

    def get(self):
        return self.value if self.value is not None else (self.items or None)

    def put(self, items):
        self.items = list(items)

    def update(self, value):
        self.value = value

    def clear(self):
        self.value, self.items = None, []

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Lists(Handle):
    def get(self):
        return iter(self.items)


class Expiry:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


def test_bursts_do_not_depend_on_order_or_batches():
    r = random.Random(1)
    for _ in range(60):
        times = [r.randint(0, 400) * 1000 for _ in range(r.randint(1, 60))]
        want, at_least, gap = [], 3, 9_000
        for t in sorted(times):
            if want and t < want[-1][1] + gap:
                want[-1] = [want[-1][0], t, want[-1][2] + 1]
            else:
                want.append([t, t, 1])
        want = [tuple(w) for w in want if w[2] >= at_least]
        processor, handle = alerts.LoginBursts(at_least, gap), Lists()
        processor.init(handle)
        left, told = list(times), []
        while left:
            n = r.randint(1, len(left))
            batch, left = left[:n], left[n:]
            frame = pd.DataFrame({"timestamp": pd.to_datetime(batch, unit="us")})
            told += list(processor.handleInputRows((1,), iter([frame]), None))
            assert handle.timers == {-(-(b[1] + gap) // 1000) for b in handle.items}
        raised = sum(len(f) for f in told)
        assert raised >= len(want)
        closed = [f for at in sorted(handle.timers) for f in processor.handleExpiredTimer((1,), None, Expiry(at))]
        rows = sorted((t.first.value // 1000, t.last.value // 1000, t.failures) for f in closed for t in f.itertuples())
        assert rows == want and handle.items == []
        once = alerts.LoginBursts(at_least, gap)
        once.init(Lists())
        frame = pd.DataFrame({"timestamp": pd.to_datetime(times, unit="us")})
        assert sum(len(f) for f in once.handleInputRows((1,), iter([frame]), None)) == len(want)


def test_a_jump_is_told_once_and_forgotten():
    processor, handle = alerts.ErrorJumps(2.0, 4, 3_600_000), Handle()
    processor.init(handle)
    errors = [1, 2, 1, 2, 50, 60, 1, 1, 2, 70]
    frame = pd.DataFrame({"hour": pd.date_range("2024-01-01", periods=10, freq="h"), "n": 100, "errors": errors})
    told = []
    for part in (frame.iloc[[2, 0, 1]], frame.iloc[3:5], frame.iloc[5:10]):
        told += [t for f in processor.handleInputRows(("api",), iter([part]), None) for t in f.itertuples(index=False)]
    past = np.array([1, 2, 1, 2]) * 10_000
    assert [t.hour.hour for t in told] == [4, 9] and np.isclose(told[0].z_score, (500_000 - past.mean()) / past.std())
    assert len(handle.timers) == 1 and handle.value[0] == [10_000, 10_000, 20_000, 700_000]
    assert list(processor.handleExpiredTimer(("api",), None, Expiry(0))) == [] and handle.value is None


def failures(spark, *rows):
    """(user, minutes after noon) → silver login events, and some that are no failed logins."""
    given = [(u, NOON + dt.timedelta(minutes=m), "login", 0) for u, m in rows]
    given += [(u, t, "login", 1) for u, t, _, _ in given] + [(u, t, "logout", 0) for u, t, _, _ in given] + [(9, None, "login", 0)]
    df = spark.createDataFrame(given, "user_id int, timestamp timestamp, action string, is_success int")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in AUTH_LOGS.silver.fields])


def test_burst_stream(spark, folder):
    log, out, checkpoint = folder("log"), folder("out"), folder("checkpoint")
    steps = [
        failures(spark, (1, 0), (1, 10), (2, 5)),
        failures(spark, (1, 25), (1, 20), (2, 60), (2, 70), (1, 5)),
        failures(spark, (1, 40), (2, 80), (3, 500), (3, 501), (3, 502)),
        failures(spark, (3, 900)),
    ]
    for number, rows in enumerate(steps):
        append_change(rows, log, number, "t")
        silver = change_log(streaming_session(spark, 2), AUTH_LOGS.silver, log)
        jobs.drained(alerts.run_burst_alerts, silver, out, checkpoint, at_least=3, gap_minutes=30)
    told = [(r.user_id, r.kind, r["first"], r["last"], r.failures) for r in spark.read.schema(alerts.BURSTS).parquet(out).collect()]
    at = lambda m: NOON + dt.timedelta(minutes=m)
    assert sorted(told) == [
        (1, "closed", at(0), at(40), 6),
        (1, "raised", at(0), at(25), 5),
        (2, "closed", at(60), at(80), 3),
        (2, "raised", at(60), at(80), 3),
        (3, "closed", at(500), at(502), 3),
        (3, "raised", at(500), at(502), 3),
    ]
    whole = alerts.login_bursts(spark.read.schema(AUTH_LOGS.silver).parquet(log), 3, "30 minutes")
    assert {(r.user_id, r["first"], r.failures) for r in whole.collect()} == {(t[0], t[2], t[4]) for t in told if t[1] == "closed"}


def test_steps_are_computed_once(spark):
    """Rows that are logged in steps are not computed anew for each step."""
    from ledgerline.plans.alerts import in_steps

    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    days = [dt.datetime(2024, 1, d) for d in (1, 12, 20, 28)] + [None]
    rows = spark.createDataFrame([(t,) for t in days], "timestamp timestamp").mapInPandas(count, "timestamp timestamp")
    logs = []
    in_steps(spark, rows, lambda log, *_: logs.append(spark.read.parquet(log).count()))
    assert logs == [2, 3, 4, 5] and seen.value == len(days)


def test_users_share_the_calls_for_their_state(spark):
    """A stream of very many users asks for their state with their rows, not user by user."""
    silver = spark.readStream.schema(AUTH_LOGS.silver).parquet("/root/testdata/sf0.001/events.parquet")
    plan = alerts.burst_alerts(silver)._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsInPandasWithState" in plan
