"""Alert patterns over streams: bursts of failed logins, jumps of a service's error rate.

Both keep a small state per key in RocksDB and raise an alert once per burst or jump, however many micro-batches it
spans and whether or not the job was restarted in between.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerline import schemas
from ledgerline.streaming.jobs import AS_FAST_AS_POSSIBLE, Trigger, to_files

BURSTS = "user_id INT, kind STRING, first TIMESTAMP, last TIMESTAMP, failures BIGINT"
JUMPS = "service STRING, hour TIMESTAMP, n BIGINT, errors BIGINT, rate_ppm BIGINT, z_score DOUBLE"

# A burst while it is open: microseconds of its first and last failure, failures, whether it was raised.
Burst = tuple[int, int, int, bool]


def failed_logins(auth: DataFrame) -> DataFrame:
    """Works on batch and stream."""
    failed = (F.col("action") == "login") & (F.col("is_success") == 0)
    return auth.filter(failed & F.col("user_id").isNotNull() & F.col("timestamp").isNotNull()).select("user_id", "timestamp")


def login_bursts(auth: DataFrame, at_least: int, gap: str) -> DataFrame:
    """Runs of at least ``at_least`` failed logins of a user, each less than ``gap`` after the one before (batch).

    Spark merges the sessions of a user before the shuffle, so a user with very many failures costs one row a task.
    """
    return (
        failed_logins(auth)
        .groupBy("user_id", F.session_window("timestamp", gap))
        .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.count(F.lit(1)).alias("failures"))
        .filter(F.col("failures") >= at_least)
        .select("user_id", "first", "last", "failures")
    )


def joined_bursts(bursts: list[Burst], gap: int) -> list[Burst]:
    """The bursts in order of time, those less than ``gap`` apart made one."""
    out: list[Burst] = []
    for first, last, n, raised in sorted(bursts):
        if out and first < out[-1][1] + gap:
            a, b, m, told = out.pop()
            first, last, n, raised = a, max(b, last), m + n, told or raised
        out.append((first, last, n, raised))
    return out


def _bursts_of(times: np.ndarray, gap: int) -> list[Burst]:
    times = np.sort(times)
    cuts = np.flatnonzero(np.diff(times) >= gap) + 1
    ends = [*cuts.tolist(), len(times)]
    return [(int(times[a]), int(times[b - 1]), b - a, False) for a, b in zip([0, *cuts.tolist()], ends)]


class LoginBursts(StatefulProcessor):
    """Per user the bursts that may still grow. ``raised`` comes with the micro-batch in which a burst reaches
    ``at_least`` failures, ``closed`` when the watermark has passed its last failure by ``gap``.

    The state is the open bursts only - no event is kept - and a timer per burst removes it. Rows may arrive in any
    order within the watermark. A late row that joins two raised bursts makes them one, which is closed once.
    """

    def __init__(self, at_least: int, gap_us: int):
        self.at_least, self.gap = at_least, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first BIGINT, last BIGINT, n BIGINT, raised BOOLEAN")

    def _rows(self, key, kind: str, bursts: list[Burst]) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "user_id": pd.Series([key[0]] * len(bursts), dtype="int32"),
                "kind": [kind] * len(bursts),
                "first": pd.to_datetime([b[0] for b in bursts], unit="us"),
                "last": pd.to_datetime([b[1] for b in bursts], unit="us"),
                "failures": [b[2] for b in bursts],
            }
        )

    def _keep(self, bursts: list[Burst]) -> None:
        if bursts:
            self.open.put(bursts)
        else:
            self.open.clear()

    def _expiry(self, burst: Burst) -> int:
        return -(-(burst[1] + self.gap) // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bursts: list[Burst] = [tuple(b) for b in self.open.get()]
        before = {self._expiry(b) for b in bursts}
        for frame in rows:
            times = frame["timestamp"].astype("datetime64[us]").astype("int64").to_numpy()
            bursts = joined_bursts(bursts + _bursts_of(times, self.gap), self.gap)
        raised = [b for b in bursts if b[2] >= self.at_least and not b[3]]
        bursts = [(*b[:3], b[3] or b[2] >= self.at_least) for b in bursts]
        self._keep(bursts)
        after = {self._expiry(b) for b in bursts}
        for gone in before - after:
            self.handle.deleteTimer(gone)
        for expiry in after - before:
            self.handle.registerTimer(expiry)
        if raised:
            yield self._rows(key, "raised", raised)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        bursts: list[Burst] = [tuple(b) for b in self.open.get()]
        over = [b for b in bursts if self._expiry(b) <= now]
        self._keep([b for b in bursts if self._expiry(b) > now])
        closed = [b for b in over if b[3]]
        if closed:
            yield self._rows(key, "closed", closed)

    def close(self) -> None:
        pass


# The open bursts of a user, a column each.
_OPEN = "first ARRAY<BIGINT>, last ARRAY<BIGINT>, n ARRAY<BIGINT>, raised ARRAY<BOOLEAN>"


class _Open:
    """The open bursts of one user as the list state and the timers of :class:`LoginBursts`, in memory."""

    def __init__(self, bursts: list[Burst]):
        self.bursts, self.timers = bursts, set()

    def getListState(self, name: str, schema: str) -> _Open:
        return self

    def get(self) -> Iterator[Burst]:
        return iter(self.bursts)

    def put(self, bursts: list[Burst]) -> None:
        self.bursts = bursts

    def clear(self) -> None:
        self.bursts = []

    def registerTimer(self, at: int) -> None:
        self.timers.add(at)

    def deleteTimer(self, at: int) -> None:
        self.timers.discard(at)


@dataclass(frozen=True)
class _Expired:
    at: int

    def getExpiryTimeInMs(self) -> int:
        return self.at


def _with_group_state(rule: LoginBursts, key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One user's turn. The state comes and goes with the rows, many users at a time: asking for it and for timers one
    by one costs several calls between Python and Spark a user and micro-batch, most of the job with many users."""
    held = _Open(list(zip(*state.get)) if state.exists else [])
    rule.init(held)
    if not state.hasTimedOut:
        yield from rule.handleInputRows(key, rows, None)
    now = state.getCurrentWatermarkMs()
    if any(rule._expiry(b) <= now for b in held.bursts):
        yield from rule.handleExpiredTimer(key, None, _Expired(now))
    if not held.bursts:
        if state.exists:
            state.remove()
        return
    state.update(tuple(list(column) for column in zip(*held.bursts)))
    # Spark calls when the watermark is past this time, and a burst is over when the watermark reaches its expiry.
    state.setTimeoutTimestamp(min(rule._expiry(b) for b in held.bursts) - 1)


def burst_alerts(silver_auth: DataFrame, at_least: int = 3, gap_minutes: int = 60, watermark: str = schemas.WATERMARK) -> DataFrame:
    """Stream of ``raised`` and ``closed`` bursts. The watermark is that of the failed logins."""
    failed = failed_logins(silver_auth).withWatermark("timestamp", watermark)
    rule = LoginBursts(at_least, gap_minutes * 60_000_000)

    def run(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from _with_group_state(rule, key, rows, state)

    timeout = GroupStateTimeout.EventTimeTimeout
    return failed.groupBy("user_id").applyInPandasWithState(run, BURSTS, _OPEN, "append", timeout)


class ErrorJumps(StatefulProcessor):
    """Per service the rates of its last ``trailing`` hours, and whether it is in a jump.

    An hour is told if its rate lies at least ``least`` standard deviations above the mean of the hours before, and
    the hour before was not. A timer forgets a service of which nothing is heard for ``ttl_ms`` of event time.
    """

    def __init__(self, least: float, trailing: int, ttl_ms: int):
        self.least, self.trailing, self.ttl = least, trailing, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.past = handle.getValueState("past", "rates ARRAY<BIGINT>, high BOOLEAN, forget BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.past.get()
        rates, high, forget = (list(held[0]), held[1], held[2]) if held is not None else ([], False, None)
        told = []
        hours = pd.concat(list(rows)).sort_values("hour")  # one row an hour: closed windows of the service
        for hour, n, errors in zip(hours["hour"], hours["n"], hours["errors"]):
            rate = int(errors) * 1_000_000 // int(n)
            k, s, ss = len(rates), sum(rates), sum(r * r for r in rates)
            spread = k * ss - s * s
            z = float(rate * k - s) / math.sqrt(spread) if k > 1 and spread > 0 else None
            now = z is not None and z >= self.least
            if now and not high:
                told.append((key[0], hour, int(n), int(errors), rate, z))
            high = now
            rates = [*rates, rate][-self.trailing :]
        if forget is not None:
            self.handle.deleteTimer(forget)
        forget = int(hours["hour"].iloc[-1].timestamp() * 1000) + self.ttl
        self.handle.registerTimer(forget)
        self.past.update((rates, high, forget))
        if told:
            yield pd.DataFrame(told, columns=["service", "hour", "n", "errors", "rate_ppm", "z_score"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.past.clear()
        yield from ()

    def close(self) -> None:
        pass


def jump_alerts(
    silver_system: DataFrame,
    least: float = 3.0,
    trailing: int = 24,
    ttl_days: int = 30,
    watermark: str = schemas.WATERMARK,
) -> DataFrame:
    """Stream of error-rate jumps. Hours are counted by Spark and come out once the watermark has passed their end, so
    what reaches the state of a service, however busy, is one row an hour."""
    hourly = (
        silver_system.filter(F.col("timestamp").isNotNull() & F.col("service").isNotNull())
        .withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", "1 hour"), "service")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("log_level") == 4).alias("errors"))
        .select(F.window_time("window").alias("closed"), F.col("window.start").alias("hour"), "service", "n", "errors")
    )
    processor = ErrorJumps(least, trailing, ttl_days * 86_400_000)
    return hourly.groupBy("service").transformWithStateInPandas(processor, JUMPS, "append", "eventTime")


def run_burst_alerts(
    silver_auth: DataFrame, path: str, checkpoint: str, trigger: Trigger = AS_FAST_AS_POSSIBLE, **rule
) -> StreamingQuery:
    """Burst alerts out of the change log of silver."""
    return to_files(burst_alerts(silver_auth, **rule), path, checkpoint, trigger, None)


def run_jump_alerts(
    silver_system: DataFrame, path: str, checkpoint: str, trigger: Trigger = AS_FAST_AS_POSSIBLE, **rule
) -> StreamingQuery:
    return to_files(jump_alerts(silver_system, **rule), path, checkpoint, trigger, None)
