"""The three raw streams, derived from the benchmark tables by SQL that Spark and DuckDB both read.

``lineitem`` gives the payments, ``events`` the login and the system events. The derivations hold what the cleaning
rules are about: missing required fields, amounts of zero and less, unreadable times, places and addresses,
values outside the vocabularies.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ledgerline.schemas import AUTH_LOGS, STREAMS, SYSTEM_LOGS, TRANSACTIONS, EventStream
from ledgerline.session import fresh_dir, shuffles_dropped
from ledgerline.sources import files

TX_COLUMNS = {
    "transaction_id": "concat('T', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "customer_id": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey AS INT) END",
    "amount": "l_extendedprice - CAST(20000 AS DOUBLE)",
    "timestamp": "CAST(l_shipdate AS STRING)",
    "merchant": "concat('M', CAST(l_suppkey AS STRING))",
    "geo": (
        "CASE WHEN l_returnflag = 'R' THEN 'bad' ELSE concat(CAST(l_linenumber AS STRING), '.', "
        "CAST(l_suppkey AS STRING), ',-', CAST(l_partkey AS STRING), '.5') END"
    ),
    "is_fraud": "CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 0 END",
}

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

AUTH_COLUMNS = {
    "event_id": "concat('E', CAST(event_id AS STRING))",
    "user_id": "CASE WHEN k = 7 THEN NULL ELSE CAST(user_id AS INT) END",
    "timestamp": "CASE WHEN k = 13 THEN 'not-a-time' ELSE CAST(ts AS STRING) END",
    "action": (
        "CASE event_type WHEN 'click' THEN 'login' WHEN 'view' THEN 'data_access' "
        "WHEN 'signup' THEN 'profile_update' WHEN 'error' THEN 'login' ELSE event_type END"
    ),
    "result": "CASE WHEN event_type = 'error' THEN 'failure' WHEN k = 21 THEN NULL ELSE 'success' END",
    "session_id": "concat('S', CAST(user_id AS STRING), '-', CAST(k AS STRING))",
    "device_id": "concat('D', CAST(user_id AS STRING))",
    "ip_address": (
        "CASE WHEN k > 90 THEN concat('192.168.', CAST(k AS STRING)) "
        "ELSE concat('192.168.', CAST(user_id AS STRING), '.', CAST(k AS STRING)) END"
    ),
    "geo": "concat(CAST(k AS STRING), ',-', CAST(user_id AS STRING))",
}

SYS_COLUMNS = {
    "log_id": "concat('L', CAST(event_id AS STRING))",
    "timestamp": "CAST(ts AS STRING)",
    "service": (
        "CASE WHEN k < 10 THEN 'api' WHEN k < 40 THEN 'payment' WHEN k < 70 THEN 'search' ELSE 'legacy' END"
    ),
    "component": (
        "CASE WHEN user_id < 50 THEN 'backend' WHEN user_id < 100 THEN 'cache' WHEN user_id < 120 THEN 'mainframe' END"
    ),
    "severity": (
        "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'purchase' THEN 'WARN' "
        "WHEN 'view' THEN 'INFO' ELSE 'DEBUG' END"
    ),
    "message": "CASE WHEN k = 0 THEN NULL ELSE concat('m', CAST(k AS STRING)) END",
}

_SOURCES = {
    TRANSACTIONS.topic: ("lineitem", TX_COLUMNS),
    AUTH_LOGS.topic: ("events", AUTH_COLUMNS),
    SYSTEM_LOGS.topic: ("events", SYS_COLUMNS),
}

# Second copies of some rows, changed in one column: (condition, column, changed value).
COPIES = {
    TRANSACTIONS.topic: ("is_fraud = 1", "amount", "amount + CAST(1 AS DOUBLE)"),
    AUTH_LOGS.topic: ("action = 'login'", "device_id", "device_id || 'x'"),
    SYSTEM_LOGS.topic: ("severity = 'ERROR'", "message", "message || ' again'"),
}

# Corrections that arrive with the second of two batches, in the same form. For payments they concern recent dates, but
# all dates where the batches are ``whole``.
CORRECTIONS = {
    **COPIES,
    TRANSACTIONS.topic: ("is_fraud = 1 AND timestamp >= '2000-07-01'", *COPIES[TRANSACTIONS.topic][1:]),
}

# Rows of the first of two batches; the second holds all others and the corrections.
FIRST_BATCH = {
    TRANSACTIONS.topic: "timestamp < '2001-01-01'",
    AUTH_LOGS.topic: "action IN ('login', 'purchase')",
    SYSTEM_LOGS.topic: "severity IN ('ERROR', 'INFO')",
}

# Payloads a producer got wrong, by the value of ``k``; every other event has a proper payload.
BROKEN_PAYLOADS = {
    3: "concat('not json ', CAST(event_id AS STRING))",
    5: "'{}'",
    9: "concat('[', CAST(event_id AS STRING), ']')",
    11: """concat('{"unknown": ', CAST(event_id AS STRING), '}')""",
    15: "''",
    17: "NULL",
}
# The ones among them from which no field can be read although there is something to read.
UNREADABLE = (3, 5, 9, 11)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_rows(spark: SparkSession, sf_dir: str, stream: EventStream) -> DataFrame:
    df = table(spark, sf_dir, _SOURCES[stream.topic][0])
    return df.selectExpr("*", f"{K} AS k") if "props" in df.columns else df


def raw(spark: SparkSession, sf_dir: str, stream: EventStream) -> DataFrame:
    """Table form of a stream: the wire columns."""
    columns = _SOURCES[stream.topic][1]
    return source_rows(spark, sf_dir, stream).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def steps_of(spark: SparkSession, rows: DataFrame, step: Column) -> Callable[[int], DataFrame]:
    """Rows of each step. They are computed once and written by step, or every step would compute all of them."""
    path = fresh_dir(spark, "steps")
    rows.withColumn("_step", step.cast("int")).write.partitionBy("_step").parquet(path)
    held = StructType([*rows.schema.fields, StructField("_step", IntegerType())])
    return lambda number: spark.read.schema(held).parquet(path).filter(F.col("_step") == number).drop("_step")


#: Rows of state that a task holds, about.
STATE_ROWS = 200_000


def state_partitions(*rows: DataFrame, least: int, per_partition: int = STATE_ROWS) -> int:
    """Partitions of a stream's state for all rows that it will see: a checkpoint keeps its first number for good."""
    return max(least, math.ceil(sum(df.count() for df in rows) / per_partition))


#: Rows of a step that come at once, about.
SLICE_ROWS = 4_000_000


class Slice(NamedTuple):
    """Consecutive hours of one step, counted from 1970, and the rows that they have."""

    step: int
    first: int
    last: int
    rows: int


def slices(counts: Iterable[tuple[int, int, int]], most: int) -> list[Slice]:
    """The hours of each step in order of time, as many together as have ``most`` rows; out of (step, hour, rows)."""
    out: list[Slice] = []
    for step, hour, rows in sorted(counts):
        if out and out[-1].step == step and out[-1].rows + rows <= most:
            out[-1] = Slice(step, out[-1].first, hour, out[-1].rows + rows)
        else:
            out.append(Slice(step, hour, hour, rows))
    return out


def state_rows(cut: list[Slice], hours: int) -> int:
    """Rows that a stream's state holds at most, if a row stays ``hours`` behind the newest one and goes a micro-batch
    later."""
    since = [cut[max(i - 1, 0)].first - hours for i in range(len(cut))]
    return max((sum(s.rows for s in cut[: i + 1] if s.last >= since[i]) for i in range(len(cut))), default=0)


def in_slices(
    spark: SparkSession, sides: Mapping[str, DataFrame], step: Column, hours: int, least: int, time: str = "timestamp"
) -> tuple[int, Iterator[tuple[int, dict[str, DataFrame]]]]:
    """The rows of all sides, step after step, those of a long step in slices of time; and how many partitions a state
    needs that keeps a row ``hours`` long.

    A micro-batch holds its rows in the state until it is done, so a slice bounds the state on disk as in memory, and no
    row is late as long as each slice is read before the next one comes. An hour of a step is never divided; rows without
    a time count as of 1970. Rows are computed once; those of a step go when its last slice has been taken.
    """
    path = fresh_dir(spark, "steps")
    hour = F.coalesce(F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / 3600), F.lit(0)).cast("long")
    for name, rows in sides.items():
        held = rows.withColumns({"_step": step.cast("int"), "_hour": hour})
        with shuffles_dropped(spark):  # sorted, so that the pages of other hours are passed over
            held.sortWithinPartitions("_step", "_hour").write.partitionBy("_step").parquet(f"{path}/{name}")

    def held_rows(name: str) -> DataFrame:
        own = [StructField("_hour", LongType()), StructField("_step", IntegerType())]
        return spark.read.schema(StructType([*sides[name].schema.fields, *own])).parquet(f"{path}/{name}")

    counted = [held_rows(name).groupBy("_step", "_hour").count().collect() for name in sides]
    sums: dict[tuple[int, int], int] = {}
    for row in (row for rows in counted for row in rows):
        sums[row[0], row[1]] = sums.get((row[0], row[1]), 0) + row[2]
    cut = slices(((*key, rows) for key, rows in sums.items()), SLICE_ROWS) or [Slice(0, 0, 0, 0)]

    def batches() -> Iterator[tuple[int, dict[str, DataFrame]]]:
        for number, part in enumerate(cut):
            inside = (F.col("_step") == part.step) & F.col("_hour").between(part.first, part.last)
            yield number, {name: held_rows(name).filter(inside).drop("_step", "_hour") for name in sides}
            if number + 1 == len(cut) or cut[number + 1].step != part.step:
                for name in sides:
                    files.drop_folder(spark, f"{path}/{name}/_step={part.step}")

    return max(least, math.ceil(state_rows(cut, hours) / STATE_ROWS)), batches()


def changed_copies(rows: DataFrame, change: tuple[str, str, str]) -> DataFrame:
    condition, column, value = change
    return rows.filter(condition).withColumn(column, F.expr(value))


def raw_with_copies(spark: SparkSession, sf_dir: str, stream: EventStream) -> DataFrame:
    rows = raw(spark, sf_dir, stream)
    return rows.unionByName(changed_copies(rows, COPIES[stream.topic]))


def _division(stream: EventStream, whole: bool) -> tuple[str, str, tuple[str, str, str]]:
    """Conditions of the first and of the second of two batches, and the corrections. With ``whole`` every row is in
    one of the two, also where the first condition is unknown, and rows of all dates are corrected."""
    first = FIRST_BATCH[stream.topic]
    if whole:
        return first, f"({first}) IS NOT TRUE", COPIES[stream.topic]
    return first, f"NOT ({first})", CORRECTIONS[stream.topic]


def two_batches(
    spark: SparkSession, sf_dir: str, stream: EventStream, whole: bool = False
) -> tuple[DataFrame, DataFrame]:
    rows = raw(spark, sf_dir, stream)
    first, later, corrections = _division(stream, whole)
    return rows.filter(first), rows.filter(later).unionByName(changed_copies(rows, corrections))


def messages(rows: DataFrame, stream: EventStream, text: Column) -> DataFrame:
    """Messages of one topic. ``inline`` keeps what reads them from evaluating ``text`` once per use, as a stored
    message would be written only once."""
    value = F.inline(F.array(F.struct(text.cast("binary").alias("value"))))
    return rows.select(F.lit(stream.topic).alias("topic"), value)


def envelope(rows: DataFrame, stream: EventStream) -> DataFrame:
    """Wire form: one JSON object per message."""
    return messages(rows, stream, F.to_json(F.struct(*[F.col(c) for c in stream.wire.names])))


def all_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [envelope(raw(spark, sf_dir, s), s) for s in STREAMS.values()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def faulty_auth_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The login topic with some payloads broken."""
    stream = AUTH_LOGS
    proper = F.to_json(F.struct(*[F.expr(e).alias(c) for c, e in AUTH_COLUMNS.items()]))
    value = proper
    for k, payload in BROKEN_PAYLOADS.items():
        value = F.when(F.col("k") == k, F.expr(payload)).otherwise(value)
    return messages(source_rows(spark, sf_dir, stream), stream, value)


# --- The same in SQL ----------------------------------------------------------------------------------


def raw_sql(stream: EventStream) -> str:
    source, columns = _SOURCES[stream.topic]
    if source == "events":
        source = f"(SELECT *, {K} AS k FROM events)"
    body = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"SELECT {body} FROM {source}"


def _changed_sql(rows: str, stream: EventStream, change: tuple[str, str, str]) -> str:
    condition, column, value = change
    body = ", ".join(f'{value} AS "{c}"' if c == column else f'"{c}"' for c in stream.wire.names)
    return f"SELECT {body} FROM ({rows}) WHERE {condition}"


def raw_with_copies_sql(stream: EventStream) -> str:
    rows = raw_sql(stream)
    return f"{rows} UNION ALL {_changed_sql(rows, stream, COPIES[stream.topic])}"


def two_batches_sql(stream: EventStream, whole: bool = False) -> tuple[str, str]:
    rows = raw_sql(stream)
    first, later, corrections = _division(stream, whole)
    return (
        f"SELECT * FROM ({rows}) WHERE {first}",
        f"SELECT * FROM ({rows}) WHERE {later} UNION ALL {_changed_sql(rows, stream, corrections)}",
    )
