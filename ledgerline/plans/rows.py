"""Parsing, row rules, dedup and silver frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import columns as C
from ledgerline.functions.privacy import hash_pii
from ledgerline.operators import quality
from ledgerline.operators.clean import clean, require
from ledgerline.operators.dedup import one_per_key
from ledgerline.operators.parse import dead_letters, parse_topic, stamp_date, to_bronze, with_event_date
from ledgerline.plans import fixtures, sql
from ledgerline.plans.registry import query
from ledgerline.schemas import AUTH_LOGS, STREAMS, SYSTEM_LOGS, TRANSACTIONS

RUN_DATE = dt.date(2024, 3, 1)
PII_SALT = "pepper-"


def silver_from_messages(spark, sf_dir, stream):
    """JSON messages → wire columns → cleaned → one row per key."""
    messages = fixtures.envelope(fixtures.raw(spark, sf_dir, stream), stream)
    return one_per_key(clean(to_bronze(messages, stream), stream), stream.keys)


def silver_frame(spark, sf_dir, stream):
    """The same rows from the table form of the stream, as later steps find them: parsing is behind them."""
    return one_per_key(clean(fixtures.raw(spark, sf_dir, stream), stream), stream.keys, derived=schemas.PLACE)


def _register_per_stream(stream, short):
    raw = fixtures.raw_sql(stream)

    @query(f"silver_{stream.topic}", sql.shown(sql.silver(stream)))
    def silver(spark, sf_dir):
        return silver_from_messages(spark, sf_dir, stream)

    @query(f"json_parse_{short}", raw)
    def parse(spark, sf_dir):
        return parse_topic(fixtures.envelope(fixtures.raw(spark, sf_dir, stream), stream), stream)

    required = " AND ".join(f"{c} IS NOT NULL" for c in stream.required)

    @query(f"required_{short}", f"SELECT {stream.key} FROM ({raw}) WHERE {required}")
    def required_rows(spark, sf_dir):
        return require(fixtures.raw(spark, sf_dir, stream), stream).select(stream.key)

    @query(f"dedup_{short}", sql.shown(sql.silver(stream, fixtures.raw_with_copies_sql(stream))))
    def dedup(spark, sf_dir):
        rows = clean(fixtures.raw_with_copies(spark, sf_dir, stream), stream)
        return one_per_key(rows, stream.keys)


_register_per_stream(TRANSACTIONS, "transactions")
_register_per_stream(AUTH_LOGS, "auth")
_register_per_stream(SYSTEM_LOGS, "system")


@query(
    "route_by_topic",
    " UNION ALL ".join(
        f"SELECT '{s.topic}' AS topic, count(*) AS n FROM ({fixtures.raw_sql(s)})" for s in STREAMS.values()
    ),
)
def route_by_topic(spark, sf_dir):
    messages = fixtures.all_topics(spark, sf_dir)
    counts = [
        parse_topic(messages, s).agg(F.count(F.lit(1)).alias("n")).select(F.lit(s.topic).alias("topic"), "n")
        for s in STREAMS.values()
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


_BROKEN = " ".join(f"WHEN {k} THEN {fixtures.BROKEN_PAYLOADS[k]}" for k in fixtures.UNREADABLE)


@query(
    "bronze_dead_letter",
    f"SELECT 'auth_logs' AS topic, CASE k {_BROKEN} END AS payload FROM (SELECT *, {fixtures.K} AS k FROM events) "
    f"WHERE k IN ({', '.join(map(str, fixtures.UNREADABLE))})",
)
def bronze_dead_letter(spark, sf_dir):
    return dead_letters(fixtures.faulty_auth_envelope(spark, sf_dir), AUTH_LOGS)


_EMPTY = f"WHEN k IN ({', '.join(map(str, fixtures.UNREADABLE))}) THEN NULL"


@query(
    "bronze_malformed_rows",
    f"SELECT event_id, count(*) AS n FROM (SELECT CASE {_EMPTY} ELSE {fixtures.AUTH_COLUMNS['event_id']} END AS event_id "
    f"FROM (SELECT *, {fixtures.K} AS k FROM events) WHERE k NOT IN (15, 17)) GROUP BY event_id",
)
def bronze_malformed_rows(spark, sf_dir):
    """A malformed message still becomes a bronze row, one of NULLs; only blank and missing payloads do not."""
    rows = parse_topic(fixtures.faulty_auth_envelope(spark, sf_dir), AUTH_LOGS)
    return rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "bronze_event_time",
    f'SELECT event_id, {sql.TS} AS "timestamp", CAST(CAST({sql.TS} AS DATE) AS VARCHAR) AS dt '
    f"FROM ({fixtures.raw_sql(AUTH_LOGS)})",
)
def bronze_event_time(spark, sf_dir):
    return with_event_date(fixtures.raw(spark, sf_dir, AUTH_LOGS)).select("event_id", "timestamp", "dt")


@query("ingest_date_stamp", f"SELECT *, '{RUN_DATE}' AS dt FROM supplier")
def ingest_date_stamp(spark, sf_dir):
    return stamp_date(fixtures.table(spark, sf_dir, "supplier"), RUN_DATE)


@query(
    "geo_parse",
    f"SELECT geo, {sql.LAT} AS geo_lat, {sql.LON} AS geo_lon FROM (SELECT geo FROM ({fixtures.raw_sql(TRANSACTIONS)}) "
    f"UNION ALL SELECT geo FROM ({fixtures.raw_sql(AUTH_LOGS)}))",
)
def geo_parse(spark, sf_dir):
    places = [fixtures.raw(spark, sf_dir, s).select("geo") for s in (TRANSACTIONS, AUTH_LOGS)]
    geo = F.col("geo")
    return places[0].unionAll(places[1]).select(
        "geo", C.latitude(geo).alias("geo_lat"), C.longitude(geo).alias("geo_lon")
    )


def _register_rule(name, stream, derived, derived_sql):
    """One row rule by itself over the whole raw stream."""
    body = ", ".join(f"{e} AS {c}" for c, e in derived_sql.items())

    @query(name, f"SELECT {stream.key}, {body} FROM ({fixtures.raw_sql(stream)})")
    def rule(spark, sf_dir):
        return fixtures.raw(spark, sf_dir, stream).select(
            stream.key, *[expression().alias(c) for c, expression in derived.items()]
        )


_register_rule(
    "amount_positive",
    TRANSACTIONS,
    {"amount_clean": lambda: C.positive(F.col("amount"))},
    {"amount_clean": "CASE WHEN amount > 0 THEN amount END"},
)
_register_rule("fraud_flag", TRANSACTIONS, {"is_fraud": lambda: C.flag(F.col("is_fraud") == 1)}, {"is_fraud": sql.FRAUD})
_register_rule(
    "auth_flags",
    AUTH_LOGS,
    {
        "is_success": lambda: C.flag(F.col("result") == "success"),
        "is_suspicious": lambda: C.is_suspicious(F.col("result"), F.col("ip_address")),
    },
    {"is_success": sql.SUCCESS, "is_suspicious": sql.SUSPICIOUS},
)
_register_rule("ip_validate", AUTH_LOGS, {"ip_address": lambda: C.ipv4_or_null(F.col("ip_address"))}, {"ip_address": sql.IP})
_register_rule(
    "vocab_action", AUTH_LOGS, {"action": lambda: C.one_of(F.col("action"), schemas.ACTIONS)}, {"action": sql.ACTION}
)
_register_rule(
    "vocab_service", SYSTEM_LOGS, {"service": lambda: C.one_of(F.col("service"), schemas.SERVICES)}, {"service": sql.SERVICE}
)
_register_rule(
    "vocab_component",
    SYSTEM_LOGS,
    {"component": lambda: C.one_of(F.col("component"), schemas.COMPONENTS)},
    {"component": sql.COMPONENT},
)
_register_rule(
    "severity_level", SYSTEM_LOGS, {"log_level": lambda: C.severity_level(F.col("severity"))}, {"log_level": sql.LEVEL}
)


@query(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{s.topic}' AS stream, count(*) AS n FROM ({sql.silver(s)})" for s in STREAMS.values()),
)
def row_counts(spark, sf_dir):
    counts = [
        silver_from_messages(spark, sf_dir, s)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(s.topic).alias("stream"), "n")
        for s in STREAMS.values()
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@query(
    "pii_hash",
    f"SELECT event_id, sha256('{PII_SALT}' || CAST(user_id AS VARCHAR)) AS user_id, "
    f"sha256('{PII_SALT}' || device_id) AS device_id FROM ({fixtures.raw_sql(AUTH_LOGS)})",
)
def pii_hash(spark, sf_dir):
    rows = fixtures.raw(spark, sf_dir, AUTH_LOGS).select("event_id", "user_id", "device_id")
    return hash_pii(rows, ["user_id", "device_id"], PII_SALT)


@query(
    "dq_nulls",
    f"WITH r AS ({fixtures.raw_sql(TRANSACTIONS)}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulls, count(*) AS total FROM r"
        for c in TRANSACTIONS.wire.names
    ),
)
def dq_nulls(spark, sf_dir):
    return quality.null_counts(fixtures.raw(spark, sf_dir, TRANSACTIONS))


@query(
    "dq_duplicates",
    f"SELECT transaction_id, CAST({sql.TS} AS DATE)::VARCHAR AS dt, count(*) AS copies "
    f"FROM ({fixtures.raw_with_copies_sql(TRANSACTIONS)}) GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_duplicates(spark, sf_dir):
    rows = with_event_date(fixtures.raw_with_copies(spark, sf_dir, TRANSACTIONS))
    return quality.duplicate_keys(rows, TRANSACTIONS.keys)
