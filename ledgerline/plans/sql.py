"""SQL forms of the silver rules, for checking the Spark results in another engine."""

from __future__ import annotations

from ledgerline import schemas
from ledgerline.plans import fixtures
from ledgerline.schemas import AUTH_LOGS, SYSTEM_LOGS, TRANSACTIONS, EventStream


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


TS = 'TRY_CAST("timestamp" AS TIMESTAMP)'
LAT = f"TRY_CAST(regexp_extract(geo, '{schemas.LATITUDE_PATTERN}', 1) AS DOUBLE)"
LON = f"TRY_CAST(regexp_extract(geo, '{schemas.LONGITUDE_PATTERN}', 1) AS DOUBLE)"
IP_OK = f"regexp_matches(ip_address, '{schemas.IPV4_PATTERN}')"
FRAUD = "CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END"
ACTION = f"CASE WHEN action IN ({_list(schemas.ACTIONS)}) THEN action ELSE 'unknown' END"
SUCCESS = "CASE WHEN result = 'success' THEN 1 ELSE 0 END"
SUSPICIOUS = f"CASE WHEN contains(result, 'failure') AND {IP_OK} THEN 1 ELSE 0 END"
IP = f"CASE WHEN {IP_OK} THEN ip_address END"
SERVICE = f"CASE WHEN service IN ({_list(schemas.SERVICES)}) THEN service ELSE 'unknown' END"
COMPONENT = f"CASE WHEN component IN ({_list(schemas.COMPONENTS)}) THEN component ELSE 'unknown' END"
LEVEL = "CASE severity WHEN 'ERROR' THEN 4 WHEN 'WARN' THEN 3 WHEN 'INFO' THEN 2 ELSE 1 END"
MONEY = "CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"

_CLEAN = {
    TRANSACTIONS.topic: (
        f'transaction_id, customer_id, amount, {TS} AS "timestamp", merchant, geo, {LAT} AS geo_lat, '
        f"{LON} AS geo_lon, {FRAUD} AS is_fraud, CAST({TS} AS DATE) AS dt",
        "transaction_id IS NOT NULL AND customer_id IS NOT NULL AND amount > 0",
    ),
    AUTH_LOGS.topic: (
        f'event_id, user_id, {TS} AS "timestamp", {ACTION} AS action, device_id, session_id, {IP} AS ip_address, geo, '
        f"{LAT} AS geo_lat, {LON} AS geo_lon, {SUCCESS} AS is_success, {SUSPICIOUS} AS is_suspicious, "
        f"CAST({TS} AS DATE) AS dt",
        "event_id IS NOT NULL AND user_id IS NOT NULL",
    ),
    SYSTEM_LOGS.topic: (
        f'log_id, {TS} AS "timestamp", {SERVICE} AS service, {COMPONENT} AS component, severity, {LEVEL} AS log_level, '
        f"message, CAST({TS} AS DATE) AS dt",
        "log_id IS NOT NULL AND message IS NOT NULL",
    ),
}


def cleaned(rows: str, stream: EventStream) -> str:
    body, condition = _CLEAN[stream.topic]
    return f"SELECT {body} FROM ({rows}) WHERE {condition}"


def one_per_key(rows: str, stream: EventStream) -> str:
    others = ", ".join(f'"{c}" ASC NULLS FIRST' for c in stream.silver.names if c not in stream.keys)
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {stream.key}, dt ORDER BY {others}) AS rn "
        f"FROM ({rows})) WHERE rn = 1"
    )


def silver(stream: EventStream, rows: str | None = None) -> str:
    return one_per_key(cleaned(rows or fixtures.raw_sql(stream), stream), stream)


def upserted(stream: EventStream, whole: bool = False) -> str:
    """Silver after two batches: the later one wins, rows without a date all stay. Carries the batch as ``b``."""
    first, second = (silver(stream, rows) for rows in fixtures.two_batches_sql(stream, whole))
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {stream.key}, dt ORDER BY b DESC) AS rn "
        f"FROM (SELECT *, 1 AS b FROM ({first}) UNION ALL SELECT *, 2 AS b FROM ({second}))) "
        f"WHERE rn = 1 OR dt IS NULL"
    )


def shown(rows: str, columns: str | None = None) -> str:
    """Final form for comparison: the date as text."""
    body = columns or "* REPLACE (CAST(dt AS VARCHAR) AS dt)"
    return f"SELECT {body} FROM ({rows})"
