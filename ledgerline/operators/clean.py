"""Bronze → silver row rules. Row-wise only, so the same function serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ledgerline import schemas
from ledgerline.functions import columns as C
from ledgerline.schemas import AUTH_LOGS, SYSTEM_LOGS, TRANSACTIONS, EventStream


def require(df: DataFrame, stream: EventStream) -> DataFrame:
    """Rows that carry the stream's required fields."""
    return df.dropna(subset=list(stream.required))


def _project(df: DataFrame, stream: EventStream, derived: dict) -> DataFrame:
    """The silver columns in order: a derivation where there is one, else the column as it came."""
    time = F.col("timestamp")
    if not isinstance(df.schema["timestamp"].dataType, TimestampType):
        # Not applied to a typed column, which has to stay the very column the watermark was set on.
        time = C.event_time(time)
    dated = {"timestamp": time, "dt": F.to_date(time), **derived}
    return df.select(*[dated[name].alias(name) if name in dated else F.col(name) for name in stream.silver.names])


def _coordinates() -> dict:
    return {"geo_lat": C.latitude(F.col("geo")), "geo_lon": C.longitude(F.col("geo"))}


def clean_transactions(df: DataFrame) -> DataFrame:
    """Payments with a customer and a positive amount."""
    amount = C.positive(F.col("amount"))
    return _project(
        require(df, TRANSACTIONS).filter(amount.isNotNull()),
        TRANSACTIONS,
        {"amount": amount, "is_fraud": C.flag(F.col("is_fraud") == 1), **_coordinates()},
    )


def clean_auth_logs(df: DataFrame) -> DataFrame:
    """Login events with a user, a known action and a well-formed address or none."""
    result, ip = F.col("result"), F.col("ip_address")
    return _project(
        require(df, AUTH_LOGS),
        AUTH_LOGS,
        {
            "action": C.one_of(F.col("action"), schemas.ACTIONS),
            "ip_address": C.ipv4_or_null(ip),
            "is_success": C.flag(result == "success"),
            "is_suspicious": C.is_suspicious(result, ip),
            **_coordinates(),
        },
    )


def clean_system_logs(df: DataFrame, levels: dict[str, int] = schemas.SEVERITY_LEVELS) -> DataFrame:
    """Service messages with known service and component names and an ordinal level."""
    return _project(
        require(df, SYSTEM_LOGS),
        SYSTEM_LOGS,
        {
            "service": C.one_of(F.col("service"), schemas.SERVICES),
            "component": C.one_of(F.col("component"), schemas.COMPONENTS),
            "log_level": C.severity_level(F.col("severity"), levels),
        },
    )


CLEANERS = {
    TRANSACTIONS.topic: clean_transactions,
    AUTH_LOGS.topic: clean_auth_logs,
    SYSTEM_LOGS.topic: clean_system_logs,
}


def clean(df: DataFrame, stream: EventStream) -> DataFrame:
    return CLEANERS[stream.topic](df)
