"""Wire, bronze and silver schemas of the three event streams, and where their tables live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values: they have to equal the upstream contract for results to match ----------------------

ACTIONS = (
    "login",
    "logout",
    "password_change",
    "account_lock",
    "two_factor_auth",
    "session_timeout",
    "permission_change",
    "data_access",
    "profile_update",
)
SERVICES = (
    "api",
    "database",
    "auth",
    "payment",
    "notification",
    "analytics",
    "storage",
    "search",
    "caching",
    "load_balancer",
)
COMPONENTS = ("frontend", "backend", "database", "cache", "message_queue")
# WARNING is not in the upstream mapping and therefore gets the default level.
SEVERITY_LEVELS = {"ERROR": 4, "WARN": 3, "INFO": 2}
SEVERITY_DEFAULT = 1
UNKNOWN = "unknown"

LATITUDE_PATTERN = r"^(-?\d+\.?\d*),"
LONGITUDE_PATTERN = r",(-?\d+\.?\d+)$"
# Silver columns that follow from ``geo``.
PLACE = ("geo_lat", "geo_lon")
IPV4_PATTERN = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"

WATERMARK = "1 hour"
SILVER_TRIGGER = "10 seconds"

# ------------------------------------------------------------------------------------------------------


_TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "INT": IntegerType(),
    "DOUBLE": DoubleType(),
    "TIMESTAMP": TimestampType(),
    "DATE": DateType(),
}


def _ddl(text: str) -> StructType:
    """Nullable columns from ``name TYPE, ...``; unlike ``StructType.fromDDL`` it needs no running session."""
    pairs = (column.split() for column in text.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class EventStream:
    """One topic and the two tables it feeds."""

    topic: str
    key: str
    required: tuple[str, ...]
    wire: StructType
    silver: StructType
    bronze_table: str
    silver_table: str

    @property
    def keys(self) -> list[str]:
        """Identity of a silver row: the same id on two dates is two rows."""
        return [self.key, "dt"]

    @property
    def bronze(self) -> StructType:
        """The wire columns with a typed event time, plus the event date."""
        fields = [
            StructField(f.name, TimestampType() if f.name == "timestamp" else f.dataType) for f in self.wire.fields
        ]
        return StructType(fields + [StructField("dt", DateType())])


TRANSACTIONS = EventStream(
    topic="transactions",
    key="transaction_id",
    required=("transaction_id", "customer_id"),
    wire=_ddl(
        "transaction_id STRING, customer_id INT, amount DOUBLE, timestamp STRING, "
        "merchant STRING, geo STRING, is_fraud INT"
    ),
    silver=_ddl(
        "transaction_id STRING, customer_id INT, amount DOUBLE, timestamp TIMESTAMP, merchant STRING, "
        "geo STRING, geo_lat DOUBLE, geo_lon DOUBLE, is_fraud INT, dt DATE"
    ),
    bronze_table="finance.transactions",
    silver_table="silver_finance.transactions",
)

AUTH_LOGS = EventStream(
    topic="auth_logs",
    key="event_id",
    required=("event_id", "user_id"),
    wire=_ddl(
        "event_id STRING, user_id INT, timestamp STRING, action STRING, result STRING, "
        "session_id STRING, device_id STRING, ip_address STRING, geo STRING"
    ),
    silver=_ddl(
        "event_id STRING, user_id INT, timestamp TIMESTAMP, action STRING, device_id STRING, "
        "session_id STRING, ip_address STRING, geo STRING, geo_lat DOUBLE, geo_lon DOUBLE, "
        "is_success INT, is_suspicious INT, dt DATE"
    ),
    bronze_table="system.auth_logs",
    silver_table="silver_finance.auth_logs",
)

SYSTEM_LOGS = EventStream(
    topic="system_logs",
    key="log_id",
    required=("log_id", "message"),
    wire=_ddl(
        "log_id STRING, timestamp STRING, service STRING, component STRING, severity STRING, message STRING"
    ),
    silver=_ddl(
        "log_id STRING, timestamp TIMESTAMP, service STRING, component STRING, severity STRING, "
        "log_level INT, message STRING, dt DATE"
    ),
    bronze_table="system.system_logs",
    silver_table="silver_finance.system_logs",
)

STREAMS = {s.topic: s for s in (TRANSACTIONS, AUTH_LOGS, SYSTEM_LOGS)}
NAMESPACES = ("finance", "system", "silver_finance", "silver_system")
