"""Row rules on hand-written edge values, with ANSI mode on."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import columns as C
from ledgerline.functions.privacy import hash_pii
from ledgerline.operators.clean import clean_system_logs, clean_transactions
from ledgerline.schemas import AUTH_LOGS, STREAMS, SYSTEM_LOGS, TRANSACTIONS


def values(spark, kind, rows, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize(
    "geo, lat, lon",
    [
        ("1.5,2.5", 1.5, 2.5),
        ("5,5", 5.0, None),
        ("5,55", 5.0, 55.0),
        ("-1.,-2.", -1.0, None),
        ("1.5, 2.5", 1.5, None),
        (".5,.5", None, None),
        ("1e3,4", None, None),
        ("bad", None, None),
        (None, None, None),
    ],
)
def test_coordinates(spark, geo, lat, lon):
    assert values(spark, "STRING", [geo], C.latitude) == [lat]
    assert values(spark, "STRING", [geo], C.longitude) == [lon]


def test_event_time(spark):
    texts = [
        "2024-01-01T10:00:00.123456",
        "2024-01-01 10:00:00",
        "2024-01-01T10:00:00+07:00",
        "2024-01-01",
        "garbage",
        "",
        None,
    ]
    day = dt.datetime(2024, 1, 1)
    assert values(spark, "STRING", texts, lambda c: C.event_time(c).cast("timestamp_ntz")) == [
        dt.datetime(2024, 1, 1, 10, 0, 0, 123456),
        dt.datetime(2024, 1, 1, 10),
        dt.datetime(2024, 1, 1, 3),
        day,
        None,
        None,
        None,
    ]
    assert values(spark, "STRING", texts, C.event_date) == [day.date()] * 4 + [None] * 3


def test_positive_amount(spark):
    got = values(spark, "DOUBLE", [0.0, -1.0, None, float("nan"), 5.0], C.positive)
    assert got[:3] == [None, None, None] and math.isnan(got[3]) and got[4] == 5.0


def test_flags(spark):
    assert values(spark, "INT", [1, 0, 2, None], lambda c: C.flag(c == 1)) == [1, 0, 0, 0]


def test_ipv4(spark):
    addresses = ["192.168.0.1", "999.1.1.1", "1.1.1", "1.2.3.4.5", "", None]
    assert values(spark, "STRING", addresses, C.ipv4_or_null) == ["192.168.0.1", "999.1.1.1"] + [None] * 4


def test_suspicious_needs_a_well_formed_address(spark):
    rows = [("failure", "1.2.3.4"), ("login failure", "1.2.3.4"), ("failure", "1.2.3"), ("failure", None)]
    rows += [("success", "1.2.3.4"), (None, "1.2.3.4")]
    df = spark.createDataFrame(rows, "r STRING, ip STRING")
    got = [r[0] for r in df.select(C.is_suspicious(F.col("r"), F.col("ip"))).collect()]
    assert got == [1, 1, 0, 0, 0, 0]


def test_vocabulary(spark):
    got = values(spark, "STRING", ["login", "LOGIN", "other", None], lambda c: C.one_of(c, schemas.ACTIONS))
    assert got == ["login", "unknown", "unknown", "unknown"]


def test_severity(spark):
    names = ["ERROR", "WARN", "INFO", "WARNING", "DEBUG", None]
    assert values(spark, "STRING", names, C.severity_level) == [4, 3, 2, 1, 1, 1]
    fixed = {**schemas.SEVERITY_LEVELS, "WARNING": 3}
    assert values(spark, "STRING", names, lambda c: C.severity_level(c, fixed)) == [4, 3, 2, 3, 1, 1]


def test_hash_pii_keeps_null_and_hides_the_rest(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id INT, other STRING")
    first, second = hash_pii(df, ["id"], "s").collect()
    assert len(first.id) == 64 and first.other == "a" and second.id is None


def test_silver_schemas(spark):
    from ledgerline.operators.clean import clean

    for stream in STREAMS.values():
        for schema in (stream.wire, stream.bronze):
            got = clean(spark.createDataFrame([], schema), stream).schema
            assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in stream.silver]


def test_transactions_drop_and_keep(spark):
    rows = [
        ("a", 1, 5.0, "2024-01-01", "m", "1.5,2.5", 1),
        (None, 1, 5.0, "2024-01-01", "m", "g", 1),
        ("b", None, 5.0, "2024-01-01", "m", "g", 1),
        ("c", 1, 0.0, "2024-01-01", "m", "g", 1),
        ("d", 1, None, "2024-01-01", "m", "g", 1),
        ("e", 1, 1.0, "never", None, None, None),
    ]
    got = clean_transactions(spark.createDataFrame(rows, TRANSACTIONS.wire)).orderBy("transaction_id").collect()
    assert [r.transaction_id for r in got] == ["a", "e"]
    assert (got[0].geo_lat, got[0].geo_lon, got[0].is_fraud, got[0].dt) == (1.5, 2.5, 1, dt.date(2024, 1, 1))
    assert (got[1].timestamp, got[1].dt, got[1].is_fraud) == (None, None, 0)


def test_system_logs_map_null_vocabulary(spark):
    rows = [("a", "2024-01-01", None, None, None, "m"), ("b", "2024-01-01", "api", "cache", "ERROR", None)]
    (got,) = clean_system_logs(spark.createDataFrame(rows, SYSTEM_LOGS.wire)).collect()
    assert (got.service, got.component, got.severity, got.log_level) == ("unknown", "unknown", None, 1)


def test_keys():
    assert AUTH_LOGS.keys == ["event_id", "dt"]
