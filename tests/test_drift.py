"""Drifting payloads: nothing that a message holds is lost, and types widen."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import drift
from ledgerline.operators.parse import parse_topic
from ledgerline.schemas import AUTH_LOGS, SYSTEM_LOGS, TRANSACTIONS


def parsed(spark, payloads, stream=TRANSACTIONS):
    rows = [(stream.topic, bytearray(p.encode())) for p in payloads]
    return drift.parse_open(spark.createDataFrame(rows, "topic STRING, value BINARY"), stream)


def extras(rows):
    return [r[0] for r in rows.select(F.to_json(drift.EXTRA)).collect()]


def test_known_fields_are_read_as_before(spark):
    payloads = [
        '{"transaction_id": "T1", "customer_id": 5, "amount": 2.5, "is_fraud": 1}',
        '{"transaction_id": null, "customer_id": null}',
        "{}",
        "not json",
        '{"transaction_id": "T2"',
    ]
    rows = [("transactions", bytearray(p.encode())) for p in payloads]
    envelope = spark.createDataFrame(rows, "topic STRING, value BINARY")
    got = drift.parse_open(envelope, TRANSACTIONS)
    assert got.drop(drift.EXTRA).collect()[:4] == parse_topic(envelope, TRANSACTIONS).collect()[:4]
    assert extras(got) == [None] * 5


@pytest.mark.parametrize(
    "value, typed, kept",
    [
        ('"7"', 7, None),
        ("7.0", 7, None),
        ("2.5", None, '{"customer_id":2.5}'),
        ("true", None, '{"customer_id":true}'),
        ('"x7"', None, '{"customer_id":"x7"}'),
        ("99999999999", None, '{"customer_id":99999999999}'),
        ('{"id":7}', None, '{"customer_id":{"id":7}}'),
        ("null", None, None),
    ],
)
def test_values_the_schema_cannot_read_stay(spark, value, typed, kept):
    got = parsed(spark, [f'{{"customer_id": {value}}}'])
    assert got.first().customer_id == typed
    assert extras(got) == [kept]


def test_unknown_fields_are_found_with_a_common_type(spark):
    got = parsed(
        spark,
        [
            '{"a": 1, "b": 1, "c": {"d": 1}, "e": true, "f": null, "Amount": 1}',
            '{"a": 2, "b": 2.5, "c": [1], "e": null}',
            '{"a": 3, "b": 1e300}',
            '{"a": "x"}',
        ],
    )
    found = {r.field: (r.n, r.nulls, r.column_type) for r in drift.found_fields(got).collect()}
    assert found == {
        "a": (4, 0, "STRING"),
        "b": (3, 0, "DOUBLE"),
        "c": (2, 0, "STRING"),
        "e": (2, 1, "BOOLEAN"),
        "f": (1, 1, None),
        "Amount": (1, 0, "BIGINT"),
    }
    assert drift.promotions(got, 0.5) == {"a": "STRING", "b": "DOUBLE", "c": "STRING", "e": "BOOLEAN"}
    with pytest.raises(ValueError):
        drift.promotions(got, 0)


def test_promoted_columns_take_what_they_can_and_leave_the_rest(spark):
    got = parsed(spark, ['{"a": 1, "z": 9}', '{"a": 2.5}', '{"a": {"b": 1}}', '{"a": null}', "{}"])
    whole = drift.promote(got, {"a": "BIGINT"})
    assert [r.a for r in whole.collect()] == [1, None, None, None, None]
    assert extras(whole) == ['{"z":9}', '{"a":2.5}', '{"a":{"b":1}}', None, None]
    # The same column widens with what had been left.
    wide = drift.promote(whole, {"a": drift.wider("BIGINT", "DOUBLE")})
    assert [r.a for r in wide.collect()] == [1.0, 2.5, None, None, None]
    text = drift.promote(got, {"a": drift.wider("BOOLEAN", "DOUBLE")})
    assert [r.a for r in text.collect()] == ["1", "2.5", '{"b":1}', None, None]
    assert extras(text) == ['{"z":9}', None, None, None, None]


def test_a_wire_column_widens(spark):
    got = parsed(spark, ['{"customer_id": 5}', '{"customer_id": "c5"}'])
    wide = drift.promote(got, {"customer_id": "STRING"})
    assert [r.customer_id for r in wide.collect()] == ["5", "c5"]
    assert extras(wide) == [None, None]


def test_clashing_names_are_refused(spark):
    got = parsed(spark, ['{"dt": 1, "AMOUNT": 2, "b": 1, "B": 2}'])
    for columns in ({"dt": "BIGINT"}, {"extra": "STRING"}, {"AMOUNT": "BIGINT"}, {"b": "BIGINT", "B": "BIGINT"}):
        with pytest.raises(ValueError):
            drift.promote(got, columns)
    assert extras(drift.promote(got, {"b": "BIGINT"})) == ['{"dt":1,"AMOUNT":2,"B":2}']
    assert extras(drift.promote(got, {})) == extras(got)


def test_empty_and_long(spark):
    none = parsed(spark, ["{}"]).limit(0)
    assert drift.found_fields(none).count() == 0
    assert drift.promotions(none, 0.1) == {}
    text = "x" * 2_000_000
    got = drift.promote(parsed(spark, [f'{{"log_id": "L", "t": "{text}"}}'], SYSTEM_LOGS), {"t": "STRING"})
    assert got.first().t == text


def test_one_parse_of_each_payload(spark):
    got = drift.promote(parsed(spark, ["{}"]), {"a": "STRING"}).filter("customer_id > 1 AND a IS NOT NULL")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("JsonToStructs") <= 1


def test_no_value_is_read_inside_the_filter_of_the_map(spark):
    """An expression in a lambda is evaluated for each entry of the map, so readings belong before it."""
    envelope = spark.createDataFrame([("auth_logs", b'{"event_id": "a", "risk": 1}')], "topic string, value binary")
    rows = drift.parse_open(envelope, AUTH_LOGS)
    for df in (rows, drift.promote(rows.localCheckpoint(), {"risk": "BIGINT", "user_id": "STRING"})):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        lines = [line for line in plan.splitlines() if "map_filter" in line.lower()]
        assert lines and not any("lambda" in line and "variant_get" in line.lower().split("map_filter", 1)[1] for line in lines)
