"""Message envelope to bronze."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.parse import dead_letters, parse_topic, stamp_date, to_bronze
from ledgerline.schemas import TRANSACTIONS

PAYLOADS = [
    '{"transaction_id": "a", "customer_id": 7, "amount": 1.5, "timestamp": "2024-01-01T00:00:00"}',
    "not json",
    None,
    "",
    "  \t\r\n",
    "{}",
    "[]",
    "null",
    "1",
    '"text"',
    '{"transaction_id": "b", "customer_id": "seven"}',
    '{"unknown": 1}',
    '{"transaction_id": "c"} trailing',
    '{"transaction_id": "d"',
    " ",
]


def envelope(spark, payloads, topic="transactions"):
    rows = [(topic, None if p is None else p.encode()) for p in payloads]
    return spark.createDataFrame(rows, "topic STRING, value BINARY")


def test_text_test_equals_struct_test(spark):
    """Filtering on the text keeps exactly the payloads whose parsed struct is not NULL."""
    for payload in PAYLOADS:
        df = envelope(spark, [payload])
        parsed = df.select(F.from_json(F.col("value").cast("string"), TRANSACTIONS.wire).alias("d"))
        expected = parsed.filter("d IS NOT NULL").select("d.*").collect()
        assert parse_topic(df, TRANSACTIONS).collect() == expected, payload


def test_other_topics_are_left_out(spark):
    both = envelope(spark, PAYLOADS[:1]).unionAll(envelope(spark, PAYLOADS[:1], "auth_logs"))
    assert parse_topic(both, TRANSACTIONS).count() == 1


def test_bad_type_nulls_the_field_only(spark):
    (row,) = parse_topic(envelope(spark, [PAYLOADS[10]]), TRANSACTIONS).collect()
    assert (row.transaction_id, row.customer_id) == ("b", None)


def test_dead_letters(spark):
    got = {r.payload for r in dead_letters(envelope(spark, PAYLOADS), TRANSACTIONS).collect()}
    assert got == {"not json", "{}", "[]", "null", "1", '"text"', '{"unknown": 1}', '{"transaction_id": "d"', " "}


def test_bronze_types(spark):
    df = to_bronze(envelope(spark, PAYLOADS[:1]), TRANSACTIONS)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TRANSACTIONS.bronze]
    assert df.first().dt == dt.date(2024, 1, 1)


def test_stamp_date_only_if_absent(spark):
    day = dt.date(2024, 5, 6)
    assert stamp_date(spark.range(1), day).first().dt == day
    dated = spark.sql("SELECT DATE'2020-01-01' AS dt")
    assert stamp_date(dated, day).first().dt == dt.date(2020, 1, 1)


def test_payload_is_parsed_once(spark):
    from ledgerline.operators.clean import clean_transactions

    df = clean_transactions(to_bronze(envelope(spark, PAYLOADS).repartition(2), TRANSACTIONS))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
