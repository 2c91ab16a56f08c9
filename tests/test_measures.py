"""Quality, risk and scoring measures against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import enrich as E
from ledgerline.operators import quality, risk, scoring
from ledgerline.schemas import TRANSACTIONS

START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("seconds", [60, 3600, 86400])
def test_trailing_counts(spark, seconds):
    """One user holds half of all events; times collide, fall on stretch borders and may be missing."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        user = 1 if i % 2 else rng.randrange(2, 6)
        when = START + dt.timedelta(seconds=rng.choice([0, 1, 59, 60, 61, 3599, 3600, 86399, 86400, 86401, 172800]))
        when += dt.timedelta(seconds=rng.randrange(3), microseconds=rng.randrange(1_000_000))
        rows.append((i, user, None if i % 50 == 0 else when, rng.randrange(2)))
    df = spark.createDataFrame(rows, "id INT, user INT, timestamp TIMESTAMP_NTZ, hit INT").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    )
    measures = {"n": F.lit(1), "hits": F.col("hit")}
    got = {r.id: (r.n, r.hits) for r in risk.trailing_counts(df, "user", measures, seconds=seconds).collect()}

    def second(when):
        return int((when - START).total_seconds())

    expected = {}
    for i, user, when, _ in rows:
        past = [
            hit
            for _, u, w, hit in rows
            if when is not None and w is not None and u == user and 1 <= second(when) - second(w) <= seconds
        ]
        expected[i] = (len(past), sum(past))
    assert got == expected


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_exact_auc(spark, buckets):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, rng.randrange(40)]), rng.randrange(2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score INT, label INT")
    got = scoring.exact_auc(df, "score", "label", buckets).first()
    positives = [s for s, y in rows if y]
    negatives = [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    assert (got.positives, got.negatives) == (len(positives), len(negatives))
    assert got.auc == wins / (len(positives) * len(negatives))
    assert scoring.may_promote(0.85) and not scoring.may_promote(0.8499) and not scoring.may_promote(None)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "score DOUBLE, label INT")
    assert scoring.exact_auc(df, "score", "label").first().auc is None


def test_error_rate_needs_history(spark):
    rows = [(START + dt.timedelta(hours=h), "api", 4 if i < h else 1) for h in range(4) for i in range(4)]
    df = spark.createDataFrame(rows, "timestamp TIMESTAMP, service STRING, log_level INT")
    got = risk.error_rate_hourly(df).orderBy("hour").collect()
    assert [r.rate_ppm for r in got] == [0, 250_000, 500_000, 750_000]
    assert [r.z_score for r in got][:2] == [None, None]
    assert got[2].z_score == pytest.approx(3.0)


def test_quality_report(spark):
    rows = [("a", 1), ("a", None), ("b", 2)]
    df = spark.createDataFrame(rows, "transaction_id STRING, customer_id INT")
    report = quality.quality_report(df, TRANSACTIONS.wire, ["customer_id"], ["transaction_id"])
    assert report.nulls == {"customer_id": 1} and report.duplicated_keys == 1 and not report.passed
    assert "missing amount" in report.schema
    fine = spark.createDataFrame([("a", 1)], "transaction_id STRING, customer_id INT")
    assert quality.quality_report(fine, fine.schema, ["customer_id"], ["transaction_id"]).passed
    assert quality.schema_differences(fine.withColumn("customer_id", F.lit("x")), fine.schema) == [
        "customer_id: string, not int"
    ]


@pytest.mark.parametrize("salts", [1, 4])
def test_enrich_both_ways(spark, salts):
    """As planned by size, and salted."""
    events = spark.createDataFrame([(f"e{i}", 1 if i % 2 else i) for i in range(40)], "id STRING, user INT")
    master = spark.createDataFrame([(i, f"s{i}") for i in range(0, 20)], "key INT, segment STRING")
    expected = {(f"e{i}", f"s{u}" if u < 20 else None) for i in range(40) for u in [1 if i % 2 else i]}
    for rows in (
        E.enrich_stream(events, master, ("user", "key"), ["segment"], "id", salts=salts),
        E.enrich(events, master, [("user", "key")], ["segment"]),
    ):
        assert {(r.id, r.segment) for r in rows.collect()} == expected and rows.count() == 40


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), float("-inf"), 1e17, None])
def test_odd_amounts(spark, amount):
    """No amount ends a job; what is no number is left out of sums."""
    from ledgerline.functions.columns import exact_sum
    from ledgerline.streaming.jobs import hourly_merchant

    rows = spark.createDataFrame(
        [("a", amount, dt.datetime(2024, 1, 1), "m"), ("b", 2.5, dt.datetime(2024, 1, 1), "m")],
        "id STRING, amount DOUBLE, timestamp TIMESTAMP, merchant STRING",
    )
    want = 1e17 + 2.5 if amount == 1e17 else 2.5
    assert rows.agg(exact_sum(F.col("amount"))).first()[0] == pytest.approx(want)
    assert hourly_merchant(rows).first().total == pytest.approx(want)


def test_scoring_and_auc_with_odd_numbers(spark):
    odd = [float("nan"), float("inf"), None]
    rows = [(f"t{i}", float(i), i % 2) for i in range(60)] + [(f"o{i}", a, 1) for i, a in enumerate(odd[:1] + odd[2:])]
    silver = spark.createDataFrame(rows, "transaction_id STRING, amount DOUBLE, is_fraud INT").withColumns(
        {
            "timestamp": F.lit(dt.datetime(2024, 1, 1)),
            "dt": F.lit(dt.date(2024, 1, 1)),
            "geo_lat": F.lit(1.0),
            "geo_lon": F.lit(1.0),
        }
    )
    model = scoring.train_fraud_model(silver, iterations=1)
    assert scoring.score(model, silver).count() == len(rows)
    scored = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.2, 0), (0.3, 1), (float("nan"), 1), (None, 0)], "s DOUBLE, y INT")
    for per_range in (1, 2, 100):
        got = scoring.exact_auc(scored, "s", "y", per_range).first()
        assert (got.positives, got.negatives, got.auc) == (2, 2, 0.875)
