"""Profiles, drift and change feeds on small tables."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import profile, tables
from ledgerline.operators.changefeed import applied, change_feed

SCHEMA = "id STRING, v INT, dt DATE"
KEYS = ["id", "dt"]
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


# --- profiles ---


def readings(spark, days, rows=400, shift=0.0, seed=1):
    r = random.Random(seed)
    given = [
        (d, r.gauss(100, 10) + shift if r.random() > 0.1 else None, r.choice("abcdefgh"), float("nan") if r.random() < 0.02 else 1.0)
        for d in days for _ in range(rows)
    ]
    return spark.createDataFrame(given, "dt DATE, x DOUBLE, s STRING, z DOUBLE")


def test_merged_profiles_are_those_of_one_pass(spark):
    rows = readings(spark, [D1, D2, D3])
    whole = {r.column_name: r for r in profile.merged_profile(profile.daily_profiles(rows.withColumn("dt", F.lit(D1)), ["x", "s", "z"])).collect()}
    merged = {r.column_name: r for r in profile.merged_profile(profile.daily_profiles(rows, ["x", "s", "z"])).collect()}
    for name, w in whole.items():
        m = merged[name]
        assert (m.n, m.nulls, m.low, m.high) == (w.n, w.nulls, w.low, w.high) and m.n == 1200
    x = sorted(r.x for r in rows.filter("x IS NOT NULL").collect())
    for got, q in zip(merged["x"].quantiles, profile.QUANTILES):
        assert sum(v < got for v in x) <= (q + 0.025) * len(x) and sum(v <= got for v in x) >= (q - 0.025) * len(x)
    assert merged["s"].distinct == 8 and merged["s"].quantiles is None and merged["s"].low is None
    assert abs(merged["x"].distinct - len(set(x))) <= 0.05 * len(x)
    assert merged["z"].high == 1.0 and merged["z"].quantiles[-1] == 1.0


def test_no_day_is_read_twice(spark, folder):
    table, profiles = folder("t"), folder("p")
    tables.append(readings(spark, [D1, D2]), table)
    assert profile.profile_new_days(spark, table, profiles, ["x"]) == [str(D1), str(D2)]
    assert profile.profile_new_days(spark, table, profiles, ["x"]) == []
    before = {r.dt: bytes(r.quantile_sketch) for r in spark.read.parquet(profiles).collect()}
    tables.append(readings(spark, [D3]), table)
    shutil.rmtree(f"{table}/dt={D1}")  # its profile is all that is needed
    assert profile.profile_new_days(spark, table, profiles, ["x"]) == [str(D3)]
    after = {r.dt: bytes(r.quantile_sketch) for r in spark.read.parquet(profiles).collect()}
    assert len(after) == 3 and all(after[d] == before[d] for d in before)
    tables.append(readings(spark, [D2], 10), table)
    assert profile.profile_new_days(spark, table, profiles, ["x"], again=[D2]) == [str(D2)]
    assert {str(r.dt): r.n for r in spark.read.parquet(profiles).collect()} == {str(D1): 400, str(D2): 410, str(D3): 400}


def test_only_days_without_a_profile_are_scanned(spark, folder):
    table = folder("t")
    tables.append(readings(spark, [D1, D2]), table)
    days = tables.read_merged(spark, table).filter(F.col("dt").isin([D2]))
    plan = profile.daily_profiles(days, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<x:double>" in plan


def test_gate(spark, folder):
    table, profiles = folder("t"), folder("p")
    gate = profile.Gate(profiles, ["x", "s"], days=28)
    gate.check(readings(spark, [D1]), D1)  # nothing to compare with
    tables.append(readings(spark, [D1, D2]), table)
    profile.profile_new_days(spark, table, profiles, ["x", "s"])
    gate.check(readings(spark, [D3], seed=7), D3)
    with pytest.raises(profile.Drifted) as failure:
        gate.check(readings(spark, [D3], shift=20.0), D3)
    assert {(c, r) for c, r, _, _ in failure.value.reasons} >= {("x", "q0.5"), ("x", "q0.25")}
    with pytest.raises(profile.Drifted) as failure:
        gate.check(readings(spark, [D3]).withColumn("s", F.lit(None).cast("string")), D3)
    assert {(c, r) for c, r, _, _ in failure.value.reasons} == {("s", "missing"), ("s", "nulls"), ("s", "distinct")}
    with pytest.raises(profile.Drifted) as failure:
        gate.check(readings(spark, [D3]).withColumn("s", F.uuid()), D3)
    assert {(c, r) for c, r, _, _ in failure.value.reasons} == {("s", "distinct")}
    gate.check(readings(spark, [D3], shift=20.0), dt.date(2024, 3, 1))  # the days before are too long ago


# --- change feed ---


def log(spark, *batches):
    rows = [(*r, b) for b, batch in enumerate(batches, 1) for r in batch]
    return spark.createDataFrame(rows, "id STRING, v INT, dt DATE, gone BOOLEAN, batch_id INT")


def feed(spark, rows, first, last):
    out = change_feed(rows, KEYS, first, last, F.col("gone"))
    return sorted(((r.change, r.id, r.v) for r in out.collect()), key=str)


def test_change_feed(spark):
    rows = log(
        spark,
        [("a", 1, D1, False), ("b", 1, D1, False), ("c", 1, D1, False), ("e", 1, D1, False), (None, 1, D1, False)],
        [("a", 2, D1, False), ("b", 1, D1, None), ("c", 0, D1, True), ("d", 2, D2, False), ("a", 2, D2, False), (None, 2, D1, False)],
        [("a", 1, D1, False), ("c", 3, D1, False), ("d", 0, D2, True), ("x", 0, D1, True), ("e", 5, D1, False), ("e", 4, D1, False)],
    )
    assert feed(spark, rows, 1, 2) == sorted(
        [("update_before", "a", 1), ("update_after", "a", 2), ("update_before", "b", 1), ("update_after", "b", 1),
         ("delete", "c", 1), ("insert", "d", 2), ("insert", "a", 2), ("insert", None, 2)], key=str
    )
    assert feed(spark, rows, 2, 3) == sorted(
        [("update_before", "a", 2), ("update_after", "a", 1), ("insert", "c", 3), ("delete", "d", 2),
         ("update_before", "e", 1), ("update_after", "e", 5)], key=str
    )
    assert ("update_after", "a", 1) not in feed(spark, rows, 1, 3)  # changed and changed back
    assert feed(spark, rows, 3, 3) == [] and len(feed(spark, rows, 0, 1)) == 5
    assert feed(spark, rows.limit(0), 0, 3) == []


def test_a_feed_leads_from_state_to_state(spark):
    r = random.Random(2)
    batches = [[(r.choice("abcdefgh"), r.randint(0, 2), r.choice([D1, D2, None]), r.random() < 0.2) for _ in range(10)] for _ in range(5)]
    batches = [list({(i, d): (i, v, d, g) for i, v, d, g in b}.values()) for b in batches]
    rows = log(spark, *batches)

    def state(until):
        held, loose = {}, []
        for batch in batches[:until]:
            for i, v, d, g in batch:
                if d is None:
                    loose += [] if g else [(i, v, d, g)]
                elif g:
                    held.pop((i, d), None)
                else:
                    held[i, d] = (i, v, d, g)
        return sorted([*held.values(), *loose], key=str)

    for first, last in ((0, 2), (1, 3), (2, 5), (0, 5)):
        before = spark.createDataFrame(state(first), "id STRING, v INT, dt DATE, gone BOOLEAN")
        after = applied(before, change_feed(rows, KEYS, first, last, F.col("gone")), KEYS)
        assert sorted(map(tuple, after.collect()), key=str) == state(last)


def test_one_shuffle_and_no_join(spark):
    plan = change_feed(log(spark, [("a", 1, D1, False)]), KEYS, 0, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.split("Final Plan")[-1].count("Exchange hashpartitioning") == 1
