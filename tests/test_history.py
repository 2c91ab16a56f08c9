"""Versioned master data and point-in-time training sets on small tables, against plain versions."""

import datetime as dt
import random

import pytest

from ledgerline.operators import known, tables, versions

T0 = dt.datetime(2024, 1, 1)
CHANGES = "k INT, at TIMESTAMP, v STRING, w INT"


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def changes(spark, *rows):
    return spark.createDataFrame([(k, at(h), v, w) for k, h, v, w in rows], CHANGES)


def plain(batches):
    """{key: [(from, to, v, w)]} of batches of (key, hour, v, w)."""
    state = {}
    for batch in batches:
        own = {}
        for k, h, v, w in batch:
            if k is not None and h is not None:
                own[k, h] = max(own.get((k, h), (v, w)), (v, w))
        state.update(own)
    out = {}
    for (k, h), (v, w) in sorted(state.items()):
        out.setdefault(k, []).append([at(h), None, v, w])
    for rows in out.values():
        for a, b in zip(rows, rows[1:]):
            a[1] = b[0]
    return {k: [tuple(r) for r in rows] for k, rows in out.items()}


def held(spark, path):
    out = {}
    for r in sorted(tables.read_merged(spark, path).collect(), key=lambda r: (r.k, r.valid_from)):
        out.setdefault(r.k, []).append((r.valid_from, r.valid_to, r.v, r.w))
    return out


def take(spark, path, batch):
    versions.upsert_versions(changes(spark, *batch), path, "k", "at", ["v", "w"], buckets=4)


def test_versions_do_not_depend_on_arrival(spark, folder):
    r = random.Random(2)
    batches = [[(r.randint(1, 6), r.randint(0, 30), r.choice("abc"), r.randint(0, 2)) for _ in range(12)] for _ in range(4)]
    batches[1] += [(None, 3, "x", 1), (2, None, "x", 1)]
    path = folder("v")
    for i, batch in enumerate(batches):
        take(spark, path, batch)
        assert held(spark, path) == plain(batches[: i + 1])
    take(spark, path, batches[-1])
    assert held(spark, path) == plain(batches)


def test_the_first_changes_are_not_held(spark, folder, monkeypatch):
    """A table without versions has none to close: the changes are read once."""
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *_: pytest.fail("held"))
    take(spark, folder("v"), [(1, 0, "a", 1), (1, 5, "b", 1), (None, 3, "x", 1)])
    assert held(spark, folder("v")) == plain([[(1, 0, "a", 1), (1, 5, "b", 1)]])


def test_other_buckets_are_not_touched_and_a_dead_job_is_finished(spark, folder):
    path = folder("v")
    take(spark, path, [(k, 0, "a", 1) for k in range(40)])
    import glob

    before = set(glob.glob(f"{path}/bucket=*/*.parquet"))
    assert len(before) == 4
    take(spark, path, [(7, 5, "b", 1)])
    after = set(glob.glob(f"{path}/bucket=*/*.parquet"))
    assert len(before & after) == 3 and held(spark, path)[7] == [(at(0), at(5), "a", 1), (at(5), None, "b", 1)]
    take(spark, path, [])
    assert set(glob.glob(f"{path}/bucket=*/*.parquet")) == after


def test_equal_neighbours_are_merged(spark):
    rows = versions.versions_of(changes(spark, (1, 0, "a", 1), (1, 1, "a", 1), (1, 2, "b", 1), (1, 3, None, 1), (1, 4, None, 1), (1, 5, "a", 1)), "k", "at", ["v", "w"])
    got = [(r.valid_from, r.valid_to, r.v) for r in versions.merged(rows, "k", ["v", "w"]).orderBy("valid_from").collect()]
    assert got == [(at(0), at(2), "a"), (at(2), at(3), "b"), (at(3), at(5), None), (at(5), None, "a")]


@pytest.mark.parametrize("hot", [False, True])
def test_each_fact_meets_the_version_of_its_time(spark, hot):
    r = random.Random(3)
    history = [[(r.randint(1, 5), r.randint(0, 200), r.choice("abcd"), r.randint(0, 9)) for _ in range(60)]]
    keys = [1] * 9 + [2, 3, 9, None] if hot else [1, 2, 3, 4, 5, 9, None]
    facts = [(i, r.choice(keys), r.choice([None, *range(-30, 260)])) for i in range(400)]
    # Facts on the very beginning of versions and stretches.
    facts += [(1000 + i, k, h) for i, (k, h, _, _) in enumerate(history[0])] + [(2000 + d, 1, 24 * d) for d in range(9)]
    table = versions.versions_of(changes(spark, *history[0]), "k", "at", ["v", "w"])
    df = spark.createDataFrame([(i, k, at(h), "mine") for i, k, h in facts], "id INT, k INT, t TIMESTAMP, valid_x STRING")
    got = versions.valid_at(df, table, ("k", "k"), "t", ["v", "w"])
    assert got.columns == ["id", "k", "t", "valid_x", "v", "w", "valid_from", "valid_to"]
    want, plain_versions = {}, plain(history)
    for i, k, h in facts:
        rows = [p for p in plain_versions.get(k, []) if h is not None and p[0] <= at(h) and (p[1] is None or at(h) < p[1])]
        want[i] = rows[0] if rows else (None,) * 4
    rows = got.collect()
    assert len(rows) == len(facts)
    assert {r.id: (r.valid_from, r.valid_to, r.v, r.w) for r in rows} == want


def test_a_hot_key_is_joined_by_the_day(spark):
    """What is joined on is key and day, and the carried timeline holds one row a day, not one a fact."""
    facts = spark.range(20_000).selectExpr("id", "1 AS k", "timestamp_seconds(1704067200 + id * 60) AS t")
    table = versions.versions_of(changes(spark, (1, 0, "a", 1), (1, 30, "b", 2)), "k", "at", ["v", "w"])
    joined = versions.valid_at(facts, table, ("k", "k"), "t", ["v"])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_stretch" in plan.split("Join LeftOuter")[1].splitlines()[0]
    assert {tuple(r) for r in joined.groupBy("v").count().collect()} == {("a", 30 * 60), ("b", 20_000 - 30 * 60)}


@pytest.mark.parametrize("salts", [1, 3])
def test_known_before(spark, salts):
    r = random.Random(5)
    age = 48
    fast = [(r.choice([1, 2, 3]), r.randint(0, 300), r.choice("abc"), r.randint(0, 5)) for _ in range(80)]
    slow = [(r.choice([1, 2, 4, None]), r.choice([None, *range(0, 300, 10)]), r.choice("xyz"), 0) for _ in range(30)]
    labels = [(i, r.choice([1, 2, 3, 4, 5, None]), r.choice([None, *range(-10, 320)])) for i in range(300)]
    labels += [(1000 + i, k, h) for i, (k, h, _, _) in enumerate(fast)] + [labels[0]]  # at the very time, and a repeated row
    df = spark.createDataFrame([(i, k, at(h), i % 2) for i, k, h in labels], "id INT, k INT, t TIMESTAMP, v INT")
    sources = {
        "fast": known.Source(changes(spark, *fast), "k", "at", ["v", "w"]),
        "slow": known.Source(changes(spark, *slow), "k", "at", ["v"]),
    }

    def last(rows, k, h, columns):
        seen = [(o, *row) for kk, o, *row in rows if None not in (k, h, o) and kk == k and h - age <= o < h]
        if not seen:
            return (None,) * columns
        return max(seen, key=lambda x: (x[0], x[1], x[2]))[1 : 1 + columns]

    got = known.known_before(df, sources, "k", "t", age * 3600, salts)
    assert got.columns == ["id", "k", "t", "v", "fast_v", "fast_w", "slow_v"]
    want = sorted(((i, k, at(h), i % 2, *last(fast, k, h, 2), *last(slow, k, h, 1)) for i, k, h in labels), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_no_later_value_leaks(spark):
    """Values that come at or after a label, however many, leave what is known of it as it was."""
    labels = spark.createDataFrame([(1, at(100)), (2, at(100))], "k INT, t TIMESTAMP")
    before = [(1, 40, "early", 1), (1, 99, "last", 2)]
    after = [(k, 100 + h, "leak", h) for k in (1, 2) for h in range(0, 60)]
    for rows in (before, before + after):
        source = {"s": known.Source(changes(spark, *rows), "k", "at", ["v", "w"])}
        assert {tuple(r)[:1] + tuple(r)[2:] for r in known.known_before(labels, source, "k", "t").collect()} == {(1, "last", 2), (2, None, None)}


def test_all_sources_cost_one_shuffle(spark):
    rows = changes(spark, (1, 0, "a", 1))
    sources = {n: known.Source(rows, "k", "at", ["v"]) for n in ("a", "b", "c")}
    labels = spark.createDataFrame([(1, at(1))], "k INT, t TIMESTAMP")
    plan = known.known_before(labels, sources, "k", "t")._jdf.queryExecution().sparkPlan().toString()
    planned = known.known_before(labels, sources, "k", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1 and planned.split("Final Plan")[-1].count("Exchange hashpartitioning") == 1
