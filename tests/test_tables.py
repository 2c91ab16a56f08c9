"""Appends, upserts and maintenance on small tables."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import layout
from ledgerline.operators import tables as T
from ledgerline.operators.dedup import one_per_key
from ledgerline.plans import QUERIES
from ledgerline.plans import rows as rows_of
from ledgerline.schemas import TRANSACTIONS
from ledgerline.sources.csv import CsvDataset, ingest
from tests.conftest import SF_DIR

SCHEMA = "id STRING, v INT, dt DATE"
KEYS = ["id", "dt"]
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).collect()), key=str)


def data_files(path):
    return set(glob.glob(os.path.join(path, "**", "*.parquet"), recursive=True))


def test_upsert_update_insert_untouched_and_null_dates(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, ("a", 1, D1), ("b", 1, D1), ("c", 1, D2), ("n", 1, None)), path, KEYS)
    untouched = {f for f in data_files(path) if f"dt={D2}" in f}
    result = T.upsert(frame(spark, ("a", 2, D1), ("d", 2, D1), ("e", 2, D3), ("a", 2, D3), ("n", 2, None)), path, KEYS)
    expected = [("a", 2, D1), ("a", 2, D3), ("b", 1, D1), ("c", 1, D2), ("d", 2, D1), ("e", 2, D3)]
    assert content(spark, path) == sorted(expected + [("n", 1, None), ("n", 2, None)], key=str)
    assert result == T.UpsertResult(5, True)
    assert untouched <= data_files(path)


def test_upsert_twice_changes_nothing(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, ("a", 1, D1), ("b", 1, D2)), path, KEYS)
    batch = frame(spark, ("a", 2, D1), ("c", 2, D3))
    T.upsert(batch, path, KEYS)
    once = content(spark, path)
    T.upsert(batch, path, KEYS)
    assert content(spark, path) == once == [("a", 2, D1), ("b", 1, D2), ("c", 2, D3)]


def test_new_keys_are_appended_without_a_rewrite(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, ("a", 1, D1)), path, KEYS)
    before = data_files(path)
    assert T.upsert(frame(spark, ("b", 1, D1)), path, KEYS) == T.UpsertResult(1, False)
    assert before < data_files(path)


def test_empty_batch_is_a_no_op(spark, folder):
    path = folder("t")
    assert T.upsert(frame(spark), path, KEYS) == T.UpsertResult(0, False)
    assert not os.path.exists(path)
    T.upsert(frame(spark, ("a", 1, D1)), path, KEYS)
    before = data_files(path)
    T.upsert(frame(spark), path, KEYS)
    T.insert_new(frame(spark), path, KEYS)
    assert data_files(path) == before


def test_the_first_batch_is_read_once(spark, folder, monkeypatch):
    """A table without rows has nothing to look for: the batch is neither held nor counted first."""
    seen = spark.sparkContext.accumulator(0)

    def see(frames):
        for frame_ in frames:
            seen.add(len(frame_))
            yield frame_

    batch = frame(spark, ("a", 1, D1), ("b", 1, D2), ("n", 1, None)).mapInPandas(see, SCHEMA)
    monkeypatch.setattr(type(batch), "persist", lambda *_: pytest.fail("held"))
    session = spark.newSession()
    assert T.upsert(batch, folder("t"), KEYS, session=session) == T.UpsertResult(3, False) and seen.value == 3
    assert content(spark, folder("t")) == [("a", 1, D1), ("b", 1, D2), ("n", 1, None)]
    none = batch.filter("v > 1").groupBy(*KEYS).agg(F.max("v").alias("v")).select("id", "v", "dt")
    assert T.upsert(none, folder("none"), KEYS) == T.UpsertResult(0, False) and not os.path.exists(folder("none"))


def test_a_later_batch_is_counted_and_divided_in_one_pass(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, ("a", 1, D1), ("b", 1, D2)), path, KEYS, buckets=2)
    kept = data_files(path)
    assert T.upsert(frame(spark, ("n", 2, None)), path, KEYS, buckets=2) == T.UpsertResult(1, False)
    assert kept < data_files(path)
    # All in stale partitions: nothing is left to add after the rewrite.
    assert T.upsert(frame(spark, ("a", 2, D1), ("b", 2, D2)), path, KEYS, buckets=2) == T.UpsertResult(2, True)
    # A stale partition, one without a match and one without a date.
    rows = frame(spark, ("a", 3, D1), ("c", 3, D3), ("n", 3, None))
    assert T.upsert(rows, path, KEYS, buckets=2) == T.UpsertResult(3, True)
    expected = [("a", 3, D1), ("b", 2, D2), ("c", 3, D3), ("n", 2, None), ("n", 3, None)]
    assert [r[:3] for r in content(spark, path)] == sorted(expected, key=str)  # the bucket aside


def test_only_null_dates(spark, folder):
    path = folder("t")
    for value in (1, 2):
        T.upsert(frame(spark, ("a", value, None)), path, KEYS)
    assert content(spark, path) == [("a", 1, None), ("a", 2, None)]


def test_upsert_refuses_other_columns(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, ("a", 1, D1)), path, KEYS)
    with pytest.raises(ValueError, match="extra"):
        T.upsert(frame(spark, ("a", 1, D1)).withColumn("extra", F.lit(1)), path, KEYS)
    with pytest.raises(ValueError, match="v"):
        T.upsert(frame(spark, ("a", 1, D1)).drop("v"), path, KEYS)


def test_insert_new_keeps_the_first(spark, folder):
    path = folder("t")
    T.insert_new(frame(spark, ("a", 1, D1)), path, KEYS)
    T.insert_new(frame(spark, ("a", 2, D1), ("a", 2, D2)), path, KEYS)
    assert content(spark, path) == [("a", 1, D1), ("a", 2, D2)]


def test_upsert_reads_keys_of_touched_partitions_only(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, ("a", 1, D1), ("b", 1, D2)), path, KEYS)
    touched = T.Partitions.of(frame(spark, ("a", 2, D1)), "dt")
    target = spark.read.schema(SCHEMA).parquet(path)
    plan = touched.inside(target.select(*KEYS))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan
    assert "PartitionFilters: [isnotnull(dt" in plan


@pytest.mark.parametrize("dates", [2, 12_000])
def test_layout_is_planned_alike_at_every_size(spark, dates):
    rows = spark.range(24_000).select(F.col("id"), F.expr(f"date_add(DATE'1990-01-01', int(id % {dates}))").alias("dt"))
    out = layout.gathered(rows, ["dt"])
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") == 1 and "REBALANCE" in plan
    assert out.count() == 24_000 and out.columns == rows.columns


def test_a_hot_partition_is_split_by_bytes(spark, folder):
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.col("id").alias("v"), F.expr("date_add(DATE'2024-01-01', int(id div 50000))").alias("dt"))
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "true")
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    T.append(rows, folder("t"), "dt", session)
    assert sum("dt=2024-01-01" in f for f in data_files(folder("t"))) > 2


def test_many_partitions_are_upserted(spark, folder):
    path = folder("t")
    rows = spark.range(300).select(F.col("id").cast("string"), F.lit(1).alias("v"), F.expr("date_add(DATE'1990-01-01', int(id))").alias("dt"))
    T.upsert(rows, path, KEYS)
    assert T.upsert(rows.filter("v = 1 AND id < 5").withColumn("v", F.lit(2)), path, KEYS).matched
    assert len(data_files(path)) == 300 and len(content(spark, path)) == 300


def test_a_match_rewrites_one_bucket(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, *[(f"k{i}", 1, D1) for i in range(40)]), path, KEYS, buckets=4)
    before = data_files(path)
    assert len(before) == 4
    T.upsert(frame(spark, ("k7", 2, D1)), path, KEYS, buckets=4)
    assert len(before & data_files(path)) == 3 and len(data_files(path)) == 4
    held = T.read_merged(spark, path)
    assert held.columns == ["id", "v", "dt"] and held.count() == 40 and held.filter("id = 'k7'").first().v == 2
    T.compact(spark, path)
    assert T.read_merged(spark, path).count() == 40 and len(data_files(path)) == 4


def test_a_rewrite_that_died_is_finished(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, ("a", 1, D1), ("b", 1, D1), ("c", 1, D2)), path, KEYS)
    # The staged copy is complete and the old folder is gone already.
    frame(spark, ("a", 2, D1), ("b", 1, D1)).write.partitionBy("dt").parquet(f"{path}/{T.STAGED}")
    shutil.rmtree(f"{path}/dt={D1}")
    assert len(content(spark, path)) == 1
    T.upsert(frame(spark, ("a", 2, D1)), path, KEYS)
    assert content(spark, path) == [("a", 2, D1), ("b", 1, D1), ("c", 1, D2)]
    # An incomplete one is dropped.
    frame(spark, ("a", 9, D1)).write.partitionBy("dt").parquet(f"{path}/{T.STAGED}")
    os.remove(f"{path}/{T.STAGED}/_SUCCESS")
    T.upsert(frame(spark, ("d", 1, D2)), path, KEYS)
    assert ("a", 2, D1) in content(spark, path) and not os.path.exists(f"{path}/{T.STAGED}")


def test_a_column_of_some_files_stays(spark, folder):
    path = folder("t")
    T.upsert(frame(spark, ("a", 1, D1)), path, KEYS)
    wide = frame(spark, ("b", 1, D1)).withColumn("w", F.lit("x"))
    with pytest.raises(ValueError, match="w"):
        T.upsert(wide, path, KEYS)
    T.upsert(wide, path, KEYS, widen=True)
    with pytest.raises(ValueError, match="w"):
        T.upsert(frame(spark, ("a", 2, D1)), path, KEYS)
    T.upsert(frame(spark, ("a", 2, D1)).withColumn("w", F.lit("y")), path, KEYS)
    T.compact(spark, path)
    assert sorted((r.id, r.v, r.w) for r in spark.read.parquet(path).collect()) == [("a", 2, "y"), ("b", 1, "x")]


def test_compaction_keeps_rows_and_merges_files(spark, folder):
    path = folder("t")
    for i in range(5):
        T.append(frame(spark, (f"a{i}", i, D1), (f"b{i}", i, D2), (f"n{i}", i, None)), path)
    before, many = content(spark, path), len(data_files(path))
    T.compact(spark, path, values=[D1])
    assert sum(f"dt={D1}" in f for f in data_files(path)) == 1
    T.compact(spark, path)
    assert content(spark, path) == before and len(data_files(path)) == 3 < many


def test_retain(spark, folder):
    path = folder("t")
    T.append(frame(spark, ("a", 1, D1), ("b", 1, D2), ("c", 1, D3), ("n", 1, None)), path)
    assert T.retain(spark, path, D2) == [str(D1)]
    assert content(spark, path) == [("b", 1, D2), ("c", 1, D3), ("n", 1, None)]


def test_append_or_create(spark, folder):
    T.create_namespaces(spark, folder("db"), ["ns_a"])
    T.create_namespaces(spark, folder("db"), ["ns_a"])
    assert T.append_or_create(frame(spark), "ns_a.t") == 0
    assert not spark.catalog.tableExists("ns_a.t")
    assert T.append_or_create(frame(spark, ("a", 1, D1)), "ns_a.t", "dt") == 1
    assert T.append_or_create(frame(spark, ("b", 1, D1), ("c", 1, D2)), "ns_a.t", "dt") == 2
    assert spark.table("ns_a.t").count() == 3


def test_a_failing_append_leaves_the_table(spark, folder):
    T.create_namespaces(spark, folder("db"), ["ns_b"])
    T.append_or_create(frame(spark, ("a", 1, D1)), "ns_b.t")
    broken = frame(spark, ("b", 1, D1)).withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        T.append_or_create(broken, "ns_b.t")
    assert [r.id for r in spark.table("ns_b.t").collect()] == ["a"]


def test_replace(spark, folder):
    T.create_namespaces(spark, folder("db"), ["ns_c"])
    T.replace_table(frame(spark, ("a", 1, D1)), "ns_c.t")
    assert T.replace_table(frame(spark, ("b", 1, D1)), "ns_c.t") == 1
    assert [r.id for r in spark.table("ns_c.t").collect()] == ["b"]


def test_a_failing_replace_leaves_the_table(spark, folder):
    T.create_namespaces(spark, folder("db"), ["ns_e"])
    T.replace_table(frame(spark, ("a", 1, D1)), "ns_e.t")
    broken = frame(spark, ("b", 1, D1)).withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        T.replace_table(broken, "ns_e.t")
    assert [r.id for r in spark.table("ns_e.t").collect()] == ["a"]
    assert [t.name for t in spark.catalog.listTables("ns_e") if not t.isTemporary] == ["t"]
    T.replace_table(spark.table("ns_e.t").withColumn("v", F.col("v") + 1), "ns_e.t")
    assert [tuple(r)[:2] for r in spark.table("ns_e.t").collect()] == [("a", 2)]


def test_a_repeated_change_adds_nothing(spark, folder):
    path = folder("log")
    for _ in range(2):
        T.append_change(frame(spark, ("a", 1, D1)), path, 3, "r")
    assert [(r.id, r.batch_id, r.run) for r in spark.read.parquet(path).collect()] == [("a", 3, "r")]


def test_insert_new_holds_undated_rows_once(spark, folder):
    path = folder("t")
    for _ in range(2):
        T.insert_new(frame(spark, ("a", 1, None), ("b", 1, D1)), path, KEYS)
    assert content(spark, path) == sorted([("a", 1, None), ("b", 1, D1)], key=str)


def test_as_of(spark, folder):
    path = folder("log")
    T.append_change(frame(spark, ("a", 1, D1), ("n", 1, None)), path, 1)
    T.append_change(frame(spark, ("a", 2, D1), ("b", 2, D2), ("n", 2, None)), path, 2)
    T.append_change(frame(spark, ("a", 3, D1)), path, 3)
    log = spark.read.parquet(path)
    versions = {n: sorted((r.id, r.v) for r in T.as_of(log, KEYS, n).collect()) for n in (1, 2, 3)}
    assert versions[1] == [("a", 1), ("n", 1)]
    assert versions[2] == [("a", 2), ("b", 2), ("n", 1), ("n", 2)]
    assert versions[3] == [("a", 3), ("b", 2), ("n", 1), ("n", 2)]


def test_csv_ingest(spark, folder):
    T.create_namespaces(spark, folder("db"), ["ns_d"])
    path = folder("in.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("name,value\nå,1\nb,2.5\n")
    written = ingest(spark, [CsvDataset(path, "ns_d.a"), CsvDataset(path, "ns_d.b", "name STRING, value STRING")], D1)
    assert written == {"ns_d.a": 2, "ns_d.b": 2}
    assert dict(spark.table("ns_d.a").dtypes) == {"name": "string", "value": "double", "dt": "date"}
    assert sorted(r.name for r in spark.table("ns_d.a").collect()) == ["b", "å"]
    assert dict(spark.table("ns_d.b").dtypes)["value"] == "string"


def test_one_per_key_limits_before_the_exchange(spark):
    df = frame(spark, ("a", 2, D1), ("a", 1, D1), ("a", None, D2)).repartition(2)
    out = one_per_key(df, KEYS)
    assert sorted((r.dt, r.v) for r in out.collect()) == [(D1, 1), (D2, None)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_derived_columns_do_not_order(spark):
    """What nobody asks for is not computed only to order copies by it; the copy that is kept is the same."""
    rows = [(1, 9, "c", "3,-4.5"), (1, 9, "c", "1,-2.5"), (1, 9, "c", None), (2, 8, "c", "bad")]
    df = spark.createDataFrame(rows, "id INT, v INT, w STRING, geo STRING").repartition(2)
    df = df.withColumns({"lat": C.latitude(F.col("geo")), "lon": C.longitude(F.col("geo"))})
    assert one_per_key(df, ["id"], derived=["lat", "lon"]).collect() == one_per_key(df, ["id"]).collect()
    few = rows_of.silver_frame(spark, SF_DIR, TRANSACTIONS).select("transaction_id", "timestamp")
    assert "regexp_extract" not in few._jdf.queryExecution().optimizedPlan().toString()


def test_upserted_payments_are_corrected_on_all_dates_and_none_is_left_out(spark, folder):
    path, early, late = folder("sf"), "1996-03-04", "2001-05-06"
    rows = [(1, 10, 3, 1, 25000.0, "R", early), (2, 10, 3, 1, 25000.0, "R", late), (3, 10, 3, 1, 25000.0, "A", early)]
    rows += [(4, 10, 3, 1, 25000.0, "A", None), (5, 10, 3, 1, 25000.0, "A", late)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, d string"
    lines = spark.createDataFrame(rows, columns).withColumn("l_shipdate", F.col("d").cast("timestamp")).drop("d")
    lines.write.parquet(f"{path}/lineitem.parquet")
    got = QUERIES["silver_upsert_transactions"].run(spark, path)
    amounts = {r.transaction_id: r.amount for r in got.collect()}
    # The corrections of 1 and 2 have another amount; 4 has no date.
    assert amounts == {"T1-1": 5001.0, "T2-1": 5000.0, "T3-1": 5000.0, "T4-1": 5000.0, "T5-1": 5000.0}
