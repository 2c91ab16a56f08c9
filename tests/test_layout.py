"""Compaction by file size, and tables clustered by several columns: what is read, written and left alone."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import tables as T
from ledgerline.operators.cluster import read_between, refresh_zones, write_clustered
from ledgerline.sources import files

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def held(path):
    """Name, size and time of writing of every data file."""
    out = {}
    for top, _, names in os.walk(path):
        if "/_" in top[len(path) :]:
            continue
        for n in names:
            if n.endswith(".parquet"):
                info = os.stat(f"{top}/{n}")
                out[f"{top[len(path):]}/{n}"] = (info.st_size, info.st_mtime_ns)
    return out


def frame(spark, first, n, day):
    rows = spark.range(first, first + n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    return rows.withColumn("dt", F.lit(day).cast("date")).coalesce(1)


@pytest.fixture
def table(spark, folder):
    path = folder("t")
    for at, n, day in [(0, 20_000, D1), (20_000, 5, D1), (20_005, 5, D1), (30_000, 5, D2), (40_000, 5, None), (40_005, 5, None)]:
        T.append(frame(spark, at, n, day), path)
    return path


def rows_of(spark, path):
    return sorted(map(repr, spark.read.parquet(path).collect()))


def test_only_small_files_are_merged(spark, table):
    before, rows = held(table), rows_of(spark, table)
    assert T.compact_small(spark, table, limit=50_000) == 4
    after = held(table)
    large = {k: v for k, v in before.items() if v[0] >= 50_000 or f"dt={D2}" in k}
    assert len(large) == 2 and large.items() <= after.items()
    assert len(after) == 4 and rows_of(spark, table) == rows
    assert T.compact_small(spark, table, limit=50_000) == 0
    assert held(table) == after


def test_of_the_given_partitions_only(spark, table):
    before = held(table)
    assert T.compact_small(spark, table, limit=50_000, values=[D2]) == 0
    assert held(table) == before
    assert T.compact_small(spark, table, limit=50_000, values=[D1]) == 2
    assert {k: v for k, v in before.items() if str(D1) not in k}.items() <= held(table).items()


def test_partition_values_keep_their_spelling(spark, folder):
    path = folder("t")
    for i in range(2):
        spark.range(i, i + 1).selectExpr("id", "'01' AS dt").coalesce(1).write.partitionBy("dt").mode("append").parquet(path)
    assert T.compact_small(spark, path) == 2
    assert os.path.isdir(f"{path}/dt=01") and len(held(path)) == 1


def test_columns_that_came_later_stay(spark, folder):
    path = folder("t")
    T.append(frame(spark, 0, 2, D1), path)
    T.append(frame(spark, 2, 2, D1).withColumn("w", F.lit("x")), path)
    assert T.compact_small(spark, path) == 2
    assert [r.w for r in T.read_merged(spark, path).orderBy("id").collect()] == [None, None, "x", "x"]


def test_buckets_are_merged_apart(spark, folder):
    path = folder("t")
    for i in range(4):
        T.upsert(frame(spark, 10 * i, 10, D1), path, ["id", "dt"], buckets=2)
    rows = rows_of(spark, path)
    assert T.compact_small(spark, path) == 8
    assert len(held(path)) == 2 and rows_of(spark, path) == rows
    T.upsert(frame(spark, 0, 40, D1), path, ["id", "dt"], buckets=2)
    assert rows_of(spark, path) == rows


@pytest.mark.parametrize("stop", ["drop_file", "move_files", "drop_folder"])
def test_a_job_that_dies_is_finished_by_the_next_write(spark, table, monkeypatch, stop):
    rows, calls, whole = rows_of(spark, table), [], getattr(files, stop)

    def dying(*args):
        calls.append(args)
        if stop != "drop_file" or len(calls) > 1:
            raise RuntimeError("gone")
        whole(*args)

    with monkeypatch.context() as patch:
        patch.setattr(files, stop, dying)
        with pytest.raises(RuntimeError, match="gone"):
            T.compact_small(spark, table, limit=50_000)
    T.upsert(frame(spark, 50_000, 1, D2), table, ["id", "dt"])
    assert len(rows_of(spark, table)) == len(rows) + 1 and set(rows) <= set(rows_of(spark, table))
    assert not os.path.exists(f"{table}/{T.MERGED}")


def test_an_incomplete_merge_is_dropped(spark, table):
    rows = rows_of(spark, table)
    frame(spark, 0, 5, D1).write.parquet(f"{table}/{T.MERGED}/files/dt={D1}")
    T.retain(spark, table, D1)
    assert rows_of(spark, table) == rows and not os.path.exists(f"{table}/{T.MERGED}")


# --- Clustering ---------------------------------------------------------------------------------------


def points(spark, n=20_000):
    """Two unrelated columns; a third of the rows share one value of ``a``; some values are NULL or repeat."""
    rows = spark.range(n).withColumn("h", F.xxhash64("id"))
    return rows.select(
        "id",
        F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 101 == 0, None).otherwise(F.pmod("h", F.lit(1000))).cast("int").alias("a"),
        F.concat(F.lit("M"), F.lpad(F.pmod(F.shiftright("h", 20), F.lit(1000)).cast("string"), 4, "0")).alias("b"),
    )


def files_read(df):
    """The scan's own count, which is set in its first run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numFiles").get().value()


@pytest.fixture
def clustered(spark, folder):
    path = folder("z")
    write_clustered(points(spark), path, ["a", "b"], parts=32)
    return path


@pytest.mark.parametrize(
    "bounds", [{"a": (100, 130)}, {"b": ("M0100", "M0130")}, {"a": (100, 300), "b": (None, "M0300")}, {"a": (900, None)}]
)
def test_a_filter_on_either_column_reads_fewer_files(spark, clustered, bounds):
    got = read_between(spark, clustered, bounds)
    whole = points(spark)
    for name, (low, high) in bounds.items():
        whole = whole.filter(F.col(name) >= F.lit(low)) if low is not None else whole
        whole = whole.filter(F.col(name) <= F.lit(high)) if high is not None else whole
    assert 0 < files_read(got) <= 12
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect()))
    assert files_read(spark.read.parquet(clustered)) == 32


def test_a_hot_value_is_spread(spark, clustered):
    sizes = [r["count"] for r in spark.read.parquet(clustered).groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 4 * 20_000 / 32


def test_rows_added_later_and_files_gone(spark, clustered):
    spark.createDataFrame([(-1, 5, "M0005"), (-2, None, None)], "id long, a int, b string").write.mode("append").parquet(clustered)
    assert -1 in [r.id for r in read_between(spark, clustered, {"a": (5, 5)}).collect()]
    before = files_read(read_between(spark, clustered, {"b": ("M0900", None)}))
    refresh_zones(spark, clustered, ["a", "b"])
    refresh_zones(spark, clustered, ["a", "b"])
    assert files_read(read_between(spark, clustered, {"b": ("M0900", None)})) < before
    gone = next(iter(held(clustered)))
    os.remove(clustered + gone)
    left = spark.read.parquet(clustered).filter("a BETWEEN 0 AND 1000").count()
    assert read_between(spark, clustered, {"a": (0, 1000)}).count() == left


def test_clustering_of_little(spark, folder):
    empty, path = folder("empty"), folder("odd")
    write_clustered(points(spark, 0), empty, ["a", "b"])
    assert read_between(spark, empty, {"a": (0, 9)}).collect() == []
    rows = [(None, float("nan"), None), (D1, None, "ä" * 9), (D2, 1.5, ""), (D2, 1.5, "")]
    frame = spark.createDataFrame(rows, "d date, x double, s string").withColumn("m", F.create_map(F.lit("k"), "x"))
    write_clustered(frame, path, ["d", "x", "s"], parts=2)
    assert [r.s for r in read_between(spark, path, {"d": (D2, D2)}).collect()] == ["", ""]
    assert read_between(spark, path, {"s": ("z", None)}).count() == 1
    assert read_between(spark, path, {"d": (dt.date(2030, 1, 1), None)}).collect() == []


def test_too_many_bits(spark, folder):
    with pytest.raises(ValueError, match="bits"):
        write_clustered(points(spark, 1), folder("z"), ["a"] * 11)
