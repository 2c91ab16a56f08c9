"""Master data that changes: versions with a validity range, their upsert, and facts that meet the version of their time.

A change says what a key's columns are from a time on. A version is a change with the time of the key's next change,
``valid_to``, which is NULL for the open one. The table keeps a version for every change, also for one that repeats the
values before it, so that what it holds does not depend on the order in which changes arrive; :func:`merged` joins
equal neighbours for readers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators import tables
from ledgerline.sources import files

FROM, TO = "valid_from", "valid_to"
DAY = 86_400


def _timeline(key: str):
    return Window.partitionBy(key).orderBy(FROM)


def _closed(starts: DataFrame, key: str) -> DataFrame:
    """Each row's version ends where the key's next one begins."""
    return starts.withColumn(TO, F.lead(FROM).over(_timeline(key)))


def versions_of(changes: DataFrame, key: str, time: str, columns: Sequence[str], newest: Column | None = None) -> DataFrame:
    """(key, columns, valid_from, valid_to) from changes in any order.

    Of several changes of a key at one time the one with the largest ``newest``, then with the largest values, counts.
    Changes without a key or a time are left out.
    """
    rank = F.lit(0) if newest is None else newest
    state = F.max(F.struct(rank.alias("_rank"), *columns)).alias("_state")
    known = changes.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    starts = known.groupBy(key, F.col(time).alias(FROM)).agg(state)
    return _closed(starts.select(key, *[F.col(f"_state.{c}").alias(c) for c in columns], FROM), key)


def merged(versions: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The versions, those made one that follow each other with equal columns."""
    state, order = F.struct(*columns), _timeline(key)
    fresh = (F.row_number().over(order) == 1) | ~state.eqNullSafe(F.lag(state).over(order))
    starts = versions.withColumn("_fresh", fresh).filter("_fresh").select(key, *columns, FROM)
    return _closed(starts, key)


def upsert_versions(
    changes: DataFrame,
    path: str,
    key: str,
    time: str,
    columns: Sequence[str],
    buckets: int = 64,
    session: SparkSession | None = None,
) -> None:
    """Takes changes into the table at ``path``: closes the versions they end, and divides those that they fall into.

    A change that is there already, with the same key and time, is replaced; so a repeated batch changes nothing, and
    late changes find their place. The table lies in ``buckets`` folders by hash of the key; only those with a
    changed key are rewritten, beside the old ones first, and within them only the changed keys are computed anew.
    """
    spark = session or changes.sparkSession
    known = changes.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    fresh = known.select(key, *columns, F.col(time).alias(FROM))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    if tables.untouched(spark, path):
        out = versions_of(fresh, key, FROM, columns).withColumn(tables.BUCKET, bucket)
        tables.filled(out, path, [tables.BUCKET], spark)
        return
    fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = tables.Partitions.of(fresh.select(bucket.alias(tables.BUCKET)), tables.BUCKET)
        if touched.empty:
            return
        # An empty frame tells the columns of a version, their types and order.
        shape = versions_of(fresh.limit(0), key, FROM, columns).withColumn(tables.BUCKET, bucket)
        tables.finish_rewrite(spark, path, shape.schema, [tables.BUCKET])
        if not files.has_data(spark, path):
            out = versions_of(fresh, key, FROM, columns)
            tables.append(out.withColumn(tables.BUCKET, bucket), path, tables.BUCKET, session)
            return
        held = touched.inside(spark.read.schema(shape.schema).parquet(path)).drop(tables.BUCKET)
        keys = fresh.select(key).distinct()
        before = held.join(keys, key, "left_semi").select(*fresh.columns, F.lit(0).alias("_newest"))
        both = before.unionByName(fresh.withColumn("_newest", F.lit(1)))
        anew = versions_of(both, key, FROM, columns, F.col("_newest"))
        out = held.join(keys, key, "left_anti").select(*anew.columns).unionByName(anew)
        tables.rewrite(out.withColumn(tables.BUCKET, bucket), path, [tables.BUCKET], session)
    finally:
        fresh.unpersist()


def valid_at(
    facts: DataFrame, versions: DataFrame, on: tuple[str, str], time: str, columns: Sequence[str], stretch: int = DAY
) -> DataFrame:
    """Every fact with the columns of the version that was valid at its time, NULL where there was none.

    ``on`` names the key in facts and versions. A join on the key alone would compare all facts of a key with all its
    versions, in one task. So time is cut into stretches of ``stretch`` seconds: a fact is compared only with the
    versions that begin in its stretch and with the one valid when the stretch begins. The latter is carried along a
    timeline of versions and stretches, not of facts: facts of a hot key have become one row a stretch by then. In
    the final join each day of a key is a key of its own, which AQE splits further.
    """
    left, right = on

    def number(at: Column) -> Column:
        return F.floor(F.unix_seconds(at) / stretch)

    numbered = facts.withColumn("_stretch", number(F.col(time)))
    version = F.struct(F.col(FROM).alias("from"), F.col(TO).alias("to"), *columns).alias("_version")
    known = versions.select(F.col(right).alias("_key"), version).withColumn("_at", F.col("_version.from"))
    asked = numbered.select(F.col(left).alias("_key"), "_stretch").dropna().distinct()
    begun = F.timestamp_seconds(F.col("_stretch") * stretch)
    # At one time the stretch comes first: a version that begins with it is found inside.
    marks = asked.select("_key", begun.alias("_at"), F.lit(0).alias("_kind"), "_stretch", F.lit(None).alias("_version"))
    marks = marks.unionByName(known.select("_key", "_at", F.lit(1).alias("_kind"), F.lit(None).alias("_stretch"), "_version"))
    so_far = Window.partitionBy("_key").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = marks.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).filter("_kind = 0")
    carried = carried.filter(F.col("_version").isNotNull()).select("_key", "_stretch", "_version")
    pieces = carried.unionByName(known.select("_key", number(F.col("_at")).alias("_stretch"), "_version"))
    pieces = pieces.withColumnRenamed("_stretch", "_in")
    at, start, end = numbered[time], F.col("_version.from"), F.col("_version.to")
    match = (numbered[left] == pieces["_key"]) & (numbered["_stretch"] == pieces["_in"])
    match = match & (start <= at) & (end.isNull() | (at < end))
    found = [F.col(f"_version.{c}").alias(c) for c in columns]
    return numbered.join(pieces, match, "left").select(*facts.columns, *found, start.alias(FROM), end.alias(TO))
