"""Table writes: append, replace, keyed upsert, maintenance and as-of reads.

Tables are date-partitioned parquet. A rewrite replaces whole partitions when its job commits, so each table
needs a single writer, and a reader that lists files during the commit may see old and new partitions mixed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline import schemas
from ledgerline.operators.dedup import one_per_key
from ledgerline.operators.layout import gathered, planned_by
from ledgerline.sources import files

# --- Catalog tables -----------------------------------------------------------------------------------


def create_namespaces(spark: SparkSession, location: str, names: Sequence[str] = schemas.NAMESPACES) -> None:
    """Creates the databases that are missing, below ``location``."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}/{name}'")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, counted on their way into the write instead of by a second pass."""
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("rows")), written


def append_or_create(df: DataFrame, table: str, partition_by: str | None = None) -> int:
    """Appends to the table, creating it first if it is missing; an empty input leaves everything as it was.

    Returns the rows written. Any failure other than "no such table" reaches the caller with the table intact.
    """
    if df.isEmpty():
        return 0
    counted, written = _counted(df)
    writer = counted.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    exists = df.sparkSession.catalog.tableExists(table)
    writer.mode("append" if exists else "errorifexists").saveAsTable(table)
    return written.get["rows"]


def replace_table(df: DataFrame, table: str, partition_by: str | None = None) -> int:
    """Creates the table from ``df``, replacing the one that is there; rows written.

    The rows are written beside the old table, which is dropped only then: a failing replace leaves it as it was,
    and ``df`` may read it.
    """
    spark = df.sparkSession
    fresh = f"{table}__{uuid.uuid4().hex[:12]}"
    counted, written = _counted(df)
    writer = counted.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        writer.saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    rows = written.get["rows"]
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    if partition_by:  # the catalog's list of partitions may not have moved along
        spark.catalog.recoverPartitions(table)
    return rows


# --- Partitioned folders ------------------------------------------------------------------------------


# Folder inside a table for rewritten partitions; readers pass over names that begin with an underscore.
STAGED = "_staged"
# The same for the files that a compaction has merged, with the list of those they replace.
MERGED = "_merged"
BUCKET = "bucket"


def append(
    df: DataFrame, path: str, partition: str | Sequence[str] | None = "dt", session: SparkSession | None = None
) -> None:
    """Adds rows, those of one partition gathered in few tasks, so that the files are about as many as partitions."""
    columns = [partition] if isinstance(partition, str) else list(partition or ())
    writer = (gathered(df, columns, session) if columns else df).write.mode("append")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str | Sequence[str] = "dt") -> None:
    """Replaces exactly the partitions that occur in ``df``. ``df`` may read the same table."""
    columns = [partition] if isinstance(partition, str) else list(partition)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def finish_rewrite(spark: SparkSession, path: str, schema: StructType, columns: Sequence[str]) -> None:
    """Puts a complete set of staged partitions in place, and drops an incomplete one. Harmless to repeat."""
    finish_merge(spark, path)
    staged = f"{path}/{STAGED}"
    if not files.exists(spark, staged):
        return
    if files.exists(spark, f"{staged}/_SUCCESS"):
        files.replace_folders(spark, staged, path, len(columns))
        spark.catalog.refreshByPath(path)
    files.drop_folder(spark, staged)


def rewrite(df: DataFrame, path: str, columns: Sequence[str], session: SparkSession | None = None) -> None:
    """Replaces the partitions that occur in ``df``, by way of a staged copy.

    The old folders go only once all new rows are written beside them, so a job that dies in between has lost
    nothing: the next write to the table, or :func:`finish_rewrite`, finishes it.
    """
    spark = session or df.sparkSession
    gathered(df, columns, session).write.mode("overwrite").partitionBy(*columns).parquet(f"{path}/{STAGED}")
    finish_rewrite(spark, path, df.schema, columns)


@dataclass(frozen=True)
class Partitions:
    """A set of partitions by their values, for the scan to prune by. It is never larger than the table's own list
    of partitions, which Spark holds on the driver for every scan."""

    columns: tuple[str, ...]
    values: tuple[tuple, ...]

    @classmethod
    def of(cls, df: DataFrame, *columns: str) -> Partitions:
        """The partitions that occur in ``df``, those without a NULL."""
        found = df.select(*columns).dropna().distinct().collect()
        return cls(columns, tuple(tuple(r) for r in found))

    @property
    def empty(self) -> bool:
        return not self.values

    def _condition(self) -> Column:
        by_rest: dict[tuple, list] = {}
        for first, *rest in self.values:
            by_rest.setdefault(tuple(rest), []).append(first)
        out = F.lit(False)
        for rest, first in by_rest.items():
            one = F.col(self.columns[0]).isin(first)
            for name, value in zip(self.columns[1:], rest):
                one = one & (F.col(name) == value)
            out = one if len(by_rest) == 1 else out | one
        return out

    def inside(self, df: DataFrame) -> DataFrame:
        return df.filter(self._condition())

    def outside(self, df: DataFrame) -> DataFrame:
        """Rows of all other partitions, those with a NULL among them."""
        return df.filter(~F.coalesce(self._condition(), F.lit(False)))


@dataclass(frozen=True)
class UpsertResult:
    rows: int
    matched: bool


def held_columns(spark: SparkSession, path: str, partition: str, values: Sequence) -> list[str]:
    """All columns that files of the given partitions have (and the partition column), oldest layout or newest."""
    folders = files.partition_values(spark, path, partition)
    wanted = [folders[str(v)] for v in values if str(v) in folders]
    if not wanted:
        return []
    reader = spark.read.option("mergeSchema", True).option("basePath", path)
    return [c for c in reader.parquet(*wanted).columns if c != BUCKET]


def check_columns(
    spark: SparkSession, path: str, columns: Sequence[str], partition: str, values: Sequence, widen: bool = False
) -> None:
    """Raises if the touched partitions hold a column that the rows to be written lack, or lack one that these have
    (unless the table may be widened)."""
    held = set(held_columns(spark, path, partition, values))
    odd = held - set(columns) if widen else held ^ set(columns)
    if held and odd:
        raise ValueError(f"columns differ from the table's: {sorted(odd)}")


def _bucketed(df: DataFrame, keys: Sequence[str], partition: str, buckets: int) -> DataFrame:
    if buckets == 1:
        return df
    names = [k for k in keys if k != partition]
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int"))


def untouched(spark: SparkSession, path: str) -> bool:
    """Whether the table holds nothing, no rewrite to be finished either."""
    pending = any(files.exists(spark, f"{path}/{folder}") for folder in (STAGED, MERGED))
    return not pending and not files.has_data(spark, path)


def filled(batch: DataFrame, path: str, columns: Sequence[str], session: SparkSession) -> int:
    """Writes the first rows of a table, counted on their way; without any there is no table."""
    there = files.exists(session, path)
    counted, written = _counted(planned_by(session, batch))
    append(counted, path, columns)
    if files.has_data(session, path):
        return written.get["rows"]
    if not there:
        files.drop_folder(session, path)
    return 0  # not asked for: a plan that is empty from the start counts nothing


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: str = "dt",
    buckets: int = 1,
    widen: bool = False,
    session: SparkSession | None = None,
) -> UpsertResult:
    """Rows of ``batch`` replace the table's rows with equal keys; the others are added.

    ``keys`` contain the partition column and are unique within the batch. As in SQL's MERGE a NULL key matches
    nothing, so such rows are always added. Running the same batch again leaves the other rows unchanged.

    A table without rows is filled in one pass over the batch. Else the batch is held, and
    only key columns of the touched partitions are read to look for matches. Without any - the normal case for
    fresh events - the batch is appended and nothing is rewritten; otherwise just the partitions with a match are.
    ``buckets``, a property of the table, divides each date by a hash of the key, so that a match rewrites one
    bucket of its date only. With ``widen`` a batch may bring new columns, NULL in older rows; a batch that lacks a
    column of the partitions it touches is always refused.

    ``session`` plans the work. A micro-batch comes with a session that has adaptive execution switched off, so a
    stream passes the one it was started from.
    """
    spark = session or batch.sparkSession
    keys = list(keys)
    columns = [partition] + ([BUCKET] if buckets > 1 else [])
    batch = _bucketed(batch, keys, partition, buckets)
    if untouched(spark, path):
        return UpsertResult(filled(batch, path, columns, spark), False)
    held = batch.storageLevel.useMemory  # the caller's own, to be left as it is
    batch = batch if held else batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # One pass fills the cache, counts and finds the partitions.
        sizes = {tuple(r[:-1]): r[-1] for r in batch.groupBy(*columns).count().collect()}
        rows = sum(sizes.values())
        if rows == 0:
            return UpsertResult(0, False)
        finish_rewrite(spark, path, batch.schema, columns)
        touched = Partitions(tuple(columns), tuple(v for v in sizes if None not in v))
        stale = Partitions(touched.columns, ())
        if not touched.empty and files.has_data(spark, path):
            dates = sorted({v[0] for v in touched.values})
            check_columns(spark, path, [c for c in batch.columns if c != BUCKET], partition, dates, widen)
            target = spark.read.schema(batch.schema).parquet(path)
            batch_keys = batch.select(*keys)
            looked = list(dict.fromkeys([*keys, *columns]))
            hits = touched.inside(target.select(*looked)).join(batch_keys, keys, "left_semi")
            stale = Partitions.of(hits, *columns)
        if stale.empty:
            append(batch, path, columns, session)
            return UpsertResult(rows, False)
        kept = stale.inside(target).join(batch_keys, keys, "left_anti").select(*batch.columns)
        # Rewrites before additions: if the job dies in between, a rerun rewrites the same rows and then adds the
        # rest once.
        rewrite(kept.unionByName(stale.inside(batch)), path, columns, session)
        if set(sizes) - set(stale.values):
            append(stale.outside(batch), path, columns, session)
        return UpsertResult(rows, True)
    finally:
        if not held:
            batch.unpersist()


def insert_new(
    batch: DataFrame, path: str, keys: Sequence[str], partition: str = "dt", session: SparkSession | None = None
) -> None:
    """Adds the rows of ``batch`` whose keys the table does not hold yet: the first write of a key wins.

    Rows without a date match on the rest of their key, so that they too are held once.
    """
    spark = session or batch.sparkSession
    keys = list(keys)
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if batch.isEmpty():
            return
        fresh = batch
        if files.has_data(spark, path):
            touched = Partitions.of(batch, partition)
            check_columns(spark, path, batch.columns, partition, [v[0] for v in touched.values])
            target = spark.read.schema(batch.schema).parquet(path).select(*keys)
            near = touched.inside(target).unionByName(target.filter(F.col(partition).isNull()))
            asked = batch.select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            # The batch is on the side that can be broadcast; what comes out is no larger than the batch.
            held = near.join(asked, same, "left_semi").distinct().select(*[F.col(k).alias(f"_{k}") for k in keys])
            fresh = batch.join(held, same, "left_anti")
        append(fresh, path, partition, session)
    finally:
        batch.unpersist()


def compact(spark: SparkSession, path: str, partition: str = "dt", values: Sequence | None = None) -> None:
    """Rewrites the given partitions (default: all) into files of Spark's advisory size. Columns that only some of
    the files have stay."""
    table = _whole(spark, path)
    columns = [partition] + ([BUCKET] if BUCKET in table.columns else [])
    finish_rewrite(spark, path, table.schema, columns)
    if values is not None:
        table = table.filter(F.col(partition).isin(list(values)))
    rewrite(table, path, columns)


def compact_small(
    spark: SparkSession, path: str, partition: str = "dt", limit: int = 64 << 20, values: Sequence | None = None
) -> int:
    """Merges the files below ``limit`` bytes of each partition (of ``values``, default: all) that has two or more of
    them; larger files and partitions without small ones are neither read nor written. Returns the files replaced.

    The merged files are complete before the first old one goes. A job that dies in between is finished by the next
    write or :func:`finish_merge`; until then readers miss rows, but see none twice. The driver holds the names of
    the small files, as it does those of all files in any scan.
    """
    table = _whole(spark, path)
    columns = [partition] + ([BUCKET] if BUCKET in table.columns else [])
    finish_rewrite(spark, path, table.schema, columns)
    small = files.data_files(spark, path).filter(F.col("bytes") < limit)
    small = small.withColumn("folder", F.regexp_replace("file", "/[^/]+$", ""))
    if values is not None:
        folders = files.partition_values(spark, path, partition)
        wanted = [folders[str(v)] for v in values if str(v) in folders]
        inside = F.lit(False)
        for folder in wanted:
            inside = inside | F.concat("folder", F.lit("/")).startswith(files.plain(F.concat(F.lit(folder), F.lit("/"))))
        small = small.filter(inside)
    chosen = small.groupBy("folder").agg(F.collect_list("file").alias("names")).filter(F.size("names") > 1)
    names = [r.file for r in chosen.select(F.explode("names").alias("file")).collect()]
    if not names:
        return 0
    # Partition values as the folders spell them, so that the merged files land in the same folders.
    schema = StructType([StructField(f.name, StringType()) if f.name in columns else f for f in table.schema])
    rows = spark.read.schema(schema).option("basePath", path).parquet(*names)
    merged = f"{path}/{MERGED}"
    spark.createDataFrame([(n,) for n in names], "file string").write.mode("overwrite").parquet(f"{merged}/replaced")
    gathered(rows, columns).write.mode("overwrite").partitionBy(*columns).parquet(f"{merged}/files")
    finish_merge(spark, path)
    return len(names)


def finish_merge(spark: SparkSession, path: str) -> None:
    """Puts complete merged files in the place of those they replace, and drops incomplete ones. Harmless to repeat."""
    merged = f"{path}/{MERGED}"
    if not files.exists(spark, merged):
        return
    if files.exists(spark, f"{merged}/files/_SUCCESS"):
        for row in spark.read.schema("file string").parquet(f"{merged}/replaced").collect():
            files.drop_file(spark, row.file)
        files.move_files(spark, f"{merged}/files", path)
    files.drop_folder(spark, merged)


def retain(spark: SparkSession, path: str, cutoff: dt.date, partition: str = "dt") -> list[str]:
    """Drops the date partitions before ``cutoff``, as folders and without reading a row; the values dropped."""
    finish_merge(spark, path)
    found = files.partition_values(spark, path, partition)
    expired = sorted(v for v in found if v[:1].isdigit() and dt.date.fromisoformat(v) < cutoff)
    for value in expired:
        files.drop_folder(spark, found[value])
    return expired


# --- Change log and as-of reads -----------------------------------------------------------------------


def append_change(batch: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    """Adds a batch to an append-only change log, one folder per batch.

    The folder appears in one step and is never written again, so a repeated batch adds nothing, and a stream that
    reads the log sees each row once. ``run`` tells apart writers that count their batches from zero.
    """
    spark = batch.sparkSession
    folder = f"run={run}/batch_id={batch_id}" if run else f"batch_id={batch_id}"
    if files.exists(spark, f"{path}/{folder}"):
        return
    pending = f"{path}/_pending/{uuid.uuid4().hex}"
    batch.write.parquet(pending)
    if not files.move(spark, pending, f"{path}/{folder}"):
        files.drop_folder(spark, pending)


def as_of(log: DataFrame, keys: Sequence[str], batch_id: int) -> DataFrame:
    """The table as it stood after ``batch_id``: the latest change of each key; NULL-key rows all stay."""
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    seen = log.filter(F.col("batch_id") <= batch_id)
    latest = one_per_key(seen.filter(known), keys, [F.col("batch_id").desc()])
    return latest.unionByName(seen.filter(~known)).drop("batch_id")


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files gained columns over time; older rows get NULL. The bucket that a bucketed table's folders
    name belongs to the layout and is left out."""
    return _whole(spark, path).drop(BUCKET)
