"""Writes and maintenance: each query fills tables in a fresh shared folder and returns what it reads back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ledgerline.operators import tables as T
from ledgerline.operators.clean import clean
from ledgerline.operators.dedup import one_per_key
from ledgerline.operators.parse import with_event_date
from ledgerline.operators.quality import Refused, checked_write
from ledgerline.plans import fixtures, sql
from ledgerline.plans.registry import query
from ledgerline.plans.rows import RUN_DATE, silver_frame
from ledgerline.schemas import AUTH_LOGS, SYSTEM_LOGS, TRANSACTIONS
from ledgerline.session import fresh_dir
from ledgerline.sources.csv import CsvDataset, ingest

CUTOFF = dt.date(2024, 1, 16)


def _fresh_database(spark, label):
    """An empty catalog namespace in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    T.create_namespaces(spark, fresh_dir(spark, label), [name])
    return name


def silver_batches(spark, sf_dir, stream, whole=False):
    """Two cleaned micro-batches, the second with new keys and with changed copies of keys of the first."""
    return [one_per_key(clean(b, stream), stream.keys) for b in fixtures.two_batches(spark, sf_dir, stream, whole)]


def read(spark, path, stream):
    return spark.read.schema(stream.silver).parquet(path)


def upserted(spark, sf_dir, stream, whole=False):
    path = fresh_dir(spark, "silver")
    for batch in silver_batches(spark, sf_dir, stream, whole):
        T.upsert(batch, path, stream.keys)
    return path


# --- Batch ingest and catalog tables ------------------------------------------------------------------

_DATED = f"SELECT *, CAST({sql.TS} AS DATE) AS d FROM ({fixtures.raw_sql(AUTH_LOGS)})"
_PER_DATE = (
    "SELECT CAST(d AS VARCHAR) AS dt, count(*) AS n, count(DISTINCT event_id) AS events, "
    "count(*) FILTER (WHERE result = 'failure') AS failures FROM ({rows}) GROUP BY d"
)


def _per_date(df):
    return df.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("event_id").alias("events"),
        F.count_if(F.col("result") == "failure").alias("failures"),
    )


@query("csv_ingest", f"SELECT *, '{RUN_DATE}' AS dt FROM supplier UNION ALL SELECT *, '{RUN_DATE}' AS dt FROM supplier")
def csv_ingest(spark, sf_dir):
    """Two datasets from CSV with inferred types; read back in the types of the source."""
    suppliers = fixtures.table(spark, sf_dir, "supplier")
    path, database = fresh_dir(spark, "csv"), _fresh_database(spark, "ingest")
    suppliers.write.option("header", True).csv(path)
    datasets = [CsvDataset(path, f"{database}.{name}") for name in ("suppliers_a", "suppliers_b")]
    ingest(spark, datasets, RUN_DATE)
    types = {f.name: F.col(f.name).cast(f.dataType) for f in suppliers.schema.fields}
    first, second = (spark.table(d.table).withColumns(types) for d in datasets)
    return first.unionByName(second)


def _halves(spark, sf_dir):
    rows = with_event_date(fixtures.raw(spark, sf_dir, AUTH_LOGS))
    return rows.filter("action = 'login'"), rows.filter("action <> 'login'")


@query("bronze_append", _PER_DATE.format(rows=_DATED))
def bronze_append(spark, sf_dir):
    path = fresh_dir(spark, "bronze")
    for half in _halves(spark, sf_dir):
        T.append(half, path)
    return _per_date(spark.read.schema(AUTH_LOGS.bronze).parquet(path))


@query("append_or_create", _PER_DATE.format(rows=_DATED))
def append_or_create(spark, sf_dir):
    """The first call creates the table, the second appends to it."""
    table = f"{_fresh_database(spark, 'bronze')}.auth_logs"
    for half in _halves(spark, sf_dir):
        T.append_or_create(half, table, partition_by="dt")
    return _per_date(spark.table(table))


@query("table_replace", _PER_DATE.format(rows=f"SELECT * FROM ({_DATED}) WHERE action <> 'login'"))
def table_replace(spark, sf_dir):
    """The second half replaces the first."""
    table = f"{_fresh_database(spark, 'bronze')}.auth_logs"
    for half in _halves(spark, sf_dir):
        T.replace_table(half, table, partition_by="dt")
    return _per_date(spark.table(table))


@query(
    "bronze_partition_counts",
    f"SELECT CAST(d AS VARCHAR) AS dt, count(*) AS n FROM ({_DATED}) GROUP BY d",
)
def bronze_partition_counts(spark, sf_dir):
    """Answered from partition values and file footers."""
    path = fresh_dir(spark, "bronze")
    T.append(with_event_date(fixtures.raw(spark, sf_dir, AUTH_LOGS)), path)
    return spark.read.schema(AUTH_LOGS.bronze).parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


# --- Keyed upsert -------------------------------------------------------------------------------------


def _final(stream, whole=False):
    return sql.shown(sql.upserted(stream, whole), "* EXCLUDE (b) REPLACE (CAST(dt AS VARCHAR) AS dt)")


def _register_upsert(name, stream, whole=False):
    @query(name, _final(stream, whole))
    def run(spark, sf_dir):
        return read(spark, upserted(spark, sf_dir, stream, whole), stream)


_register_upsert("silver_upsert_transactions", TRANSACTIONS, whole=True)
_register_upsert("silver_upsert_auth", AUTH_LOGS)
_register_upsert("silver_upsert_system", SYSTEM_LOGS)


def _keys_by_batch(stream, matched):
    """Keys of the second batch that the first one holds, or does not hold."""
    first, second = (sql.silver(stream, rows) for rows in fixtures.two_batches_sql(stream))
    operator = "IN" if matched else "NOT IN"
    return (
        f"SELECT log_id, message, CAST(dt AS VARCHAR) AS dt FROM ({second}) "
        f"WHERE (log_id, dt) {operator} (SELECT (log_id, dt) FROM ({first}))"
    )


def _against_first(spark, sf_dir, how):
    stream = SYSTEM_LOGS
    first, _ = silver_batches(spark, sf_dir, stream)
    after = read(spark, upserted(spark, sf_dir, stream), stream)
    changed = after.join(first.select(*stream.keys, F.col("message").alias("_old")), stream.keys, "left")
    rows = changed.filter("_old IS NOT NULL AND message <> _old" if how == "matched" else "_old IS NULL")
    return rows.select("log_id", "message", "dt")


@query("upsert_matched", _keys_by_batch(SYSTEM_LOGS, True))
def upsert_matched(spark, sf_dir):
    """Rows that the second batch updated."""
    return _against_first(spark, sf_dir, "matched")


@query("upsert_not_matched", _keys_by_batch(SYSTEM_LOGS, False))
def upsert_not_matched(spark, sf_dir):
    """Rows that the second batch inserted."""
    return _against_first(spark, sf_dir, "not matched")


@query("upsert_idempotent", _final(SYSTEM_LOGS))
def upsert_idempotent(spark, sf_dir):
    """The second batch runs twice."""
    stream = SYSTEM_LOGS
    path = upserted(spark, sf_dir, stream)
    _, second = silver_batches(spark, sf_dir, stream)
    T.upsert(second, path, stream.keys)
    return read(spark, path, stream)


@query("empty_batch_noop", sql.shown(sql.silver(SYSTEM_LOGS)))
def empty_batch_noop(spark, sf_dir):
    """A batch that cleaning leaves empty does not touch the table."""
    stream = SYSTEM_LOGS
    path = fresh_dir(spark, "silver")
    rows = silver_frame(spark, sf_dir, stream)
    T.upsert(rows, path, stream.keys)
    T.upsert(rows.filter("log_level > 4"), path, stream.keys)
    return read(spark, path, stream)


# --- Maintenance --------------------------------------------------------------------------------------


def _fragmented(spark, sf_dir, stream):
    """A silver table written as many small appends would leave it."""
    path = fresh_dir(spark, "silver")
    rows = silver_frame(spark, sf_dir, stream)
    T.append(rows.repartition(8, stream.key), path)
    return path


@query("compact_same_rows", sql.shown(sql.silver(AUTH_LOGS)))
def compact_same_rows(spark, sf_dir):
    path = _fragmented(spark, sf_dir, AUTH_LOGS)
    T.compact(spark, path)
    return read(spark, path, AUTH_LOGS)


@query("retention", sql.shown(f"SELECT * FROM ({sql.silver(AUTH_LOGS)}) WHERE dt >= DATE '{CUTOFF}' OR dt IS NULL"))
def retention(spark, sf_dir):
    path = fresh_dir(spark, "silver")
    T.upsert(silver_frame(spark, sf_dir, AUTH_LOGS), path, AUTH_LOGS.keys)
    T.retain(spark, path, CUTOFF)
    return read(spark, path, AUTH_LOGS)


# --- History ------------------------------------------------------------------------------------------


@query("asof_batch", _final(TRANSACTIONS))
def asof_batch(spark, sf_dir):
    """Three batches are logged, the table is read as of the second."""
    stream = TRANSACTIONS
    path = fresh_dir(spark, "changes")
    first, second = silver_batches(spark, sf_dir, stream)
    third = second.withColumn("amount", F.col("amount") + 1000)
    for number, batch in enumerate((first, second, third), start=1):
        T.append_change(batch, path, number)
    return T.as_of(spark.read.parquet(path), stream.keys, 2)


@query(
    "schema_evolution_add",
    "SELECT log_id, severity, message, "
    "CASE WHEN severity NOT IN ('INFO', 'DEBUG') THEN component END AS component "
    f"FROM ({fixtures.raw_sql(SYSTEM_LOGS)})",
)
def schema_evolution_add(spark, sf_dir):
    """Older files lack a column that newer files have."""
    path = fresh_dir(spark, "evolving")
    rows = fixtures.raw(spark, sf_dir, SYSTEM_LOGS).select("log_id", "severity", "message", "component")
    early = F.col("severity").isin("INFO", "DEBUG")
    rows.filter(early).drop("component").write.mode("append").parquet(path)
    rows.filter(~early).write.mode("append").parquet(path)
    return T.read_merged(spark, path)


@query(
    "compact_evolved",
    "SELECT log_id, severity, message, CAST(CAST(\"timestamp\" AS DATE) AS VARCHAR) AS dt, "
    "CASE WHEN severity NOT IN ('INFO', 'DEBUG') THEN component END AS component "
    f"FROM ({fixtures.raw_sql(SYSTEM_LOGS)})",
)
def compact_evolved(spark, sf_dir):
    """A table that gained a column keeps it through an upsert that changes nothing and through compaction."""
    path = fresh_dir(spark, "evolving")
    rows = with_event_date(fixtures.raw(spark, sf_dir, SYSTEM_LOGS))
    rows = rows.select("log_id", "severity", "message", "component", "dt")
    early = F.col("severity").isin("INFO", "DEBUG")
    T.upsert(rows.filter(early).drop("component"), path, SYSTEM_LOGS.keys)
    T.upsert(rows.filter(~early), path, SYSTEM_LOGS.keys, widen=True)
    T.upsert(rows.filter(~early & F.col("log_id").endswith("7")), path, SYSTEM_LOGS.keys)
    T.compact(spark, path)
    return spark.read.parquet(path)


@query(
    "gated_upsert",
    _final(SYSTEM_LOGS)
    + " UNION ALL BY NAME SELECT 'refused: ' || count(*) AS log_id FROM ("
    + f"SELECT * FROM ({fixtures.raw_sql(SYSTEM_LOGS)}) WHERE message IS NULL)",
)
def gated_upsert(spark, sf_dir):
    """Silver batches pass the checks and are written; the raw rows, some of them without a message, are refused
    as a whole and only their count is reported."""
    stream = SYSTEM_LOGS
    path = fresh_dir(spark, "silver")

    def write(rows):
        T.upsert(rows, path, stream.keys)

    for batch in silver_batches(spark, sf_dir, stream):
        checked_write(batch, write, batch.schema, ["log_id", "component"], stream.keys)
    raw = with_event_date(fixtures.raw(spark, sf_dir, stream)).select("log_id", "message", "dt")
    try:
        checked_write(raw, write, raw.schema, ["message"], stream.keys)
        refused = 0
    except Refused as error:
        refused = error.report.nulls["message"]
    note = spark.range(1).select(F.lit(f"refused: {refused}").alias("log_id"))
    return read(spark, path, stream).unionByName(note, allowMissingColumns=True)
