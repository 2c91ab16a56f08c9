"""Versioned master data, facts at their time, and training sets as of their labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import gold, known, versions
from ledgerline.operators.tables import read_merged
from ledgerline.plans import fixtures, sql
from ledgerline.plans.registry import query
from ledgerline.plans.rows import silver_frame
from ledgerline.schemas import TRANSACTIONS
from ledgerline.session import fresh_dir

TX = sql.silver(TRANSACTIONS)
# A customer's standing as the orders tell it. A third of the orders comes with a second batch, among them many that
# are older than what the first one told.
STANDING = ["o_orderpriority", "o_orderstatus"]
LATER = "o_orderkey % 3 = 0"
MAX_AGE_DAYS = 90

_CHANGES = (
    "SELECT CAST(o_custkey AS INTEGER) AS customer_id, o_orderpriority, o_orderstatus, o_orderdate AS valid_from "
    f"FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY {LATER} DESC, "
    "o_orderpriority DESC, o_orderstatus DESC) = 1"
)
_VERSIONS = (
    "SELECT *, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to " f"FROM ({_CHANGES})"
)


def standing_changes(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    at = F.col("o_orderdate").cast("timestamp").alias("o_orderdate")
    return orders.select(F.col("o_custkey").cast("int").alias("customer_id"), "o_orderkey", at, *STANDING)


def standing_table(spark, sf_dir):
    """The versions after two batches, the second of which was repeated."""
    path, changes = fresh_dir(spark, "versions"), standing_changes(spark, sf_dir)
    for batch in (f"NOT ({LATER})", LATER, LATER):
        versions.upsert_versions(changes.filter(batch), path, "customer_id", "o_orderdate", STANDING, buckets=8)
    return read_merged(spark, path)


@query("dim_customer_versions", _VERSIONS)
def dim_customer_versions(spark, sf_dir):
    return standing_table(spark, sf_dir).select("customer_id", *STANDING, "valid_from", "valid_to")


@query(
    "dim_customer_versions_merged",
    "SELECT customer_id, o_orderpriority, valid_from, lead(valid_from) OVER w AS valid_to FROM (SELECT customer_id, "
    "o_orderpriority, valid_from, lag(o_orderpriority) OVER (PARTITION BY customer_id ORDER BY valid_from) AS before "
    f"FROM ({_VERSIONS})) WHERE before IS DISTINCT FROM o_orderpriority "
    "WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)",
)
def dim_customer_versions_merged(spark, sf_dir):
    """One column's versions: neighbours that differ in the other only are one."""
    rows = versions.versions_of(standing_table(spark, sf_dir), "customer_id", "valid_from", STANDING)
    return versions.merged(rows, "customer_id", STANDING[:1])


@query(
    "fact_customer_version",
    "SELECT t.transaction_id, t.customer_id, t.\"timestamp\", v.o_orderpriority, v.o_orderstatus, v.valid_from, v.valid_to "
    f"FROM ({TX}) t ASOF LEFT JOIN ({_VERSIONS}) v ON t.customer_id = v.customer_id AND t.\"timestamp\" >= v.valid_from",
)
def fact_customer_version(spark, sf_dir):
    """Each payment with its customer's standing at that time."""
    # Read twice: for the days that versions are carried to, and to be joined.
    path, facts = fresh_dir(spark, "facts"), silver_frame(spark, sf_dir, TRANSACTIONS)
    facts = facts.select("transaction_id", "customer_id", "timestamp")
    facts.write.parquet(path)
    facts = spark.read.schema(facts.schema).parquet(path)
    return versions.valid_at(facts, standing_table(spark, sf_dir), ("customer_id", "customer_id"), "timestamp", STANDING)


_DAILY = (
    "SELECT customer_id, CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY AS known_at, count(*) AS n, "
    f"{sql.MONEY} AS total, max(amount) AS largest FROM ({TX}) WHERE dt IS NOT NULL GROUP BY customer_id, dt"
)
_FRESH = f'known_at >= "timestamp" - INTERVAL {MAX_AGE_DAYS} DAY'


@query(
    "training_set",
    f"WITH s AS ({TX}), d AS ({_DAILY}), v AS (SELECT customer_id, o_orderpriority, valid_from AS known_at FROM ({_CHANGES})), "
    "a AS (SELECT s.transaction_id, s.customer_id, s.\"timestamp\", s.is_fraud, d.n, d.total, d.largest, d.known_at "
    "FROM s ASOF LEFT JOIN d ON s.customer_id = d.customer_id AND s.\"timestamp\" > d.known_at), "
    f"b AS (SELECT * EXCLUDE (n, total, largest, known_at), CASE WHEN {_FRESH} THEN n END AS daily_n, "
    f"CASE WHEN {_FRESH} THEN total END AS daily_total, CASE WHEN {_FRESH} THEN largest END AS daily_largest FROM a), "
    "c AS (SELECT b.*, v.o_orderpriority, v.known_at FROM b ASOF LEFT JOIN v "
    "ON b.customer_id = v.customer_id AND b.\"timestamp\" > v.known_at) "
    f"SELECT * EXCLUDE (o_orderpriority, known_at), CASE WHEN {_FRESH} THEN o_orderpriority END AS standing_o_orderpriority FROM c",
)
def training_set(spark, sf_dir):
    """Each payment, labelled, with its customer's last full day before it and standing before it."""
    # Two sides use the rows: written once, they are not scanned, shuffled and sorted for each.
    path, silver = fresh_dir(spark, "silver"), silver_frame(spark, sf_dir, TRANSACTIONS)
    silver.write.parquet(path)
    silver = spark.read.schema(silver.schema).parquet(path)
    daily = gold.customer_daily(silver.filter(F.col("dt").isNotNull())).withColumn("known_at", F.date_add("dt", 1).cast("timestamp"))
    standing = versions.versions_of(
        standing_changes(spark, sf_dir), "customer_id", "o_orderdate", STANDING, F.expr(LATER).cast("int")
    ).withColumnRenamed("valid_from", "known_at")
    sources = {
        "daily": known.Source(daily, "customer_id", "known_at", ["n", "total", "largest"]),
        "standing": known.Source(standing, "customer_id", "known_at", STANDING[:1]),
    }
    labels = silver.select("transaction_id", "customer_id", "timestamp", "is_fraud")
    return known.known_before(labels, sources, "customer_id", "timestamp", MAX_AGE_DAYS * known.DAY)
