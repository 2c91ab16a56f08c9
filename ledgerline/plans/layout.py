"""Layout of tables: files merged by size, rows clustered by several columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import tables as T
from ledgerline.operators.cluster import read_between, write_clustered
from ledgerline.plans import sql
from ledgerline.plans.registry import query
from ledgerline.plans.rows import silver_frame
from ledgerline.plans.tables import read
from ledgerline.schemas import AUTH_LOGS, TRANSACTIONS
from ledgerline.session import fresh_dir

DAYS = (dt.datetime(1996, 3, 1), dt.datetime(1996, 3, 31))
CUSTOMERS = (10, 25)


@query("compact_small_files", sql.shown(sql.silver(AUTH_LOGS)))
def compact_small_files(spark, sf_dir):
    """A table of one whole load and three later trickles; only the trickles' files are merged."""
    path = fresh_dir(spark, "silver")
    rows = silver_frame(spark, sf_dir, AUTH_LOGS)
    part = F.pmod(F.xxhash64(AUTH_LOGS.key), F.lit(20))
    T.append(rows.filter(part >= 3), path)
    for number in range(3):
        T.append(rows.filter(part == number), path)
    sizes = [r.bytes for r in T.files.data_files(spark, path).collect()]
    T.compact_small(spark, path, limit=sum(sizes) // len(sizes))
    return read(spark, path, AUTH_LOGS)


_FOUND = "SELECT transaction_id, customer_id, amount, \"timestamp\", '{0}' AS asked FROM ({1}) WHERE {2}"


@query(
    "clustered_ranges",
    _FOUND.format("days", sql.silver(TRANSACTIONS), f"\"timestamp\" BETWEEN TIMESTAMP '{DAYS[0]}' AND TIMESTAMP '{DAYS[1]}'")
    + " UNION ALL "
    + _FOUND.format("customers", sql.silver(TRANSACTIONS), f"customer_id BETWEEN {CUSTOMERS[0]} AND {CUSTOMERS[1]}"),
)
def clustered_ranges(spark, sf_dir):
    """Payments clustered by time and customer, read by a range of either."""
    path = fresh_dir(spark, "clustered")
    write_clustered(silver_frame(spark, sf_dir, TRANSACTIONS), path, ["timestamp", "customer_id"], parts=64)
    columns = ["transaction_id", "customer_id", "amount", "timestamp"]
    # Literals in UTC whatever the zone of the machine is.
    days = tuple(d.replace(tzinfo=dt.timezone.utc) for d in DAYS)
    by_day = read_between(spark, path, {"timestamp": days}).select(*columns, F.lit("days").alias("asked"))
    by_customer = read_between(spark, path, {"customer_id": CUSTOMERS}).select(*columns, F.lit("customers").alias("asked"))
    return by_day.unionByName(by_customer)
