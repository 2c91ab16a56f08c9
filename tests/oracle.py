"""Runs named queries in Spark and their SQL in DuckDB and compares the rows.

    python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return ("f", repr(value))
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return (type(value).__name__, value.isoformat())
    return (type(value).__name__, str(value))


def compare(spark, con, name, query, sf_dir):
    """``None`` if the two agree in columns, types and rows, else what differs."""
    got = query.run(spark, sf_dir)
    names = sorted(got.columns)
    mine = sorted(tuple(normal(v) for v in row) for row in got.select(*[f"`{n}`" for n in names]).collect())
    if query.sql is None:
        return None if mine else "no rows"
    result = con.execute(query.sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return f"columns {names} / {sorted(theirs_names)}"
    order = [theirs_names.index(n) for n in names]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = sorted(tuple(normal(row[i]) for i in order) for row in result.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows / {len(theirs)} rows"
    same = {
        "string": "VARCHAR",
        "int": "INTEGER",
        "bigint": "BIGINT",
        "double": "DOUBLE",
        "timestamp_ntz": "TIMESTAMP",
        "boolean": "BOOLEAN",
    }
    for n, kind in got.dtypes:
        if same.get(kind, kind) != kinds[n] and kinds[n] not in ("STRING", "NUMBER", "DATETIME"):
            return f"type of {n}: {kind} / {kinds[n]}"
    if mine != theirs:
        bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
        return f"{len(bad)} rows differ, first {bad[0]}"
    return None if mine else "both empty"


def main():
    from pyspark.sql import SparkSession

    from ledgerline.plans import QUERIES

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name, query in QUERIES.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            problem = compare(spark, con, name, query, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
