"""Named queries and, where there is one, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import DEFAULTS

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Zone-free output: timestamps as UTC wall time, dates as text."""
    shown = {"timestamp": lambda c: c.cast("timestamp_ntz"), "date": lambda c: c.cast("string")}
    return df.select(
        *[shown.get(kind, lambda c: c)(F.col(f"`{name}`")).alias(name) for name, kind in df.dtypes]
    )


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Registers a query under ``name``."""

    def register(run: Run) -> Run:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            zone = "spark.sql.session.timeZone"
            spark.conf.set(zone, DEFAULTS[zone])
            return present(run(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(in_utc, sql)
        return run

    return register
