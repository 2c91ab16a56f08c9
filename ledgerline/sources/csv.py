"""Batch CSV datasets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.operators.parse import stamp_date
from ledgerline.operators.tables import append_or_create


@dataclass(frozen=True)
class CsvDataset:
    """A CSV file or folder and the table it is appended to."""

    path: str
    table: str
    schema: StructType | str | None = None


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header row, UTF-8. Without a schema the types are inferred, which costs a second full pass over the files."""
    reader = spark.read.option("header", True).option("encoding", "utf-8")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def ingest(spark: SparkSession, datasets: Iterable[CsvDataset], run_date: dt.date) -> dict[str, int]:
    """Appends every dataset to its table, stamped with the run date; rows written per table."""
    return {
        d.table: append_or_create(stamp_date(read_csv(spark, d.path, d.schema), run_date), d.table, partition_by="dt")
        for d in datasets
    }
