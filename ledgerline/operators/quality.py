"""Checks to run before a write."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, nulls, total)``, one row per column, from a single pass."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in df.columns
    ]
    one_row = df.agg(F.array(*pairs).alias("pairs"), F.count(F.lit(1)).alias("total"))
    return one_row.select(F.explode("pairs").alias("p"), "total").select("p.column_name", "p.nulls", "total")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def schema_differences(df: DataFrame, expected: StructType) -> list[str]:
    """Missing, unexpected and differently typed columns; empty when the frame conforms. Reads no data."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    found = [f"missing {c}" for c in want if c not in have]
    found += [f"unexpected {c}" for c in have if c not in want]
    return found + [f"{c}: {have[c]}, not {want[c]}" for c in want if c in have and have[c] != want[c]]


@dataclass(frozen=True)
class QualityReport:
    schema: list[str]
    nulls: dict[str, int]
    duplicated_keys: int

    @property
    def passed(self) -> bool:
        return not self.schema and not any(self.nulls.values()) and not self.duplicated_keys


def quality_report(df: DataFrame, expected: StructType, required: Sequence[str], keys: Sequence[str]) -> QualityReport:
    """Schema, NULLs in required columns and repeated keys. Only counts reach the driver."""
    nulls = {r["column_name"]: r["nulls"] for r in null_counts(df.select(*required)).collect()}
    return QualityReport(schema_differences(df, expected), nulls, duplicate_keys(df, keys).count())


class Refused(ValueError):
    """A batch did not pass the checks; ``report`` says why."""

    def __init__(self, report: QualityReport):
        super().__init__(f"refused: {report}")
        self.report = report


def checked_write(
    df: DataFrame, write: Callable[[DataFrame], object], expected: StructType, required: Sequence[str], keys: Sequence[str]
) -> QualityReport:
    """Passes ``df`` on to ``write`` if it conforms to the schema, has no NULL in a required column and no repeated
    key; raises :class:`Refused` otherwise, with nothing written. The rows are computed once for checks and write."""
    differences = schema_differences(df, expected)
    if differences:
        raise Refused(QualityReport(differences, {}, 0))
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        report = quality_report(df, expected, required, keys)
        if not report.passed:
            raise Refused(report)
        write(df)
        return report
    finally:
        df.unpersist()
