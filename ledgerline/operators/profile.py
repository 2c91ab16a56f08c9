"""Data quality over time: a profile of every day, kept as sketches that merge, and a gate against drift.

A day is read once. Its counts, extremes and sketches (HyperLogLog for distinct values, KLL for quantiles) are a few
kilobytes per column; any range of days is profiled by merging them. Distinct counts are off by about 1.04 divided
by the square root of two to the power ``LOG_BUCKETS`` (1.6 %, one standard deviation), the rank of a quantile by
about 1.65 % at ``KLL_K``; merging adds no error to either.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerline.operators import tables
from ledgerline.sources import files

LOG_BUCKETS, KLL_K = 12, 200
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NumericType)


def daily_profiles(df: DataFrame, columns: Sequence[str], day: str = "dt") -> DataFrame:
    """(day, column_name, n, nulls, low, high, distinct_sketch, quantile_sketch), one row per day and column.

    All columns of a day come from one pass. NaN counts as a value, but not in extremes and quantiles.
    """

    def one(column: str) -> Column:
        value = F.col(column)
        number = F.lit(None).cast("double")
        if _numeric(df, column):
            number = F.when(~F.isnan(value.cast("double")), value.cast("double"))
        return F.struct(
            F.lit(column).alias("column_name"),
            F.count_if(value.isNull()).alias("nulls"),
            F.min(number).alias("low"),
            F.max(number).alias("high"),
            F.hll_sketch_agg(value.cast("string"), LOG_BUCKETS).alias("distinct_sketch"),
            F.kll_sketch_agg_double(number, KLL_K).alias("quantile_sketch"),
        )

    per_day = df.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.array(*[one(c) for c in columns]).alias("_all"))
    return per_day.select(day, "n", F.explode("_all").alias("_c")).select(
        day, "_c.column_name", "n", "_c.nulls", "_c.low", "_c.high", "_c.distinct_sketch", "_c.quantile_sketch"
    )


def profile_new_days(
    spark: SparkSession,
    path: str,
    profiles_path: str,
    columns: Sequence[str],
    again: Sequence[dt.date] = (),
    day: str = "dt",
) -> list[str]:
    """Profiles the days of the table at ``path`` that have no profile yet, and those of ``again``; the days read.

    Only their partitions are scanned. A day's profile is one partition beside the others and replaces an older one.
    """
    have, done = files.partition_values(spark, path, day), files.partition_values(spark, profiles_path, day)
    wanted = {str(d) for d in again}
    fresh = sorted(v for v in have if v[:1].isdigit() and (v not in done or v in wanted))
    if fresh:
        days = tables.read_merged(spark, path).filter(F.col(day).isin([dt.date.fromisoformat(v) for v in fresh]))
        tables.overwrite_partitions(daily_profiles(days, columns, day), profiles_path, day)
    return fresh


def merged_profile(profiles: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(by, column_name, n, nulls, low, high, distinct, distinct_a_day, quantiles) over all given days, from their
    profiles alone.

    ``distinct_a_day`` is the mean of the days' own numbers of distinct values. ``quantiles`` are NULL for a column
    without numbers.
    """
    out = profiles.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        F.avg(F.hll_sketch_estimate("distinct_sketch")).alias("distinct_a_day"),
        F.kll_merge_agg_double("quantile_sketch").alias("_kll"),
    )
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    at = F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("_kll", asked))
    shown = ("column_name", "n", "nulls", "low", "high", "distinct", "distinct_a_day")
    return out.select(*by, *shown, at.alias("quantiles"))


@dataclass(frozen=True)
class Limits:
    """How far a range of days may lie from its baseline before it counts as drift."""

    null_share: float = 0.02
    distinct_share: float = 0.5
    quantile_shift: float = 0.25


def drift(current: DataFrame, baseline: DataFrame, limits: Limits = Limits(), quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(column_name, reason, was, now) for every column that drifted, from two merged profiles.

    Reasons: ``nulls``, the share of NULLs rose or fell by more than ``null_share``; ``distinct``, the distinct
    values of a day changed by more than ``distinct_share`` of what they were; ``q<p>``, a quantile moved by more
    than ``quantile_shift`` of the baseline's distance between its outer quantiles; ``missing``, no value is left.
    """
    old = baseline.select("column_name", *[F.col(c).alias(f"_{c}") for c in baseline.columns if c != "column_name"])
    both = current.join(old, "column_name")

    def share(top: str, of: Column) -> Column:
        return F.when(of > 0, F.col(top) / of)

    null_now, null_was = share("nulls", F.col("n")), share("_nulls", F.col("_n"))
    some_now, some_was = F.col("n") - F.col("nulls"), F.col("_n") - F.col("_nulls")
    # By day, as a longer range has more distinct values.
    many_now, many_was = F.col("distinct_a_day"), F.col("_distinct_a_day")
    wide = F.element_at("_quantiles", -1) - F.element_at("_quantiles", 1)

    def told(reason: str, was: Column, now: Column, bad: Column) -> Column:
        row = F.struct(F.lit(reason).alias("reason"), was.cast("double").alias("was"), now.cast("double").alias("now"))
        return F.when(F.coalesce(bad, F.lit(False)), row)

    found = [
        told("missing", some_was, some_now, (some_was > 0) & (some_now == 0)),
        told("nulls", null_was, null_now, F.abs(null_now - null_was) > limits.null_share),
        told("distinct", many_was, many_now, F.abs(many_now - many_was) > limits.distinct_share * many_was),
    ]
    for i, q in enumerate(quantiles):
        was, now = F.element_at("_quantiles", i + 1), F.element_at("quantiles", i + 1)
        found.append(told(f"q{q:g}", was, now, F.abs(now - was) > limits.quantile_shift * wide))
    reasons = F.filter(F.array(*found), lambda r: r.isNotNull())
    return both.select("column_name", F.explode(reasons).alias("r")).select("column_name", "r.*")


class Drifted(ValueError):
    """New days do not look like the days before; ``reasons`` says where."""

    def __init__(self, reasons: list):
        super().__init__(f"drift: {reasons}")
        self.reasons = reasons


@dataclass(frozen=True)
class Gate:
    """Lets a batch pass if its profile is close to that of the last days."""

    profiles_path: str
    columns: Sequence[str]
    days: int = 28
    limits: Limits = field(default_factory=Limits)

    def check(self, batch: DataFrame, until: dt.date, day: str = "dt") -> None:
        """Raises :class:`Drifted` if ``batch`` differs from the profiled days of the four weeks (``days``) before
        ``until``. Without such days everything passes. Of the table itself nothing is read."""
        spark = batch.sparkSession
        if not files.has_data(spark, self.profiles_path):
            return
        kept = spark.read.parquet(self.profiles_path).withColumn(day, F.col(day).cast("date"))
        past = kept.filter((F.col(day) >= until - dt.timedelta(days=self.days)) & (F.col(day) < until))
        now = merged_profile(daily_profiles(batch, self.columns, day))
        reasons = [tuple(r) for r in drift(now, merged_profile(past), self.limits).collect()]
        if reasons:
            raise Drifted(sorted(reasons))
