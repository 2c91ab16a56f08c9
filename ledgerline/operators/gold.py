"""Star schema over the silver tables. Natural keys throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import exact_sum


def date_key(date: Column) -> Column:
    """Date as the integer yyyymmdd."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def fact_transactions(silver: DataFrame) -> DataFrame:
    return silver.select(
        "transaction_id",
        date_key(F.col("dt")).alias("date_key"),
        "customer_id",
        "merchant",
        "amount",
        "is_fraud",
    )


def dim_date(silver: DataFrame) -> DataFrame:
    """One row per date that has events; weekdays count from Monday = 0."""
    dt = F.col("dt")
    weekday = F.weekday(dt)
    return (
        silver.select("dt")
        .dropna()
        .distinct()
        .select(
            date_key(dt).alias("date_key"),
            "dt",
            F.year(dt).alias("year"),
            F.quarter(dt).alias("quarter"),
            F.month(dt).alias("month"),
            F.dayofmonth(dt).alias("day"),
            weekday.alias("weekday"),
            F.when(weekday >= 5, 1).otherwise(0).alias("is_weekend"),
        )
    )


def dim_merchant(silver: DataFrame) -> DataFrame:
    return silver.groupBy("merchant").agg(
        F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"), F.count(F.lit(1)).alias("n")
    )


def dim_customer(silver: DataFrame) -> DataFrame:
    return silver.groupBy("customer_id").agg(
        F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"), F.count(F.lit(1)).alias("n")
    )


def customer_daily(silver: DataFrame) -> DataFrame:
    """Feature table: one row per customer and day."""
    return silver.groupBy("customer_id", "dt").agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum(F.col("amount")).alias("total"),
        F.max("amount").alias("largest"),
        F.sum("is_fraud").alias("frauds"),
    )
