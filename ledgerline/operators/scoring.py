"""Fraud model: training, exact ROC-AUC, promotion gate, scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import shared_root

FEATURES = ("amount_value", "amount_known", "hour", "geo_missing", "lat", "lon")
PROMOTION_AUC = 0.85


def fraud_features(silver: DataFrame) -> DataFrame:
    """Numeric features of a transaction, none of them NULL or NaN: an amount that is no number counts as 0 and as
    unknown. Works on batch and stream."""
    return silver.withColumns(
        {
            "hour": F.coalesce(F.hour("timestamp"), F.lit(-1)).cast("double"),
            "geo_missing": F.col("geo_lat").isNull().cast("double"),
            "lat": F.coalesce("geo_lat", F.lit(0.0)),
            "lon": F.coalesce("geo_lon", F.lit(0.0)),
            "amount_known": (F.col("amount").isNotNull() & ~F.isnan("amount")).cast("double"),
            "amount_value": F.coalesce(F.nanvl("amount", F.lit(0.0)), F.lit(0.0)),
        }
    )


def train_fraud_model(
    silver: DataFrame, features: Sequence[str] = FEATURES, iterations: int = 5, depth: int = 3, per_task: int = 250_000
) -> PipelineModel:
    """Boosted trees on all rows. The trees keep the rows of a task in memory and read them in every pass, so rows are
    dealt over tasks of about ``per_task`` rows where their files make larger ones."""
    rows = fraud_features(silver).select(*features, "is_fraud")
    needed = math.ceil(rows.count() / per_task)
    if needed > rows.sparkSession.sparkContext.defaultParallelism:
        rows = rows.repartition(needed)
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        GBTClassifier(featuresCol="features", labelCol="is_fraud", maxIter=iterations, maxDepth=depth, seed=11),
    ]
    return Pipeline(stages=stages).fit(rows)


def score(model: PipelineModel, silver: DataFrame) -> DataFrame:
    """Applies a fitted model; works on batch and stream."""
    return model.transform(fraud_features(silver)).select(
        "transaction_id", "dt", F.col("prediction").cast("int").alias("prediction"), "probability"
    )


def exact_auc(scored: DataFrame, score_column: str, label: str, per_range: int = 100_000) -> DataFrame:
    """``(positives, negatives, auc)``: the share of positive/negative pairs ranked right, ties counting half.

    Rows are first counted per distinct score, so ties never gather in one task; these counts are checkpointed, so
    the input is read once. Distinct scores are sorted into ranges of about ``per_range``, as many as that takes,
    ranked inside each range in parallel, and only one total per range is accumulated in order. NULL and NaN scores
    are left out.
    """
    per_score = (
        scored.filter(F.col(score_column).isNotNull() & ~F.isnan(F.col(score_column).cast("double")))
        .groupBy(F.col(score_column).alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n"))
    )
    shared_root(scored.sparkSession)
    per_score = per_score.checkpoint()
    ranges = max(1, math.ceil(per_score.count() / per_range))
    # Sorted partitions in order of the score: the partition's number is the range.
    ranged = per_score.repartitionByRange(ranges, "_score").withColumn("_range", F.spark_partition_id())
    below = Window.partitionBy("_range").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(38,0)"
    inside = F.coalesce(F.sum("_n").over(below), F.lit(0))
    # Twice the wins of a score's positives against the negatives of its own range.
    wins = F.col("_p").cast("decimal(19,0)") * (2 * inside + F.col("_n")).cast("decimal(19,0)")
    totals = (
        ranged.withColumn("_wins", wins)
        .groupBy("_range")
        .agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"), F.sum("_wins").cast(big).alias("_wins"))
    )
    # One row per range from here on.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    ranked = totals.withColumn(
        "_wins", F.col("_wins") + 2 * F.col("_p").cast("decimal(19,0)") * offset.cast("decimal(18,0)")
    )
    sums = ranked.agg(
        F.sum("_p").alias("positives"), F.sum("_n").alias("negatives"), F.sum("_wins").cast("double").alias("_wins")
    )
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return sums.select("positives", "negatives", F.when(pairs > 0, F.col("_wins") / pairs).alias("auc"))


def may_promote(auc: float | None, threshold: float = PROMOTION_AUC) -> bool:
    return auc is not None and auc >= threshold
