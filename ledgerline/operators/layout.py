"""How rows are laid out over tasks and files before a partitioned write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def planned_by(session: SparkSession | None, df: DataFrame) -> DataFrame:
    """The same rows, planned with the settings of ``session``. A micro-batch comes with a session of its own in
    which adaptive execution is off."""
    if session is None or session is df.sparkSession:
        return df
    return session.createDataFrame([], df.schema).unionByName(df)


def gathered(df: DataFrame, columns: Sequence[str], session: SparkSession | None = None) -> DataFrame:
    """Brings the rows of one partition together, so that few tasks write into it.

    Spark splits large partitions and merges small ones by their bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so a day with a third of all rows is written by a third
    of the tasks. Without adaptive execution it is a plain repartition.
    """
    return planned_by(session, df).hint("rebalance", *columns)
