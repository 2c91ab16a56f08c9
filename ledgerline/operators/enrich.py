"""Master-data enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(
    events: DataFrame, master: DataFrame, on: Sequence[tuple[str, str]], columns: Sequence[str]
) -> DataFrame:
    """Adds master-data columns to each event; events without a master row keep NULLs.

    ``master`` is unique on its key. No broadcast hint: Spark broadcasts it while it is under
    ``spark.sql.autoBroadcastJoinThreshold``, and beyond that AQE splits the partitions of hot event keys.
    """
    dim = master.select(*[F.col(right).alias(f"_{left}") for left, right in on], *columns)
    match = F.lit(True)
    for left, _ in on:
        match = match & (events[left] == dim[f"_{left}"])
    return events.join(dim, match, "left").select(*events.columns, *columns)


def enrich_stream(
    events: DataFrame,
    master: DataFrame,
    key: tuple[str, str],
    columns: Sequence[str],
    id_column: str,
    salts: int = 1,
) -> DataFrame:
    """Stream-static form of :func:`enrich`, where AQE cannot split hot keys.

    Spark broadcasts the master table while it is under ``spark.sql.autoBroadcastJoinThreshold``. For a larger one
    with hot keys ``salts`` above 1 spreads the events of a key over that many tasks by their own id, and repeats
    the master rows as often.
    """
    left, right = key
    dim = master.select(F.col(right).alias("_key"), *columns)
    if salts == 1:
        return events.join(dim, events[left] == dim["_key"], "left").select(*events.columns, *columns)
    dim = dim.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = events.withColumn("_salt", F.pmod(F.hash(id_column), F.lit(salts)))
    match = (salted[left] == dim["_key"]) & (salted["_salt"] == dim["_dim_salt"])
    return salted.join(dim, match, "left").select(*events.columns, *columns)
