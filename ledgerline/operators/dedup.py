"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None, derived: Sequence[str] = ()
) -> DataFrame:
    """The first row of each key under ``order``; by default under all other columns, which makes it repeatable.
    Columns ``derived`` from others decide nothing and are left out of it, so a reader that does not want them does
    not have them computed and moved.

    ``row_number() = 1`` is planned with a partial group limit below the exchange: a map task sends at most
    one row per key, so a key with any number of copies never gathers in one task.
    """
    order = order or [F.col(c).asc_nulls_first() for c in df.columns if c not in keys and c not in derived]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def stream_one_per_key(df: DataFrame, keys: Sequence[str], salts: int = 0) -> DataFrame:
    """Streaming dedup: the first arrival per key over the life of the checkpoint.

    The keys hold no event-time column, so state is kept for every key ever seen. With ``salts`` a first
    round removes copies within (key, salt), so one endlessly repeated key is spread over that many tasks;
    the price is a second copy of the state.
    """
    if salts > 1:
        df = (
            df.withColumn("_salt", F.floor(F.rand(seed=17) * salts).cast("int"))
            .dropDuplicates([*keys, "_salt"])
            .drop("_salt")
        )
    return df.dropDuplicates(list(keys))


def stream_one_per_key_bounded(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Streaming dedup that forgets a key once the watermark passes it: copies further apart get through."""
    return df.dropDuplicatesWithinWatermark(list(keys))
