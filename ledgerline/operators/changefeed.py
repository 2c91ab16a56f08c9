"""What changed between two states of a table, read from its change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, BEFORE, AFTER, DELETE = "insert", "update_before", "update_after", "delete"


def change_feed(
    log: DataFrame, keys: Sequence[str], first: int, last: int, deleted: Column | None = None, order: str = "batch_id"
) -> DataFrame:
    """(change, columns) between the state after batch ``first`` and the one after batch ``last``.

    ``log`` holds every accepted row with the number of its batch; a later row replaces an earlier one of its key, and
    one for which ``deleted`` holds removes it. A key that comes is an ``insert``, one that goes a ``delete`` with its
    last row, one whose row differs an ``update_before`` and an ``update_after``. A key that changed and changed back,
    or was written again as it was, is no change. Rows with a NULL in the key match nothing: each that is new is an
    insert.

    One aggregate over the log and no join: both states of a key are maxima by batch number, which Spark takes before
    the shuffle, so a key written very often is one row a task. Several rows of a key in one batch: the largest counts.
    """
    columns = [c for c in log.columns if c != order]
    row = F.struct(*columns)
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    seen = log.filter(F.col(order) <= last).withColumn("_gone", gone).withColumn("_known", _all_known(keys))
    keyed = seen.filter("_known")
    entry = F.struct(F.col(order), F.col("_gone"), row.alias("row"))
    states = keyed.groupBy(*keys).agg(
        F.max(F.when(F.col(order) <= first, entry)).alias("_old"), F.max(entry).alias("_new")
    )
    old = F.when(~F.col("_old._gone"), F.col("_old.row"))
    new = F.when(~F.col("_new._gone"), F.col("_new.row"))
    states = states.select(old.alias("_old"), new.alias("_new")).filter(~F.col("_old").eqNullSafe(F.col("_new")))
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()

    def told(change: Column, state: str) -> Column:
        return F.struct(change.alias("change"), F.col(state).alias("row"))

    pair = F.array(
        told(F.when(both, BEFORE).otherwise(DELETE), "_old"), told(F.when(both, AFTER).otherwise(INSERT), "_new")
    )
    changes = states.select(F.explode(F.filter(pair, lambda c: c["row"].isNotNull())).alias("_c"))
    changes = changes.select("_c.change", "_c.row.*")
    unkeyed = seen.filter(~F.col("_known") & ~F.col("_gone") & (F.col(order) > first))
    return changes.unionByName(unkeyed.select(F.lit(INSERT).alias("change"), *columns))


def _all_known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def applied(state: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after the changes of a feed that begins at ``state``. NULL keys match nothing."""
    gone = feed.filter(F.col("change").isin(BEFORE, DELETE)).select(*keys)
    come = feed.filter(F.col("change").isin(INSERT, AFTER)).select(*state.columns)
    return state.join(gone, list(keys), "left_anti").select(*state.columns).unionByName(come)
