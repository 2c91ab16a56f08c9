"""Pseudonyms for personal identifiers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_pii(df: DataFrame, columns: Iterable[str], salt: str) -> DataFrame:
    """Replaces each column by the salted SHA-256 of its text; NULL stays NULL."""
    return df.withColumns({c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256) for c in columns})
