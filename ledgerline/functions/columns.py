"""Column derivations. All are built-in expressions and none fails on dirty input, also with ANSI mode on."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import schemas


def event_time(column: Column) -> Column:
    """Timestamp from ISO text (or from any timestamp type); NULL where it cannot be read."""
    return column.try_cast("timestamp")


def event_date(column: Column) -> Column:
    return F.to_date(event_time(column))


def latitude(geo: Column) -> Column:
    """First half of ``"lat,lon"``."""
    return F.regexp_extract(geo, schemas.LATITUDE_PATTERN, 1).try_cast("double")


def longitude(geo: Column) -> Column:
    """Second half of ``"lat,lon"``; the upstream pattern wants at least two digits."""
    return F.regexp_extract(geo, schemas.LONGITUDE_PATTERN, 1).try_cast("double")


def positive(amount: Column) -> Column:
    """The amount if above zero, else NULL. NaN sorts above all numbers and stays."""
    return F.when(amount > 0, amount)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def one_of(column: Column, vocabulary: Iterable[str], default: str = schemas.UNKNOWN) -> Column:
    """Closed vocabulary: values outside it, and NULL, become ``default``."""
    return F.when(column.isin(*vocabulary), column).otherwise(default)


def looks_like_ipv4(column: Column) -> Column:
    """Shape only: four groups of one to three digits."""
    return column.rlike(schemas.IPV4_PATTERN)


def ipv4_or_null(column: Column) -> Column:
    return F.when(looks_like_ipv4(column), column)


def is_suspicious(result: Column, ip_address: Column) -> Column:
    """A failure reported from a well-formed address."""
    return flag(result.contains("failure") & looks_like_ipv4(ip_address))


def severity_level(
    severity: Column,
    levels: Mapping[str, int] = schemas.SEVERITY_LEVELS,
    default: int = schemas.SEVERITY_DEFAULT,
) -> Column:
    """Ordinal of a severity name."""
    level = F.lit(default)
    for name, value in levels.items():
        level = F.when(severity == name, value).otherwise(level)
    return level


def exact_sum(column: Column) -> Column:
    """Sum of a money column over decimals, so that the result does not depend on the order of rows.

    Amounts that are no number of at most 36 digits before the point (NaN, infinities) are left out, like NULL; a
    sum that is too large is NULL.
    """
    return F.try_sum(column.try_cast("decimal(38,2)")).cast("double")
