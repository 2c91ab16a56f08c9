"""Message envelope → bronze rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import event_time
from ledgerline.schemas import EventStream

# What a JSON parser skips: a payload of nothing else has no record in it.
_JSON_BLANKS = " \t\r\n"


def _has_record(payload: Column) -> Column:
    """True exactly where ``from_json`` gives a struct (possibly of NULLs) and not NULL.

    Testing the text keeps the filter on the scan side and parses each payload once.
    """
    return payload.isNotNull() & (F.btrim(payload, F.lit(_JSON_BLANKS)) != "")


def payloads(envelope: DataFrame, stream: EventStream) -> DataFrame:
    """Texts of one topic that hold a record."""
    text = F.col("value").cast("string")
    return envelope.filter(F.col("topic") == stream.topic).filter(_has_record(text)).select(text.alias("payload"))


def parse_topic(envelope: DataFrame, stream: EventStream) -> DataFrame:
    """Wire columns of one topic. Malformed JSON becomes a row of NULLs, a badly typed field a NULL.

    The struct is flattened by ``inline`` rather than by ``data.*``: filters on single fields then stay above it,
    where a projection would let them be pushed below and parse the payload again for each.
    """
    parsed = F.from_json("payload", stream.wire, {"mode": "PERMISSIVE"})
    return payloads(envelope, stream).select(F.inline(F.array(parsed)))


def dead_letters(envelope: DataFrame, stream: EventStream) -> DataFrame:
    """Payloads of one topic in which no declared field could be read."""
    parsed = F.from_json("payload", stream.wire, {"mode": "PERMISSIVE"})
    # One comparison of the whole struct: testing the fields one by one would parse the payload once per field.
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.wire.fields])
    return (
        payloads(envelope, stream)
        .select("payload", parsed.alias("data"))
        .filter(F.col("data").eqNullSafe(nothing))
        .select(F.lit(stream.topic).alias("topic"), "payload")
    )


def with_event_date(df: DataFrame) -> DataFrame:
    """Types the event time and adds its calendar date, NULL where the time cannot be read."""
    typed = event_time(F.col("timestamp"))
    return df.withColumns({"timestamp": typed, "dt": F.to_date(typed)})


def to_bronze(envelope: DataFrame, stream: EventStream) -> DataFrame:
    return with_event_date(parse_topic(envelope, stream))


def stamp_date(df: DataFrame, run_date: dt.date) -> DataFrame:
    """Adds the ingest date unless the rows already carry a date."""
    return df if "dt" in df.columns else df.withColumn("dt", F.lit(run_date))
