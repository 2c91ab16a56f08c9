"""Payloads that drift away from the wire schema: unknown fields and unreadable values are kept, found and promoted.

A payload is parsed once, into its fields as VARIANT. What the wire schema can read becomes typed columns, as in
``parse``; everything else stays in the column ``extra`` under its own name. Bronze keeps ``extra`` as it came and
promotion happens on reading, so a column whose type widens later needs no rewrite of the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType, VariantType

from ledgerline.operators.parse import payloads, with_event_date
from ledgerline.schemas import EventStream

EXTRA = "extra"
VARIANTS = "MAP<STRING, VARIANT>"
# Columns that the library adds: a field of that name cannot become a column.
RESERVED = (EXTRA, "dt")
# Types of promoted columns; a column that held two of them is the one further right, or text beside BOOLEAN.
NUMBERS = ("BIGINT", "DOUBLE")


def open_schema(stream: EventStream) -> StructType:
    """The bronze columns and ``extra``."""
    return StructType([*stream.bronze.fields, StructField(EXTRA, MapType(StringType(), VariantType()))])


def _read(value: Column, kind: str) -> Column:
    """The variant as ``kind``, NULL where it is not one: neither 2.5 nor true is taken for a whole number."""
    kind = kind.lower()
    typed = F.try_variant_get(value, "$", kind)
    if kind in ("string", "boolean"):
        right = F.schema_of_variant(value) == "BOOLEAN" if kind == "boolean" else F.lit(True)
    else:
        right = F.schema_of_variant(value) != "BOOLEAN"
        if kind in ("int", "bigint"):
            # Compared as text of an exact decimal: a double does not tell neighbouring large numbers apart.
            right = right & F.try_variant_get(value, "$", "decimal(38,10)").eqNullSafe(typed.cast("decimal(38,10)"))
    return F.when(right, typed)


def _unread(value: Column, typed: Column) -> Column:
    """There is a value, JSON's null aside, but it could not be read."""
    return value.isNotNull() & ~F.is_variant_null(value) & typed.isNull()


def _told(rows: DataFrame, values: Mapping[str, Column], typed: Mapping[str, str]) -> DataFrame:
    """Adds ``_unread``, the names of the fields whose value could not be read into their column of ``typed``.

    By way of ``inline``, so that the names are there before a map is filtered by them: an expression inside the
    filter's lambda would be evaluated again, with all its readings, for each entry of the map.
    """
    unread = [F.when(_unread(values[n], F.col(f"`{c}`")), F.lit(n)) for n, c in typed.items()]
    names = F.array_compact(F.array(*unread)) if unread else F.array().cast("array<string>")
    return rows.select("*", F.inline(F.array(F.struct(names.alias("_unread")))))


def _left(fields: Column, known: list[str]) -> Column:
    """Fields that are not ``known``, and those known ones whose names are among ``_unread``; NULL if there are none."""
    rest = F.map_filter(fields, lambda name, _: ~name.isin(known) | F.array_contains("_unread", name))
    return F.when(F.size(rest) > 0, rest)


def parse_open(envelope: DataFrame, stream: EventStream) -> DataFrame:
    """Wire columns of one topic, and in ``extra`` the fields that the wire schema lacks or cannot read.

    A payload that is no JSON object is a row of NULLs (``parse.dead_letters`` keeps it). A JSON null is an absent
    value. Numbers in quotes are read as numbers. Of a field that an object names twice the first counts.
    """
    fields = F.from_json("payload", VARIANTS)
    rows = payloads(envelope, stream).select(F.inline(F.array(F.struct(fields.alias("_fields")))))
    values = {f.name: F.col("_fields")[f.name] for f in stream.wire.fields}
    typed = [_read(values[f.name], f.dataType.simpleString()).alias(f.name) for f in stream.wire.fields]
    rows = _told(rows.select("_fields", *typed), values, {n: n for n in values})
    return rows.select(*stream.wire.names, _left(F.col("_fields"), stream.wire.names).alias(EXTRA))


def to_bronze_open(envelope: DataFrame, stream: EventStream) -> DataFrame:
    rows = with_event_date(parse_open(envelope, stream))
    return rows.select(*open_schema(stream).names)


def promoted_type(kind: Column) -> Column:
    """Column type for the common type of a field's values: mixed kinds, objects and arrays are text, a field that
    was always null has none."""
    return (
        F.when(kind == "VOID", F.lit(None).cast("string"))
        .when(kind == "BOOLEAN", "BOOLEAN")
        .when(kind.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), "BIGINT")
        .when(kind.startswith("DECIMAL") | kind.isin("FLOAT", "DOUBLE"), "DOUBLE")
        .otherwise("STRING")
    )


def found_fields(rows: DataFrame) -> DataFrame:
    """(field, n, nulls, column_type) of all that ``extra`` holds: one row a field, merged in the map tasks first."""
    held = rows.select(F.explode(EXTRA).alias("field", "value"))
    return held.groupBy("field").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.is_variant_null("value")).alias("nulls"),
        promoted_type(F.schema_of_variant_agg("value")).alias("column_type"),
    )


def promotions(rows: DataFrame, least_share: float) -> dict[str, str]:
    """Column types of the fields that at least ``least_share`` of all rows have. Their number is bounded by the
    fields of a row over that share, however many names there are, so they come to the driver."""
    if not 0 < least_share <= 1:
        raise ValueError("the share lies above 0 and is at most 1")
    total = rows.count()
    usual = found_fields(rows).filter(F.col("column_type").isNotNull() & (F.col("n") >= least_share * total))
    return {r.field: r.column_type for r in usual.select("field", "column_type").collect()}


def wider(one: str, other: str) -> str:
    """The type that holds values of both."""
    if one == other:
        return one
    return "DOUBLE" if one in NUMBERS and other in NUMBERS else "STRING"


def promote(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Fields of ``extra`` as columns of the given types, behind the columns that are there.

    A column that exists already, from the wire or from an earlier promotion, is cast and takes the values that it
    could not read before; its type must be wide enough, as by :func:`wider`. What a type cannot hold stays in
    ``extra``, so nothing is lost by a type that turns out too narrow.
    """
    lowered = [c.lower() for c in columns]
    here = {c.lower(): c for c in rows.columns}
    odd = [c for c in columns if c.lower() in RESERVED or lowered.count(c.lower()) > 1 or here.get(c.lower(), c) != c]
    if odd:
        raise ValueError(f"names are taken or differ in case only: {sorted(odd)}")
    values = {name: F.col(EXTRA)[name] for name in columns}
    typed = {name: f"_typed_{i}" for i, name in enumerate(columns)}
    read = [_read(values[name], kind).alias(typed[name]) for name, kind in columns.items()]
    read = _told(rows.select("*", *read), values, typed)
    kept = {c: F.col(f"`{c}`") for c in rows.columns if c != EXTRA}
    for name, kind in columns.items():
        value = F.col(typed[name])
        kept[name] = F.coalesce(kept[name].cast(kind), value) if name in kept else value
    left = _left(F.col(EXTRA), list(columns)) if columns else F.col(EXTRA)
    return read.select(*[value.alias(name) for name, value in kept.items()], left.alias(EXTRA))
