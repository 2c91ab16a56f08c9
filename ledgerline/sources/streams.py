"""Streaming sources: the message log and the append stream of a table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

ENVELOPE = "topic STRING, value BINARY"


def kafka_options(servers: str, topics: Iterable[str], starting_offsets: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
    }


def message_log(
    spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None, path: str | None = None
) -> DataFrame:
    """``(topic, value)`` messages. Any file format with these two columns can stand in for the log.

    ``options`` pass through, e.g. ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger`` to bound a micro-batch.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        reader = reader.schema(ENVELOPE)
    stream = reader.load(path) if path else reader.load()
    return stream.select("topic", "value")


def table_appends(
    spark: SparkSession, schema: StructType, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Files added to a parquet table, as a stream."""
    return spark.readStream.schema(schema).options(**(options or {})).parquet(path)


def change_log(
    spark: SparkSession, schema: StructType, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows as a job logged them, once each: the log's folders are never rewritten. The log may not exist yet when
    the stream starts only if its folder does."""
    logged = StructType([*schema.fields, StructField("run", StringType()), StructField("batch_id", LongType())])
    return table_appends(spark, logged, path, options).select(*schema.names)
