"""Tables clustered by several columns, and reads that leave out files by their columns' ranges.

A column's values are cut into ranges of about equal counts, the bits of the range numbers of all columns are
interleaved, and rows are ordered by the result. So each file is narrow in every column, not only in the first, and
its lowest and highest values, kept in a small table beside the files, tell most files apart from a filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import files

# Ranges of a column are two to this power.
BITS = 6
# Folder inside a table for the ranges of its files; readers of the table pass over it.
ZONES = "_zones"
# Leading bytes of a text that order it; a double holds them exactly.
_PREFIX = 6
_UNHASHED = ("map", "variant")


def _ordered(df: DataFrame, name: str) -> Column:
    """A number that orders as the column does; texts by their first bytes."""
    kind, column = dict(df.dtypes)[name], F.col(f"`{name}`")
    if kind == "string":
        head = F.hex(F.substring(F.encode(column, "UTF-8"), 1, _PREFIX))
        return F.conv(F.rpad(head, 2 * _PREFIX, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind == "timestamp_ntz":
        return column.cast("timestamp").cast("double")
    return column.cast("double")


def _range_number(value: Column, cuts: Sequence[float]) -> Column:
    """How many cuts lie at or below the value, by halving."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    upper = _range_number(value, cuts[middle + 1 :])
    return F.when(value < cuts[middle], _range_number(value, cuts[:middle])).otherwise(upper + (middle + 1))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The position of a row on the curve through all ranges of the columns.

    Cuts are estimated quantiles of all rows, from one pass over these columns. NULL belongs to the lowest range.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(_ordered(df, c), shares, 100 << bits).alias(f"c{i}") for i, c in enumerate(columns)])
    cuts = [row or [] for row in found.first()]
    out = F.lit(0).cast("long")
    for j, (name, own) in enumerate(zip(columns, cuts)):
        value = _ordered(df, name)
        number = F.when(value.isNull(), 0).otherwise(_range_number(value, own))
        for i in range(bits):
            bit = F.shiftright(number, i).bitwiseAND(1).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return out


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], parts: int | None = None, bits: int = BITS
) -> None:
    """Writes a table clustered by the columns, in ``parts`` files (default: as Spark sizes them), with its zones.

    A value that a third of all rows share is spread by the other columns, and rows equal in all of them by a hash of
    the whole row. The rows are read twice, the first time only these columns.
    """
    if len(columns) * bits > 62:
        raise ValueError("too many bits for one number")
    hashed = [f"`{n}`" for n, kind in df.dtypes if not kind.startswith(_UNHASHED)]
    keyed = df.select("*", interleaved(df, columns, bits).alias("_curve"), F.xxhash64(*hashed).alias("_spread"))
    keys = ["_curve", "_spread"]
    ranged = keyed.repartitionByRange(parts, *keys) if parts else keyed.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).drop(*keys).write.mode("errorifexists").parquet(path)
    refresh_zones(df.sparkSession, path, columns)


def _zones(spark: SparkSession, path: str) -> DataFrame | None:
    folder = f"{path}/{ZONES}"
    return spark.read.parquet(folder) if files.has_data(spark, folder) else None


def refresh_zones(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Adds the lowest and highest values of files that have none yet; only those files are read."""
    listed, known = files.data_files(spark, path).select("file"), _zones(spark, path)
    fresh = listed if known is None else listed.join(known, "file", "left_anti")
    names = [r.file for r in fresh.collect()]
    if not names:
        return
    rows = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*names)
    ranges = [F.struct(F.min(f"`{c}`").alias("low"), F.max(f"`{c}`").alias("high")).alias(c) for c in columns]
    found = rows.groupBy(files.plain(F.col("_metadata.file_path")).alias("file")).agg(*ranges)
    found.write.mode("append").parquet(f"{path}/{ZONES}")


def read_between(spark: SparkSession, path: str, bounds: Mapping[str, tuple]) -> DataFrame:
    """Rows whose columns lie within the bounds, both included; ``None`` leaves a side open.

    Files whose ranges lie outside are not opened. A file without a known range is read, so a table that was appended
    to since gives whole results too, and files that are gone play no part. A NULL lies within no bounds.
    """
    def within(low: Column, high: Column, name: str) -> Column:
        least, most = bounds[name]
        out = low.isNotNull()
        out = out if least is None else out & (high >= F.lit(least))
        return out if most is None else out & (low <= F.lit(most))

    def all_of(conditions) -> Column:
        return reduce(lambda a, b: a & b, conditions, F.lit(True))

    listed, known = files.data_files(spark, path).select("file"), _zones(spark, path)
    if known is not None:
        zoned = [c for c in bounds if c in known.columns]
        reached = all_of(within(F.col(f"`{c}`.low"), F.col(f"`{c}`.high"), c) for c in zoned)
        listed = listed.join(known.withColumn("_known", F.lit(True)), "file", "left")
        listed = listed.filter(F.col("_known").isNull() | reached)
    names = [r.file for r in listed.select("file").collect()]
    whole = spark.read.option("mergeSchema", True).parquet(path)
    rows = spark.read.schema(whole.schema).option("basePath", path).parquet(*names) if names else whole.limit(0)
    return rows.filter(all_of(within(F.col(f"`{c}`"), F.col(f"`{c}`"), c) for c in bounds))
