"""Folder-level helpers on whatever file system the session's paths live on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder exists and holds at least one table file or partition."""
    fs, folder = _resolve(spark, path)
    if not fs.exists(folder):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder))


def partition_values(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Value → folder of each partition of the table at ``path``."""
    fs, folder = _resolve(spark, path)
    if not fs.exists(folder):
        return {}
    prefix = f"{column}="
    found = ((s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(folder))
    return {name[len(prefix) :]: full for name, full in found if name.startswith(prefix)}


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _resolve(spark, path)
    fs.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a folder, one step on file systems that can; false if the target is there already."""
    fs, old = _resolve(spark, source)
    _, new = _resolve(spark, target)
    if fs.exists(new):
        return False
    fs.mkdirs(new.getParent())
    return fs.rename(old, new)


def replace_folders(spark: SparkSession, source: str, target: str, depth: int) -> None:
    """Puts the folders ``depth`` levels below ``source`` in the place of those that ``target`` has there. Harmless to
    repeat: a folder that has been moved is not met again."""
    fs, old = _resolve(spark, source)
    if depth:
        names = [s.getPath().getName() for s in fs.listStatus(old) if s.isDirectory()]
        for name in names:
            if not name.startswith(("_", ".")):
                replace_folders(spark, f"{source}/{name}", f"{target}/{name}", depth - 1)
        return
    _, new = _resolve(spark, target)
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that appears in one step; one that is there already stays."""
    fs, target = _resolve(spark, path)
    if fs.exists(target):
        return
    _, pending = _resolve(spark, f"{target.getParent()}/_{target.getName()}")
    out = fs.create(pending, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(pending, target):
        fs.delete(pending, False)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes) of every parquet file of the table at ``path``; the files are not opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return listed.load(path).select(plain(F.col("path")).alias("file"), F.col("length").alias("bytes"))


def plain(path: Column) -> Column:
    """One spelling of a file's address, whichever part of Spark names it."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def drop_file(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, False)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Moves the parquet files below ``source`` to the same places below ``target``. Harmless to repeat."""
    fs, top = _resolve(spark, source)
    root = fs.makeQualified(top).toString()
    found = fs.listFiles(top, True)
    while found.hasNext():
        old = found.next().getPath()
        if old.getName().endswith(".parquet"):
            _, new = _resolve(spark, f"{target}/{old.toString()[len(root) + 1 :]}")
            fs.mkdirs(new.getParent())
            fs.rename(old, new)
