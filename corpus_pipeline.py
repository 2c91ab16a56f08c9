"""From raw documents to packed sequences: each stage applies one operator of ``ledgerline.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import line_rules, near_dup, packing, passages, quality_model
from ledgerline.llm.common import ARROW_ROWS, small_batches, table
from ledgerline.session import fresh_dir

#: No stage but the last can be told in SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    small_batches(spark)
    return line_rules.filtered(docs, line_rules.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones; it is fitted to the whole table, as few bad ones come here."""
    small_batches(spark)
    whole, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_model.filtered(docs, quality_model.fit(whole, labels, "doc_id", "text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    small_batches(spark)
    gone = near_dup.near_copies(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; ``n_chars`` is that of the new text.

    Rows that repeat an id share the other columns of one of them.
    """
    small_batches(spark)
    held = passages.repeated(docs, with_text=True).select("doc_id", "text")
    rest = docs.drop("text").where("doc_id is not null").dropDuplicates(["doc_id"])
    named = held.join(rest, "doc_id")
    out = named.unionByName(docs.where("doc_id is null"))
    return out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    small_batches(spark)
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again by the next.

    A stage sets how many rows its Python tasks get at a time for the session; here that is set back at the end.
    """
    folder, docs, before = fresh_dir(spark, "pipeline"), table(spark, sf_dir, "documents"), spark.conf.get(ARROW_ROWS)
    try:
        for name, stage in STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return docs
