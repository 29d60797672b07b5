"""The corpus pipeline: rules, line dedup, near dedup, mixing, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's `docs`. All but the last return the columns of documents.

An input without rows gives a result without rows. Rows that a stage keeps go on with their
columns as they came, but for the text that line dedup shortens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tellerlake.llm import line_dedup, mixing, near_dedup, pieces, quality_rules
from tellerlake.llm.shared import new_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.accepted(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages that occurred before."""
    return line_dedup.without_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return near_dedup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, source and pieces of every document."""
    rows = pieces.encoded(docs.select("doc_id", "source", "text"))
    return rows.select("doc_id", "source", *pieces.DERIVED)


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: SQL can state neither the near duplicates nor the segmentation; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return result
        path = new_path(spark, f"pipeline-{number}")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
