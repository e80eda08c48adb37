"""The corpus pipeline: quality rules, near copies, benchmark passages, mixing, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents its predecessor kept. All
but the last return the columns of ``documents``; the mix returns a document as often as it takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakesteward.llm import decontaminate, mixing, nearcopies, quality
from lakesteward.llm.queries import tokens_of
from lakesteward.llm.tables import table
from lakesteward.sources.session import scratch_path

# Near copies, alignments and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule keeps."""
    return quality.quality_filter(docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return nearcopies.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix, written and read back by key."""
    return tokens_of(docs)


STAGES = [
    ("quality rules", keep_good),
    ("near copies", keep_one_copy),
    ("benchmark decontamination", drop_benchmark),
    ("mixing", mix),
    ("token ids", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            path = scratch_path(spark, f"stage{place}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
