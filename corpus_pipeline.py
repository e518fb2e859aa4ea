"""The text pipeline: quality rules, line dedup, near dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept.
Between stages the documents lie in the shared folder as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billweave.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules
from billweave.llm.oracle import PIPELINE
from billweave.staging import staged


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.passing(docs)


def common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    return line_dedup.without_common_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.distinct_documents(docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, and how often."""
    return mixing.mixed(docs).where("copies > 0")


STAGES = [
    ("quality rules", rules),
    ("line dedup", common_lines),
    ("near dedup", near_copies),
    ("decontamination", benchmark_items),
    ("mixing", mix),
]

ORACLE_SQL = PIPELINE


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{number}")
    return docs
