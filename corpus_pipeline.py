"""A corpus pipeline over documents: each stage takes what the one before it kept.

A stage gets (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Nulls in any
column, empty and repeated rows and empty tables are as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postings.llm import decontaminate, mixing, quality, secrets, simhash
from postings.llm.common import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and every rule of the table."""
    return quality.filter_quality(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by SimHash (three-word shingles, two bits at most), the one with the least id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of times each is used (``copies``)."""
    return mixing.apply_mix(docs)


STAGES = [
    ("quality rules", quality_rules), ("SimHash near-dedup", simhash_dedup), ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan), ("source mixing", source_mix),
]

#: SimHash (XXH64 of shingles) and CGK walks have no SQL here; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the rows are written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
