"""Seed lists: text files with one URL per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postings.functions.text import strip
from postings.operators.urls import with_domain


def seeds_from_lines(lines: DataFrame, line: str = "value", pos: str = "pos") -> DataFrame:
    """Strip, skip blank lines and ``#`` comments, keep the first position of each URL."""
    url = strip(F.col(line))
    return (
        lines.select(F.col(pos).alias("pos"), url.alias("url"))
        .filter((F.col("url") != "") & ~F.col("url").startswith("#"))
        .groupBy("url").agg(F.min("pos").alias("pos")).select("pos", "url")
    )


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """``pos, url`` of a seed file (or of a folder, in path order); ``pos`` grows with file and line.

    Lines are numbered without a global sort: a split's byte offset plus the row number within the
    task grows along the file, since every line takes a byte or more. Only the list of files, a row
    each, is ranked.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = lines.withColumn("line", F.col("start") + row)
    ranks = lines.select("file").distinct().withColumn("rank", F.row_number().over(Window.orderBy("file")))
    return seeds_from_lines(numbered.join(ranks, "file").withColumn("pos", F.col("rank").cast("bigint") * (1 << 44) + F.col("line")))


def group_seeds_by_domain(seeds: DataFrame, block: int = 10_000) -> DataFrame:
    """Ordered seeds per domain, in lists of neighbours: ``domain, block, urls``.

    ``block`` seeds of the whole file at most meet in one list, so a domain with millions of seeds
    becomes many rows; read in order of ``block`` they are the full ordered list. Needs a numeric
    ``pos``.
    """
    numbered = with_domain(seeds).withColumn("block", F.floor(F.col("pos") / block).cast("bigint"))
    return (
        numbered.groupBy("domain", "block")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("items"))
        .select("domain", "block", F.transform("items", lambda s: s["url"]).alias("urls"))
    )
