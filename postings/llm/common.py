"""Shared pieces: words, binding of shared column expressions, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.session import scratch_dir

# What separates words, and words themselves: fixed values of the contracts.
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: an array of one element is transformed."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text in order; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def count_words(text: Column) -> Column:
    """Number of words as BIGINT; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, and safe when executors go."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batch(fn: Callable) -> Callable[[Iterator], Iterator]:
    """mapInArrow function from a function of one record batch that yields record batches."""
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return run


def slices(batch: pa.RecordBatch, column: str | int, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A record batch in pieces of about ``size`` bytes of one column; a longer value is a piece of its own."""
    first = done = 0
    for row, value in enumerate(batch.column(column)):
        done += len(value.as_buffer()) if value.is_valid else 0
        if done >= size:
            yield batch.slice(first, row + 1 - first)
            first, done = row + 1, 0
    if first < batch.num_rows:
        yield batch.slice(first)
