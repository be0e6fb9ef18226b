"""Operators that turn posting-date text into timestamps and filter by age."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.functions import dates as D


def parse_posted_date(df: DataFrame, col: str, out: str = "posted_at") -> DataFrame:
    return df.withColumn(out, D.parse_absolute(F.col(col)))


def parse_relative_date(df: DataFrame, col: str, as_of: dt.datetime, out: str = "posted_at") -> DataFrame:
    return df.withColumn(out, D.parse_relative(F.col(col), as_of))


def filter_recent(df: DataFrame, ts: str, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return df.filter(D.is_recent(F.col(ts), as_of, days))


def format_dates(df: DataFrame, ts: str, fmt: str = "yyyy-MM-dd", out: str = "formatted") -> DataFrame:
    return df.withColumn(out, F.date_format(ts, fmt))


def resolve_posted_date(df: DataFrame, col: str, first_seen: str, as_of: dt.datetime, out: str = "posted_at") -> DataFrame:
    """Absolute format, else relative phrase, else the time the posting was first seen."""
    text = F.col(col)
    return df.withColumn(
        out, F.coalesce(D.parse_absolute(text), D.parse_relative(text, as_of), F.col(first_seen).cast("timestamp")),
    )
