"""Posting-date expressions: absolute formats, relative phrases, recency."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions.text import squash

_DAY = r"\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_NAME = "[a-z]+"

# The accepted formats, first match wins, each behind the shape it can match. A
# failed parse costs a JVM exception, so a value is only tried against formats of its own shape.
DATE_FORMATS = [
    (rf"^\d{{4}}-{_DAY}-{_DAY}\z", ["yyyy-M-d"]),
    (rf"^\d{{4}}/{_DAY}/{_DAY}\z", ["yyyy/M/d"]),
    (rf"^{_DAY}-{_DAY}-\d{{4}}\z", ["d-M-yyyy"]),
    (rf"^{_DAY}/{_DAY}/\d{{4}}\z", ["d/M/yyyy", "M/d/yyyy"]),
    (rf"^\d{{4}}-{_DAY}-{_DAY}T{_CLOCK}\z", ["yyyy-M-d'T'H:m:s"]),
    (rf"^\d{{4}}-{_DAY}-{_DAY} {_CLOCK}\z", ["yyyy-M-d H:m:s"]),
    (rf"(?i)^{_NAME} {_DAY}, \d{{4}}\z", ["MMMM d, yyyy", "MMM d, yyyy"]),
    (rf"(?i)^{_DAY} {_NAME} \d{{4}}\z", ["d MMMM yyyy", "d MMM yyyy"]),
]

# Days per unit of a relative phrase (months and years approximate).
UNIT_DAYS = {"day": 1, "week": 7, "month": 30, "year": 365}


def parse_absolute(text: Column) -> Column:
    """Timestamp of a date written in one of the accepted formats, else NULL."""
    value = squash(text)
    out = None
    for shape, formats in DATE_FORMATS:
        parsed = F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in formats])
        out = F.when(value.rlike(shape), parsed) if out is None else out.when(value.rlike(shape), parsed)
    return out


def parse_relative(text: Column, as_of: dt.datetime) -> Column:
    """Timestamp of "today", "yesterday" or "N units ago" counted back from ``as_of``."""
    value = F.lower(text)
    now = F.lit(as_of).cast("timestamp")
    phrase = r"(\d+)\s*(day|week|month|year)s?\s*ago"
    count = F.regexp_extract(value, phrase, 1).try_cast("bigint")
    unit = F.regexp_extract(value, phrase, 2)
    scale = F.lit(None).cast("int")
    for name, days in UNIT_DAYS.items():
        scale = F.when(unit == name, F.lit(days)).otherwise(scale)
    days = F.try_multiply(count, scale.cast("bigint"))
    # Further back than year 1 there is no date to return.
    reach = as_of.toordinal() - 1
    back = F.when(days <= reach, now - F.make_dt_interval(days.cast("int")))
    return (
        F.when(value.contains("today"), now)
        .when(value.contains("yesterday"), now - F.expr("INTERVAL 1 DAY"))
        .when(unit != "", back)
    )


def is_recent(ts: Column, as_of: dt.datetime, days: int = 30) -> Column:
    """At most ``days`` old at ``as_of``; the future counts as recent."""
    return ts.cast("timestamp") >= F.lit(as_of - dt.timedelta(days=days)).cast("timestamp")
