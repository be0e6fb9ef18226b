"""Dashboard reports. They describe whatever rows they are given: all rows of :func:`scan_errors`, or the
newest ``limit`` of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.plans.monitoring import since

NEWEST_FIRST = ["domain", "component", "stage", "error_type", "message"]


def scan_errors(
    logs: DataFrame, as_of: dt.datetime, domain: str | None = None, hours: int | None = None, component: str | None = None,
    severity: str | None = None, limit: int | None = None,
) -> DataFrame:
    """Errors matching all given filters, newest first."""
    out = logs
    for column, value in (("domain", domain), ("component", component), ("severity", severity)):
        if value:
            out = out.filter(F.col(column) == value)
    if hours:
        out = since(out, as_of, hours=hours, inclusive=True)
    if limit is None:
        return out
    return out.orderBy(F.desc("created_at"), *NEWEST_FIRST).limit(limit)


def _grouped(errors: DataFrame, sets: dict[str, Column]) -> DataFrame:
    """Counts per value of several columns in one pass: ``section, value, n, first, last``, and the
    same for all rows as section "total"."""
    wide = errors.select("created_at", *[c.alias(name) for name, c in sets.items()])
    counted = wide.groupingSets([[], *[[name] for name in sets]], *sets).agg(
        F.count(F.lit(1)).alias("n"), F.min("created_at").alias("first"), F.max("created_at").alias("last"),
        *[F.grouping(name).alias(f"_{name}") for name in sets],
    )
    section, value = F.lit("total"), F.lit(None).cast("string")
    for name in sets:
        here = F.col(f"_{name}") == 0
        section, value = F.when(here, F.lit(name)).otherwise(section), F.when(here, F.col(name)).otherwise(value)
    return counted.select(section.alias("section"), value.alias("value"), "n", "first", "last")


def _ranked(counted: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Rank values within each section and keep the first of each, as ``caps`` says; sections without a cap stay whole.

    A section under a cap may hold any number of values. Each task keeps its own first ones before any exchange, so no
    task ranks all of them; values of other sections pass that step each in a partition of their own. What is left
    is a handful of rows, which get their ranks.
    """
    order = [F.desc("n"), F.col("value")]
    cap = F.lit(None).cast("int")
    for section, size in caps.items():
        cap = F.when(F.col("section") == section, F.lit(size)).otherwise(cap)
    apart = F.when(cap.isNull(), F.coalesce("value", F.lit("")))
    first = counted.withColumn("rank", F.row_number().over(Window.partitionBy("section", apart).orderBy(*order)))
    few = first.filter(F.col("rank") <= max(caps.values())).drop("rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("section").orderBy(*order)))
    return ranked.filter(cap.isNull() | (F.col("rank") <= cap))


def error_summary(sample: DataFrame, top_types: int = 10) -> DataFrame:
    """Counts and percentages by severity, component and (top ten) error type; the "total" row
    carries first and last time and the hours between them."""
    sets = {c: F.col(c) for c in ("severity", "component", "error_type")}
    counted = _ranked(_grouped(sample, sets), {"error_type": top_types}).filter("n > 0")
    is_total = F.col("section") == "total"
    # A few dozen rows at most are left for this window.
    total = F.max(F.when(is_total, F.col("n"))).over(Window.partitionBy())
    hours = (F.unix_micros(F.col("last").cast("timestamp")) - F.unix_micros(F.col("first").cast("timestamp"))) / 3.6e9
    return counted.select(
        "section", "value", "n", "rank", F.round(F.col("n") * 100.0 / total, 1).alias("pct"),
        F.when(is_total, F.col("first")).alias("first_at"), F.when(is_total, F.col("last")).alias("last_at"),
        F.when(is_total, F.round(hours, 1)).alias("span_hours"),
    )


def by_domain(sample: DataFrame, n: int = 30) -> DataFrame:
    """Errors per domain with the most frequent type and the latest time."""
    types = sample.groupBy("domain", "error_type").agg(F.count(F.lit(1)).alias("c"), F.max("created_at").alias("latest"))
    return (
        types.groupBy("domain")
        .agg(F.sum("c").alias("total"), F.min(F.struct(-F.col("c"), F.col("error_type"))).alias("top"), F.max("latest").alias("latest"))
        .select("domain", "total", F.col("top.error_type").alias("top_type"), "latest")
        .orderBy(F.desc("total"), "domain").limit(n)
    )


def by_stage(sample: DataFrame, n: int = 20) -> DataFrame:
    return (
        sample.groupBy(F.concat_ws(":", "component", "stage").alias("stage_key"))
        .agg(F.count(F.lit(1)).alias("errors"), F.countDistinct("domain").alias("domains"))
        .orderBy(F.desc("errors"), "stage_key").limit(n)
    )


def critical_list(sample: DataFrame, n: int = 20) -> DataFrame:
    """Newest grave errors with the message cut at 100 characters."""
    return (
        sample.filter(F.col("severity").isin("critical", "error"))
        .orderBy(F.desc("created_at"), *NEWEST_FIRST).limit(n)
        .select("created_at", "severity", "domain", "component", "stage", "error_type", F.substring("message", 1, 100).alias("message"), "url")
    )


def domain_detail(sample: DataFrame, domain: str, top_stages: int = 10) -> DataFrame:
    """Counts of one domain by component, (top ten) stage and type, and its total."""
    rows = sample.filter(F.col("domain") == domain)
    sets = {
        "component": F.col("component"), "stage": F.concat_ws(":", "component", "stage"), "error_type": F.col("error_type"),
    }
    return _ranked(_grouped(rows, sets), {"stage": top_stages}).filter("n > 0").drop("first", "last")


def domain_timeline(sample: DataFrame, domain: str, n: int = 10) -> DataFrame:
    """Newest errors of one domain in full; the first row is the latest."""
    return sample.filter(F.col("domain") == domain).orderBy(F.desc("created_at"), *NEWEST_FIRST).limit(n)


# Columns of the CSV export.
CSV_COLUMNS = ["created_at", "domain", "component", "stage", "error_type", "severity", "message", "url", "exception_type"]


def export_errors_csv(errors: DataFrame, path: str) -> None:
    """Write the fixed columns with a header line; times keep their microseconds."""
    stamped = errors.select(*CSV_COLUMNS).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    stamped.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
