"""Monitoring reports over the error log (and, where named, the jobs table).

``as_of`` stands for "now". The cut-off is compared in the type of the stored column, so it reaches
the Parquet scan as a pushed filter. Counts are combined on the map side, so a domain that wrote a
third of all errors costs its tasks no more than any other. Ties under a limit are broken by the
grouping columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def cutoff(df: DataFrame, column: str, when: dt.datetime) -> Column:
    return F.lit(when).cast(df.schema[column].dataType)


def since(df: DataFrame, as_of: dt.datetime, column: str = "created_at", inclusive: bool = False, **age: int) -> DataFrame:
    """Rows younger than an age such as ``days=7`` (``inclusive``: or just as old); a log's ``day`` gets the same bound, so
    older folders are not opened."""
    start = as_of - dt.timedelta(**age)
    if column == "created_at" and "day" in df.columns:
        df = df.filter(F.col("day") >= F.lit(start.date()))
    bound = cutoff(df, column, start)
    return df.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)


def meta(key: str) -> Column:
    return F.get_json_object("metadata", f"$.{key}")


def meta_int(key: str) -> Column:
    return meta(key).try_cast("int")


def severity_share(errors: DataFrame, as_of: dt.datetime, hours: int = 24) -> DataFrame:
    """Errors and their percentage per severity, gravest first."""
    counts = since(errors, as_of, hours=hours).groupBy("severity").agg(_n("error_count"))
    # Five rows at most reach the window over everything.
    total = F.sum("error_count").over(Window.partitionBy())
    rank = F.lit(5)
    for place, severity in enumerate(["critical", "error", "warning", "info"], 1):
        rank = F.when(F.col("severity") == severity, F.lit(place)).otherwise(rank)
    return (
        counts.withColumn("percentage", F.round(F.col("error_count") * 100.0 / total, 2))
        .orderBy(rank, "severity")
    )


def top_failing_domains(errors: DataFrame, as_of: dt.datetime, days: int = 7, limit: int = 10) -> DataFrame:
    return (
        since(errors, as_of, days=days).groupBy("domain")
        .agg(_n("error_count"), F.countDistinct("error_type").alias("unique_error_types"), F.max("created_at").alias("latest_error"))
        .orderBy(F.desc("error_count"), "domain").limit(limit)
    )


def crawler_errors_by_stage(errors: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    return (
        since(errors, as_of, days=days).filter(F.col("component") == "crawler").groupBy("stage", "error_type")
        .agg(_n("occurrences"), F.countDistinct("domain").alias("affected_domains"), F.max("created_at").alias("latest_occurrence"))
        .orderBy(F.desc("occurrences"), "stage", "error_type")
    )


def llm_failures(errors: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    return (
        since(errors, as_of, days=days)
        .filter((F.col("component") == "llm") & F.col("severity").isin("error", "critical"))
        .groupBy("stage", "error_type")
        .agg(_n("failures"), F.countDistinct("domain").alias("affected_domains"), F.avg(F.length("message")).alias("avg_message_length"))
        .orderBy(F.desc("failures"), "stage", "error_type")
    )


def db_validation_errors(errors: DataFrame, as_of: dt.datetime, days: int = 7, limit: int = 20) -> DataFrame:
    keys = ["stage", "error_type", "domain", "page_title"]
    return (
        since(errors, as_of, days=days)
        .filter((F.col("component") == "db") & (F.col("error_type") == "validation_error"))
        .withColumn("page_title", meta("page_title")).groupBy(*keys)
        .agg(_n("validation_errors"), F.max("created_at").alias("latest_error"))
        .orderBy(F.desc("validation_errors"), *keys).limit(limit)
    )


_DETAIL = ["created_at", "component", "stage", "error_type", "severity", "message", "url", "exception_type", "metadata"]


def domain_history(errors: DataFrame, domain: str, limit: int = 50) -> DataFrame:
    return (
        errors.filter(F.col("domain") == domain).select(*_DETAIL)
        .orderBy(F.desc("created_at"), "component", "stage", "error_type", "message").limit(limit)
    )


def domain_hourly_timeline(errors: DataFrame, as_of: dt.datetime, domain: str, hours: int = 48) -> DataFrame:
    return (
        since(errors, as_of, hours=hours).filter(F.col("domain") == domain)
        .groupBy(F.date_trunc("hour", "created_at").alias("hour"), "component").agg(_n("error_count"))
        .orderBy(F.desc("hour"), "component")
    )


def common_timeouts(errors: DataFrame, as_of: dt.datetime, days: int = 7, limit: int = 20) -> DataFrame:
    keys = ["component", "stage", "domain", "timeout_setting"]
    return (
        since(errors, as_of, days=days).filter(F.col("error_type") == "timeout")
        .withColumn("timeout_setting", meta_int("nav_timeout_ms")).groupBy(*keys)
        .agg(_n("timeout_count"), F.max("created_at").alias("latest"))
        .orderBy(F.desc("timeout_count"), *keys).limit(limit)
    )


def json_parse_failures(errors: DataFrame, as_of: dt.datetime, days: int = 7, block: int = 10_000) -> DataFrame:
    """Per domain: failures, mean response length and the distinct page titles in order, joined.

    A domain with more than ``block`` titles has several rows, each with at most so many of them: the rows of a domain in
    order of ``block`` are its full ordered list. Counted per (domain, title) first, so that later steps see each title
    once; the order across blocks comes from a range partitioning by domain and title, never from one task.
    """
    length = meta_int("response_length")
    titles = (
        since(errors, as_of, days=days).filter(F.col("error_type") == "json_error")
        .groupBy("domain", meta("page_title").alias("title"))
        .agg(_n("n"), F.max("created_at").alias("latest"), F.sum(length).alias("length"), F.count(length).alias("measured"))
    )
    totals = titles.groupBy("domain").agg(
        F.sum("n").alias("parse_failures"), F.max("latest").alias("latest_failure"),
        F.try_divide(F.sum("length").cast("double"), F.sum("measured")).alias("avg_response_length"), F.count("title").alias("_titles"),
    )
    ordered = titles.select("domain", "title").filter("title IS NOT NULL").repartitionByRange("domain", "title").sortWithinPartitions("domain", "title")
    placed = ordered.withColumn("_place", F.floor(F.monotonically_increasing_id() / block).cast("bigint"))
    small = F.col("_titles") <= block
    listed = (
        placed.join(totals.select("domain", "_titles"), "domain").groupBy("domain", F.when(small, F.lit(0).cast("bigint")).otherwise(F.col("_place")).alias("block"))
        .agg(F.array_join(F.array_sort(F.collect_list("title")), ", ").alias("affected_pages"))
    )
    return (
        totals.drop("_titles").join(listed, "domain", "left").withColumn("affected_pages", F.nullif("affected_pages", F.lit("")))
        .withColumn("block", F.coalesce("block", F.lit(0).cast("bigint"))).orderBy(F.desc("parse_failures"), "domain", "block")
    )


def browser_errors(errors: DataFrame, as_of: dt.datetime, days: int = 7, limit: int = 20) -> DataFrame:
    """Per domain and type with the most common message (the smallest of equals)."""
    messages = (
        since(errors, as_of, days=days)
        .filter(F.col("error_type").isin("browser_error", "navigation_error", "timeout") & (F.col("component") == "crawler"))
        .groupBy("domain", "error_type", "message").agg(_n("n"), F.max("created_at").alias("latest"))
    )
    # Two steps instead of a mode aggregate, whose buffer holds every distinct message.
    best = F.min(F.struct(-F.col("n"), F.col("message"))).alias("best")
    return (
        messages.groupBy("domain", "error_type").agg(F.sum("n").alias("error_count"), F.max("latest").alias("latest"), best)
        .select("domain", "error_type", "error_count", "latest", F.col("best.message").alias("most_common_message"))
        .orderBy(F.desc("error_count"), "domain", "error_type").limit(limit)
    )


def daily_error_rate(errors: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return (
        since(errors, as_of, days=days)
        .groupBy(F.date_trunc("day", "created_at").alias("day"), "component", "error_type").agg(_n("error_count"))
        .orderBy(F.desc("day"), F.desc("error_count"), "component", "error_type")
    )


def new_vs_recurring(errors: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Age class of each domain by its first grave error, with all its errors.

    One pass with conditional aggregates instead of a subquery per domain.
    """
    grave = F.when(F.col("severity").isin("error", "critical"), F.col("created_at"))
    first = F.col("first_error")
    age = (
        F.when(first > cutoff(errors, "created_at", as_of - dt.timedelta(days=7)), "New (< 7 days)")
        .when(first > cutoff(errors, "created_at", as_of - dt.timedelta(days=30)), "Recent (< 30 days)")
        .otherwise("Recurring (> 30 days)")
    )
    return (
        errors.groupBy("domain").agg(F.min(grave).alias("first_error"), _n("total_errors"))
        .filter(first.isNotNull()).select("domain", "first_error", age.alias("error_age"), "total_errors")
        .orderBy(F.desc("first_error"), "domain")
    )


def timeout_config_analysis(errors: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    return (
        since(errors, as_of, days=days).filter((F.col("error_type") == "timeout") & meta("nav_timeout_ms").isNotNull())
        .groupBy(meta_int("nav_timeout_ms").alias("timeout_ms"))
        .agg(_n("timeout_errors"), F.countDistinct("domain").alias("affected_domains"),
             F.round(F.avg(meta_int("attempt")), 1).alias("avg_retry_attempt"))
        .orderBy(F.desc("timeout_errors"), "timeout_ms")
    )


def job_validation_failures(errors: DataFrame, as_of: dt.datetime, days: int = 7, limit: int = 20) -> DataFrame:
    return (
        since(errors, as_of, days=days).filter((F.col("stage") == "validate_job") & meta("job_title").isNotNull())
        .groupBy(meta("job_title").alias("failing_job_title"), "domain")
        .agg(_n("validation_failures"), F.max("message").alias("error_message"))
        .orderBy(F.desc("validation_failures"), "failing_job_title", "domain").limit(limit)
    )


def _jobs_and_errors(jobs: DataFrame, errors: DataFrame, as_of: dt.datetime, days: int) -> DataFrame:
    """Distinct postings and errors per domain; both sides are one row per domain before they meet."""
    counts = since(errors, as_of, days=days).groupBy("domain").agg(_n("error_count"))
    found = (
        since(jobs, as_of, column="last_seen_at", days=days).groupBy(F.col("source_domain").alias("domain"))
        .agg(F.countDistinct("job_url").alias("jobs_found"))
    )
    return found.join(counts, "domain", "left").withColumn("errors", F.coalesce("error_count", F.lit(0).cast("bigint")))


def healthy_domains(jobs: DataFrame, errors: DataFrame, as_of: dt.datetime, days: int = 7, limit: int = 20) -> DataFrame:
    """Domains with postings, fewest errors first; ``jobs_per_error`` is NULL without errors."""
    ratio = F.round(F.col("jobs_found") / F.nullif(F.col("errors"), F.lit(0)), 2)
    return (
        _jobs_and_errors(jobs, errors, as_of, days).select("domain", "jobs_found", "errors", ratio.alias("jobs_per_error"))
        .orderBy("errors", F.desc("jobs_found"), "domain").limit(limit)
    )


def healthy_domains_having(jobs: DataFrame, errors: DataFrame, as_of: dt.datetime, days: int = 7, max_errors: int = 5) -> DataFrame:
    return (
        _jobs_and_errors(jobs, errors, as_of, days).filter(F.col("errors") < max_errors)
        .select("domain", "jobs_found", "errors").orderBy(F.desc("jobs_found"), "domain")
    )


def domain_error_rate_pct(jobs: DataFrame, errors: DataFrame, as_of: dt.datetime, days: int = 7, min_errors: int = 5) -> DataFrame:
    """Errors as a percentage of errors and distinct postings, domains with more than ``min_errors``."""
    attempts = since(errors, as_of, days=days).groupBy("domain").agg(_n("errors")).filter(F.col("errors") > min_errors)
    found = (
        since(jobs, as_of, column="last_seen_at", days=days).groupBy(F.col("source_domain").alias("domain"))
        .agg(F.countDistinct("job_url").alias("found"))
    )
    rate = F.round(F.col("errors") / (F.col("errors") + F.col("jobs")) * 100, 2)
    return (
        attempts.join(found, "domain", "left").withColumn("jobs", F.coalesce("found", F.lit(0).cast("bigint")))
        .select("domain", "errors", "jobs", rate.alias("error_rate_pct")).orderBy(F.desc("error_rate_pct"), "domain")
    )


def critical_errors(errors: DataFrame, as_of: dt.datetime, hours: int = 24) -> DataFrame:
    return (
        since(errors, as_of, hours=hours).filter(F.col("severity") == "critical")
        .select("created_at", "domain", "component", "stage", "error_type", "message", "url", "exception_type", "metadata")
        .orderBy(F.desc("created_at"), "domain", "component", "stage")
    )


def failing_completely(errors: DataFrame, as_of: dt.datetime, hours: int = 48, min_hours: int = 4, min_errors: int = 10) -> DataFrame:
    """Domains with errors in many distinct hours."""
    return (
        since(errors, as_of, hours=hours).groupBy("domain")
        .agg(_n("total_errors"), F.countDistinct(F.date_trunc("hour", "created_at")).alias("error_hours"),
             F.min("created_at").alias("first_error"), F.max("created_at").alias("latest_error"),
             F.countDistinct("error_type").alias("unique_error_types"))
        .filter((F.col("error_hours") >= min_hours) & (F.col("total_errors") >= min_errors))
        .orderBy(F.desc("total_errors"), "domain")
    )


def errors_per_domain_by_component(errors: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    return (
        since(errors, as_of, days=days).groupBy("component")
        .agg(F.countDistinct("domain").alias("affected_domains"), _n("total_errors"))
        .withColumn("errors_per_domain", F.round(F.col("total_errors") / F.col("affected_domains"), 2))
        .orderBy(F.desc("errors_per_domain"), "component")
    )


def errors_by_weekday(errors: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Errors per weekday, 0 = Sunday."""
    return (
        since(errors, as_of, days=days)
        .groupBy(F.date_format("created_at", "EEEE").alias("day_of_week"), (F.dayofweek("created_at") - 1).alias("dow_num"))
        .agg(_n("error_count"), F.countDistinct("domain").alias("affected_domains")).orderBy("dow_num")
    )


def table_stats(errors: DataFrame) -> DataFrame:
    return errors.agg(_n("total_errors"), F.min("created_at").alias("oldest_error"), F.max("created_at").alias("newest_error"))


def purge_low_severity(errors: DataFrame, as_of: dt.datetime, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """What stays and what goes when old debug and info rows are purged."""
    stale = F.col("severity").isin("debug", "info") & (F.col("created_at") < cutoff(errors, "created_at", as_of - dt.timedelta(days=days)))
    return errors.filter(~F.coalesce(stale, F.lit(False))), errors.filter(stale)


def archive_old(errors: DataFrame, as_of: dt.datetime, days: int = 90) -> tuple[DataFrame, DataFrame]:
    """What stays and what moves to the archive."""
    old = F.col("created_at") < cutoff(errors, "created_at", as_of - dt.timedelta(days=days))
    return errors.filter(~F.coalesce(old, F.lit(False))), errors.filter(old)


def timeouts_by_domain_stage(errors: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    return (
        since(errors, as_of, days=days).filter(F.col("error_type") == "timeout").groupBy("domain", "stage")
        .agg(_n("timeout_count")).orderBy(F.desc("timeout_count"), "domain", "stage")
    )


def parse_failures_by_domain(errors: DataFrame) -> DataFrame:
    return (
        errors.filter((F.col("error_type") == "json_error") & (F.col("component") == "llm")).groupBy("domain")
        .agg(_n("parse_failures")).orderBy(F.desc("parse_failures"), "domain")
    )
