"""Conforming, classifying and reading error and process logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.functions.text import blank_to_null, has_ink, strip, strip_long
from postings.schemas import ERROR_COMPONENTS, ERROR_SEVERITIES, ERROR_TYPES, PROCESS_STATUSES, PROCESS_STEPS


def rejects(*checks: tuple[str, Column]) -> Column:
    """Names of the checks that fail; a check that is NULL fails as well."""
    return F.filter(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks]),
        lambda r: r.isNotNull(),
    )


def split_rejects(df: DataFrame, reasons: str = "reasons", store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows without ``reasons``, and those that have some.

    Each half evaluates the input; with ``store`` the rows are written once below that path, by verdict, and both halves read
    what is there. ``store`` must be a new folder that executors reach.
    """
    if store is None:
        return df.filter(F.size(reasons) == 0).drop(reasons), df.filter(F.size(reasons) > 0)
    df.withColumn("_verdict", F.when(F.size(reasons) == 0, "valid").otherwise("rejected")).write.partitionBy("_verdict").parquet(store)
    kept = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("_verdict", T.StringType())])).parquet(store)
    valid, rejected = (kept.filter(F.col("_verdict") == v).drop("_verdict") for v in ("valid", "rejected"))
    return valid.drop(reasons), rejected


def metadata_text(df: DataFrame, col: str = "metadata") -> Column:
    """JSON text of the metadata whatever its type; values that have no JSON form become text."""
    dtype = df.schema[col].dataType
    value = F.col(col)
    if isinstance(dtype, T.StringType):
        return F.coalesce(value, F.lit("{}"))
    if isinstance(dtype, T.MapType) and isinstance(dtype.valueType, (T.BinaryType, T.CalendarIntervalType, T.DayTimeIntervalType)):
        value = F.transform_values(value, lambda _, v: v.cast("string"))
    return F.coalesce(F.to_json(value), F.lit("{}"))


def flag_error_records(df: DataFrame) -> DataFrame:
    """Normalised error rows with the ``reasons`` they would be rejected for: one pass over the input.

    Stage becomes lower snake case, the message is trimmed and capped at 5000 characters, an
    unset severity is "error". ``truncated`` says whether the message lost something.
    """
    trimmed = {c: strip(F.col(c)) for c in ("component", "error_type", "domain", "url", "exception_type")}
    stage = F.replace(F.lower(strip(F.col("stage"))), F.lit(" "), F.lit("_"))
    severity = F.coalesce(strip(F.col("severity")), F.lit("error"))

    def fits(value: Column, low: int, high: int) -> Column:
        return F.length(value).between(low, high)

    # Judged on the incoming columns, so that filtering does not rewrite the long texts first.
    flagged = df.withColumn("reasons", rejects(
        ("component", trimmed["component"].isin(ERROR_COMPONENTS)),
        ("stage", fits(stage, 1, 100)),
        ("error_type", trimmed["error_type"].isin(ERROR_TYPES)),
        ("severity", severity.isin(ERROR_SEVERITIES)),
        ("domain", fits(trimmed["domain"], 1, 255)),
        ("message", has_ink(F.col("message"))),
        ("url", F.col("url").isNull() | fits(trimmed["url"], 0, 2048)),
        ("exception_type", F.col("exception_type").isNull() | fits(trimmed["exception_type"], 0, 255)),
    ))
    conformed = {
        **trimmed,
        "stack_trace": strip_long(F.col("stack_trace")),
        "stage": stage,
        "severity": severity,
        "message": F.substring(strip(F.col("message")), 1, 5000),
        "truncated": F.coalesce(F.length(strip(F.col("message"))) > 5000, F.lit(False)),
        "metadata": metadata_text(df),
        "created_at": F.coalesce(F.col("created_at"), F.current_timestamp().cast(df.schema["created_at"].dataType)),
    }
    return flagged.withColumns(conformed)


def conform_error_records(df: DataFrame, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both halves of :func:`flag_error_records`: valid rows, and those that break a rule with their ``reasons``.

    Each half evaluates the input, unless ``store`` names a folder for one pass (:func:`split_rejects`).
    """
    return split_rejects(flag_error_records(df), store=store)


def classify_errors(df: DataFrame, exc_name: str, exc_msg: str, out: str = "error_type") -> DataFrame:
    """Error type from an exception's class name and message, first rule that matches."""
    name = F.lower(F.coalesce(F.col(exc_name), F.lit("")))
    msg = F.lower(F.coalesce(F.col(exc_msg), F.lit("")))
    # Substrings of class name and message per type, in order of precedence.
    rules = [
        ("validation_error", ["validation", "schema"], []),
        ("timeout", ["timeout"], ["timeout"]),
        ("connection_error", ["connection"], []),
        ("http_error", ["http"], ["status"]),
        ("rate_limit", [], ["429", "rate limit"]),
        ("json_error", ["json"], []),
        ("parse_error", ["parse"], []),
        ("db_query_error", ["database", "sql", "postgres"], []),
        ("browser_error", ["playwright", "browser"], []),
        ("element_not_found", ["element"], ["selector"]),
        ("file_error", ["file", "io"], []),
    ]
    kind = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, in_name, in_msg in rules:
        hit = F.lit(False)
        for part in in_name:
            hit = hit | name.contains(part)
        for part in in_msg:
            hit = hit | msg.contains(part)
        kind = kind.when(hit, F.lit(value))
    return df.withColumn(out, kind.otherwise(F.lit("unknown")))


def trim_stack_traces(df: DataFrame, exc_name: str = "exception_type") -> DataFrame:
    """Keep the stack trace where it tells something, cut at 10 000 characters.

    Always for critical rows, never below "error", and not for error types that are expected.
    """
    # Class names whose trace is not kept.
    expected = ["ValidationError", "FileNotFoundError", "KeyError", "ValueError", "TimeoutError"]
    simple = F.substring_index(F.coalesce(F.col(exc_name), F.lit("")), ".", -1)
    trace = F.col("stack_trace")
    cut = F.when(
        F.length(trace) > 10000, F.concat(F.substring(trace, 1, 10000), F.lit("\n... (truncated)")),
    ).otherwise(trace)
    keep = (F.col("severity") == "critical") | (
        ~F.col("severity").isin("warning", "info", "debug") & ~simple.isin(expected)
    )
    return df.withColumn("stack_trace", F.when(keep, cut))


def sanitize_metadata(df: DataFrame, col: str = "metadata") -> DataFrame:
    return df.withColumn(col, metadata_text(df, col))


def conform_process_records(df: DataFrame, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Normalised step rows with their duration, and the rows that break a rule (``store``: see :func:`split_rejects`).

    ``truncated`` says whether company or domain, which have 255 characters, lost something.
    """
    seconds = F.expr("CAST(unix_micros(CAST(completed_at AS TIMESTAMP)) - unix_micros(CAST(started_at AS TIMESTAMP)) AS DOUBLE)") / 1e6
    long = (F.length(strip(F.col("company"))) > 255) | (F.length(strip(F.col("domain"))) > 255)
    out = df.withColumns({
        "truncated": F.coalesce(long, F.lit(False)),
        "run_id": strip(F.col("run_id").cast("string")),
        "company": F.substring(F.coalesce(blank_to_null(F.col("company")), F.lit("Unknown")), 1, 255),
        "domain": F.substring(F.lower(F.coalesce(blank_to_null(F.col("domain")), F.lit("unknown"))), 1, 255),
        "status": F.coalesce(strip(F.col("status")), F.lit("success")),
        "duration_seconds": F.round(seconds, 3),
        "metadata": metadata_text(df),
    })
    out = out.withColumn("reasons", rejects(
        ("run_id", F.length("run_id") > 0),
        ("step", F.col("step").isin(PROCESS_STEPS)),
        ("status", F.col("status").isin(PROCESS_STATUSES)),
        ("duration_seconds", F.col("duration_seconds").isNull() | (F.col("duration_seconds") >= 0)),
    ))
    return split_rejects(out, store=store)


def step_descriptions(df: DataFrame, out: str = "description") -> DataFrame:
    """Sentence per step; a template whose value is missing stays raw."""
    # Step, template, column the template needs.
    templates = [
        ("crawl_start", "Crawling {company} company", "company"),
        ("crawl_complete", "Finished Crawling", None),
        ("html_extracted", "Extracted HTML", None),
        ("llm_start", "Sending reduced_html to Gemini", None),
        ("llm_complete", "Gemini process complete, found {jobs_found} jobs", "jobs_found"),
        ("db_complete", "Database save complete, saved {jobs_saved} jobs", "jobs_saved"),
    ]
    text = F.when(F.lit(False), F.lit(None).cast("string"))
    for step, template, needed in templates:
        filled = F.lit(template)
        if needed and needed in df.columns:
            value = F.col(needed).cast("string")
            filled = F.coalesce(F.replace(F.lit(template), F.lit("{" + needed + "}"), value), F.lit(template))
        text = text.when(F.col("step") == step, filled)
    return df.withColumn(out, text.otherwise(F.col("step")))


def _newest(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def logs_for_run(df: DataFrame, run_id: str, limit: int | None = None) -> DataFrame:
    """Steps of one run, oldest first."""
    return _newest(df.filter(F.col("run_id") == run_id).orderBy("started_at", "step", "created_at"), limit)


def logs_for_company(df: DataFrame, company: str, limit: int | None = None) -> DataFrame:
    """Steps of one company, newest first."""
    return _newest(df.filter(F.col("company") == company).orderBy(F.desc("created_at"), "run_id", "step"), limit)


def errors_for_domain(
    df: DataFrame, domain: str, limit: int | None = None, severity: str | None = None, component: str | None = None,
) -> DataFrame:
    """Errors of one domain, newest first."""
    out = df.filter(F.col("domain") == domain)
    if severity:
        out = out.filter(F.col("severity") == severity)
    if component:
        out = out.filter(F.col("component") == component)
    return _newest(out.orderBy(F.desc("created_at"), "component", "stage", "error_type", "message"), limit)
