"""Error and process logs (family H, and the log sources of A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.entities import AS_OF, ERROR_LOGS_SQL, PROCESS_LOGS_SQL, _EVENTS_SQL, error_logs, events_k, process_logs
from postings.operators import logs as H
from postings.plans.dashboard import CSV_COLUMNS, export_errors_csv
from postings.session import scratch_dir
from postings.sources import tables as T

_NAME = (
    "CASE k % 12 WHEN 0 THEN 'ValidationError' WHEN 1 THEN 'ReadTimeout' WHEN 2 THEN 'ConnectionResetError' WHEN 3 THEN 'HTTPStatusError' "
    "WHEN 4 THEN 'JSONDecodeError' WHEN 5 THEN 'ParseFailure' WHEN 6 THEN 'PostgresError' WHEN 7 THEN 'PlaywrightError' WHEN 8 THEN 'ElementHandleError' "
    "WHEN 9 THEN 'FileNotFoundError' WHEN 10 THEN 'MyException' ELSE 'KeyError' END"
)
_MSG = (
    "CASE event_type WHEN 'view' THEN 'Timeout after ' || CAST(k AS STRING) WHEN 'click' THEN 'bad STATUS' WHEN 'error' THEN 'got 429' "
    "WHEN 'purchase' THEN 'no selector' ELSE 'plain' END"
)
# Error rows with faults: padding, unknown values, long and blank text.
_DIRTY = {
    "component": "CASE WHEN k % 17 = 0 THEN 'robot' ELSE ' ' || component || ' ' END",
    "stage": "CASE WHEN k % 13 = 0 THEN '  ' ELSE ' ' || upper(replace(stage, '_', ' ')) END",
    "severity": "CASE WHEN k % 11 = 0 THEN NULL ELSE severity END",
    "message": "CASE WHEN k % 19 = 0 THEN '   ' WHEN k % 23 = 1 THEN '  ' || repeat(message || ' ', k * 6) ELSE '  ' || message || ' ' END",
    "stack_trace": "CASE WHEN k % 3 = 0 THEN ' trace ' END",
    "url": "CASE WHEN k % 21 = 0 THEN url || repeat('x', k * 40) ELSE url END",
}


def _dirty(spark, sf):
    logs = events_k(spark, sf)
    from checks.entities import ERROR_EXPRS

    rows = logs.select("event_id", "k", *[F.expr(e).alias(n) for n, e in ERROR_EXPRS.items()])
    return rows.withColumns({n: F.expr(e) for n, e in _DIRTY.items()})


def h01(spark, sf):
    """Both halves from one pass over the input."""
    valid, rejected = H.conform_error_records(_dirty(spark, sf), store=scratch_dir(spark, "conformed"))
    flagged = valid.withColumn("reasons", F.array().cast("array<string>")).unionByName(rejected)
    return flagged.select("event_id", "component", "stage", "severity", F.length("message").alias("n"), "url", F.array_join("reasons", ",").alias("reasons"))


def h02(spark, sf):
    named = events_k(spark, sf).select("event_id", F.expr(_NAME).alias("exc_name"), F.expr(_MSG).alias("exc_msg"))
    return H.classify_errors(named, "exc_name", "exc_msg")


def h03(spark, sf):
    return H.trim_stack_traces(error_logs(spark, sf)).groupBy("severity", "exception_type").agg(
        F.count("stack_trace").alias("kept"), F.sum(F.length("stack_trace")).alias("chars"), F.max(F.sha1("stack_trace")).alias("digest"))


def h04(spark, sf):
    logs = events_k(spark, sf).select("event_id", F.create_map(F.lit("k"), F.col("k").cast("string"), F.lit("type"), F.col("event_type")).alias("metadata"))
    return H.sanitize_metadata(logs)


def h05(spark, sf):
    valid, rejected = H.conform_process_records(process_logs(spark, sf))
    cols = ["event_id", "run_id", "step", "company", "domain", "status", "duration_seconds"]
    return valid.select(*cols, F.lit("").alias("reasons")).unionByName(rejected.select(*cols, F.array_join("reasons", ",").alias("reasons")))


def h06(spark, sf):
    return H.step_descriptions(process_logs(spark, sf)).select("event_id", "step", "description")


def h07a(spark, sf):
    return H.logs_for_run(process_logs(spark, sf), "7").select("event_id", "step", "started_at")


def h07b(spark, sf):
    logs = process_logs(spark, sf).withColumn("company", F.trim("company"))
    return H.logs_for_company(logs, "Site 7").select("event_id", "run_id", "created_at")


def h08(spark, sf):
    return H.errors_for_domain(error_logs(spark, sf), "jobs.site7.example.com", severity="error", component="crawler").select(
        "created_at", "stage", "error_type", "message")


_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _lines(df, path):
    """Write rows the way the file fallback does: an object per line, times in full; compressed, as logs are kept."""
    df.withColumn("metadata", F.parse_json("metadata")).write.option("timestampNTZFormat", _MICROS).option("compression", "gzip").json(path)


def a09(spark, sf):
    """Most rows reach the table; critical ones fall back to JSON lines; both are read."""
    table, lines = scratch_dir(spark, "error-table"), scratch_dir(spark, "error-lines")
    logs = error_logs(spark, sf)
    T.append_error_logs(logs.filter(F.col("severity") != "critical"), table)
    _lines(logs.filter(F.col("severity") == "critical"), lines)
    return T.read_error_logs(spark, table, lines).select(
        "created_at", "domain", "component", "severity", "error_type", "message",
        F.get_json_object("metadata", "$.page_title").alias("page_title"), F.get_json_object("metadata", "$.attempt").alias("attempt"))


def a10(spark, sf):
    table, lines = scratch_dir(spark, "process-table"), scratch_dir(spark, "process-lines")
    logs, _ = H.conform_process_records(process_logs(spark, sf))
    failed = F.col("status") == "failed"
    T.append_process_logs(logs.filter(~failed), table)
    _lines(logs.filter(failed), lines)
    return T.read_process_logs(spark, table, lines).select(
        "run_id", "step", "company", "domain", "status", "started_at", "completed_at", "duration_seconds",
        F.get_json_object("metadata", "$.jobs_found").alias("jobs_found"))


def a12(spark, sf):
    path = scratch_dir(spark, "errors-csv")
    logs = error_logs(spark, sf).withColumn("message", F.concat("message", F.lit(', "quoted"')))
    export_errors_csv(logs, path)
    return spark.read.option("header", True).option("escape", '"').csv(path).withColumn("created_at", F.col("created_at").cast("timestamp"))


QUERIES = {
    "h01_conform_error_records": h01, "h02_classify_errors": h02, "h03_trim_stack_traces": h03, "h04_sanitize_metadata": h04,
    "h05_conform_process_records": h05, "h06_step_descriptions": h06, "h07a_logs_for_run": h07a, "h07b_logs_for_company": h07b,
    "h08_errors_for_domain": h08, "a09_error_logs_with_fallback": a09, "a10_process_logs_with_fallback": a10, "a12_export_errors_csv": a12,
}

_ERR = "WITH " + ERROR_LOGS_SQL
_ERRK = "WITH " + ERROR_LOGS_SQL.replace("(SELECT ", "(SELECT event_id, k, ", 1)
_PROC = "WITH " + PROCESS_LOGS_SQL
_CONF = """, conf AS (SELECT *, trim(run_id) AS rid, coalesce(nullif(trim(company), ''), 'Unknown') AS comp, coalesce(nullif(lower(trim(domain)), ''), 'unknown') AS dom,
  round((epoch_us(completed_at) - epoch_us(started_at))::DOUBLE / 1e6, 3) AS dur FROM process_logs)"""
_N, _M = "lower(exc_name)", "lower(exc_msg)"
assert AS_OF

ORACLES = {
    "h01_conform_error_records": _ERRK + f""", d AS (SELECT event_id, error_type, domain, {', '.join(f'{e} AS {n}' for n, e in _DIRTY.items())} FROM error_logs),
c AS (SELECT event_id, trim(component) AS component, replace(lower(trim(stage)), ' ', '_') AS stage, coalesce(severity, 'error') AS severity,
  CAST(length(substring(trim(message), 1, 5000)) AS INT) AS n, url FROM d)
SELECT *, concat_ws(',', CASE WHEN component = 'robot' THEN 'component' END, CASE WHEN stage = '' THEN 'stage' END, CASE WHEN n = 0 THEN 'message' END,
  CASE WHEN length(url) > 2048 THEN 'url' END) AS reasons FROM c""",
    "h02_classify_errors": f"""SELECT event_id, exc_name, exc_msg, CASE WHEN contains({_N}, 'validation') OR contains({_N}, 'schema') THEN 'validation_error'
  WHEN contains({_N}, 'timeout') OR contains({_M}, 'timeout') THEN 'timeout' WHEN contains({_N}, 'connection') THEN 'connection_error'
  WHEN contains({_N}, 'http') OR contains({_M}, 'status') THEN 'http_error' WHEN contains({_M}, '429') OR contains({_M}, 'rate limit') THEN 'rate_limit'
  WHEN contains({_N}, 'json') THEN 'json_error' WHEN contains({_N}, 'parse') THEN 'parse_error'
  WHEN contains({_N}, 'database') OR contains({_N}, 'sql') OR contains({_N}, 'postgres') THEN 'db_query_error'
  WHEN contains({_N}, 'playwright') OR contains({_N}, 'browser') THEN 'browser_error' WHEN contains({_N}, 'element') OR contains({_M}, 'selector') THEN 'element_not_found'
  WHEN contains({_N}, 'file') OR contains({_N}, 'io') THEN 'file_error' ELSE 'unknown' END AS error_type
FROM (SELECT event_id, {_NAME} AS exc_name, {_MSG} AS exc_msg FROM {_EVENTS_SQL} e) q""",
    "h03_trim_stack_traces": _ERR + """, t AS (SELECT severity, exception_type, CASE WHEN severity = 'critical' OR (severity = 'error' AND
  coalesce(exception_type, '') NOT IN ('builtins.ValueError')) THEN CASE WHEN length(stack_trace) > 10000 THEN substring(stack_trace, 1, 10000) || chr(10) || '... (truncated)'
  ELSE stack_trace END END AS st FROM error_logs)
SELECT severity, exception_type, count(st) AS kept, CAST(sum(length(st)) AS BIGINT) AS chars, max(sha1(st)) AS digest FROM t GROUP BY ALL""",
    "h04_sanitize_metadata": f"""SELECT event_id, '{{"k":"' || k || '","type":"' || event_type || '"}}' AS metadata FROM {_EVENTS_SQL} e""",
    "h05_conform_process_records": _PROC + _CONF + """ SELECT event_id, rid AS run_id, step, comp AS company, dom AS domain, status, dur AS duration_seconds,
  concat_ws(',', CASE WHEN status = 'odd' THEN 'status' END, CASE WHEN dur < 0 THEN 'duration_seconds' END) AS reasons FROM conf""",
    "h06_step_descriptions": _PROC + """ SELECT event_id, step, CASE step WHEN 'crawl_start' THEN 'Crawling ' || company || ' company' WHEN 'crawl_complete' THEN 'Finished Crawling'
  WHEN 'llm_start' THEN 'Sending reduced_html to Gemini' WHEN 'llm_complete' THEN 'Gemini process complete, found ' || coalesce(CAST(jobs_found AS VARCHAR), '{jobs_found}') || ' jobs'
  ELSE 'Database save complete, saved ' || coalesce(CAST(jobs_saved AS VARCHAR), '{jobs_saved}') || ' jobs' END AS description FROM process_logs""",
    "h07a_logs_for_run": _PROC + " SELECT event_id, step, started_at FROM process_logs WHERE run_id = '7'",
    "h07b_logs_for_company": _PROC + " SELECT event_id, run_id, created_at FROM process_logs WHERE trim(company) = 'Site 7'",
    "h08_errors_for_domain": _ERR + """ SELECT created_at, stage, error_type, message FROM error_logs WHERE domain = 'jobs.site7.example.com' AND severity = 'error'
AND component = 'crawler'""",
    "a09_error_logs_with_fallback": _ERR + """ SELECT created_at, domain, component, severity, error_type, message, json_extract_string(metadata, '$.page_title') AS page_title,
  json_extract_string(metadata, '$.attempt') AS attempt FROM error_logs""",
    "a10_process_logs_with_fallback": _PROC + _CONF + """ SELECT rid AS run_id, step, comp AS company, dom AS domain, status, started_at, completed_at, dur AS duration_seconds,
  json_extract_string(metadata, '$.jobs_found') AS jobs_found FROM conf WHERE status <> 'odd' AND coalesce(dur, 0) >= 0""",
    "a12_export_errors_csv": _ERR + f" SELECT {', '.join(CSV_COLUMNS)} FROM (SELECT * REPLACE (message || ', \"quoted\"' AS message) FROM error_logs) q",
}
