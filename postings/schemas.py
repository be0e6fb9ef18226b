"""Schemas and value sets of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Text fields of a raw posting; "location" may be text or a list before it is canonicalised.
JOB_TEXT_FIELDS = [
    "title", "job_url", "company", "location", "country", "team_or_category", "employment_type",
    "date_posted", "requisition_id", "office_or_remote", "seniority_level", "seniority_bucket",
]
# The fields that count towards how complete a posting is.
RICHNESS_FIELDS = [
    "title", "job_url", "company", "location", "team_or_category", "employment_type", "date_posted",
    "requisition_id", "office_or_remote", "seniority_level", "seniority_bucket",
]
# Optional text fields of a validated posting.
POSTING_OPTIONAL = [
    "company", "location", "team_or_category", "employment_type", "office_or_remote", "date_posted_raw",
    "job_description", "weekly_hours", "apply_url", "job_id", "role_number",
]
POSTING_FIELDS = ["job_url", "title", "country", "seniority_level", "seniority_bucket", *POSTING_OPTIONAL]

# Allowed seniority buckets.
SENIORITY_BUCKETS = ["intern", "entry", "mid", "senior", "director_vp", "executive", "unknown"]

JOBS = T.StructType([
    *_strings(*POSTING_FIELDS),
    T.StructField("first_seen_at", T.TimestampType()),
    T.StructField("last_seen_at", T.TimestampType()),
    *_strings("source_domain", "source_page_url", "source_page_title", "raw_extra", "raw_job"),
])

# Allowed values of the log tables.
ERROR_COMPONENTS = ["crawler", "llm", "db", "utils", "config", "unknown"]
ERROR_SEVERITIES = ["debug", "info", "warning", "error", "critical"]
ERROR_TYPES = [
    "validation_error", "schema_error", "timeout", "connection_error", "http_error", "rate_limit",
    "api_error", "parse_error", "json_error", "html_error", "db_connection_error", "db_query_error",
    "db_upsert_error", "browser_error", "navigation_error", "element_not_found", "file_error",
    "path_error", "config_error", "env_error", "unknown",
]
PROCESS_STEPS = ["crawl_start", "crawl_complete", "html_extracted", "llm_start", "llm_complete", "db_complete"]
PROCESS_STATUSES = ["in_progress", "success", "failed"]

ERROR_LOGS = T.StructType([
    *_strings(
        "component", "stage", "error_type", "severity", "domain", "message", "url", "exception_type",
        "stack_trace", "metadata",
    ),
    T.StructField("created_at", T.TimestampType()),
])

PROCESS_LOGS = T.StructType([
    *_strings("run_id", "step", "company", "domain"),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()),
    *_strings("status", "metadata"),
    T.StructField("created_at", T.TimestampType()),
])

CAPTURE_META = T.StructType([
    *_strings("url", "source_url", "title", "sha1", "page_id"),
    T.StructField("reduce_meta", T.StructType(_strings("title", "url"))),
])
