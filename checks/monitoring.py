"""Monitoring and dashboard reports (families I, and A11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.entities import AS_OF, AS_OF_SQL, ERROR_LOGS_SQL, JOBS_SQL, error_logs, jobs_table
from postings.plans import dashboard as D
from postings.plans import monitoring as M

DOMAIN = "jobs.site7.example.com"
I12_AS_OF = dt.datetime(2024, 1, 8, 12)


def _errors(report, *args, **kwargs):
    return lambda spark, sf: report(error_logs(spark, sf), *args, **kwargs)


def _both(report):
    return lambda spark, sf: report(jobs_table(spark, sf), error_logs(spark, sf), AS_OF)


def _whole(report, *args, **kwargs):
    """A dashboard report over the whole table."""
    return lambda spark, sf: report(D.scan_errors(error_logs(spark, sf), AS_OF, limit=None), *args, **kwargs)


def _retention(spark, sf):
    logs = error_logs(spark, sf).select("created_at", "domain", "component", "stage", "error_type", "severity")
    kept, purged = M.purge_low_severity(logs, AS_OF, days=14)
    stays, moved = M.archive_old(kept, AS_OF, days=20)
    label = lambda df, name: df.withColumn("fate", F.lit(name))
    return label(stays, "kept").unionByName(label(moved, "archived")).unionByName(label(purged, "purged"))


QUERIES = {
    "i01_severity_share": _errors(M.severity_share, AS_OF),
    "i02_top_failing_domains": _errors(M.top_failing_domains, AS_OF),
    "i03_crawler_errors_by_stage": _errors(M.crawler_errors_by_stage, AS_OF),
    "i04_llm_failures": _errors(M.llm_failures, AS_OF),
    "i05_db_validation_errors": _errors(M.db_validation_errors, AS_OF),
    "i06_domain_history": _errors(M.domain_history, DOMAIN),
    "i07_domain_hourly_timeline": _errors(M.domain_hourly_timeline, AS_OF, DOMAIN),
    "i08_common_timeouts": _errors(M.common_timeouts, AS_OF),
    "i09_json_parse_failures": lambda spark, sf: M.json_parse_failures(error_logs(spark, sf), AS_OF).drop("block"),
    "i10_browser_errors": _errors(M.browser_errors, AS_OF),
    "i11_daily_error_rate": _errors(M.daily_error_rate, AS_OF),
    "i12_new_vs_recurring": _errors(M.new_vs_recurring, I12_AS_OF),
    "i13_timeout_config_analysis": _errors(M.timeout_config_analysis, AS_OF),
    "i14_job_validation_failures": _errors(M.job_validation_failures, AS_OF),
    "i15_healthy_domains": _both(M.healthy_domains),
    "i16_critical_errors": _errors(M.critical_errors, AS_OF),
    "i17_failing_completely": _errors(M.failing_completely, AS_OF, min_errors=20),
    "i18_errors_per_domain_by_component": _errors(M.errors_per_domain_by_component, AS_OF),
    "i19_errors_by_weekday": _errors(M.errors_by_weekday, AS_OF),
    "i20_table_stats": _errors(M.table_stats),
    "i21_retention": _retention,
    "i22a_timeouts_by_domain_stage": _errors(M.timeouts_by_domain_stage, AS_OF),
    "i22b_parse_failures_by_domain": _errors(M.parse_failures_by_domain),
    "i23_healthy_domains_having": _both(M.healthy_domains_having),
    "i24_domain_error_rate_pct": _both(M.domain_error_rate_pct),
    "i25_error_summary": _whole(D.error_summary),
    "i26_by_domain": _whole(D.by_domain),
    "i27_by_stage": _whole(D.by_stage),
    "i28_critical_list": _whole(D.critical_list),
    "i29a_domain_detail": _whole(D.domain_detail, DOMAIN),
    "i29b_domain_timeline": lambda spark, sf: D.domain_timeline(error_logs(spark, sf), DOMAIN).drop("stack_trace"),
    "a11_scan_errors": lambda spark, sf: D.scan_errors(
        error_logs(spark, sf), AS_OF, hours=240, component="crawler", severity="error").drop("stack_trace"),
}


def _age(text: str, column: str = "created_at") -> str:
    return f"{column} > {AS_OF_SQL} - INTERVAL '{text}'"


def _sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes or (ERROR_LOGS_SQL,)) + "\n" + body


_M = "json_extract_string(metadata, '$.{}')".format
_NEWEST = "created_at DESC, domain, component, stage, error_type, message"
_JE = """je AS (SELECT domain, count(*) AS error_count FROM error_logs WHERE {} GROUP BY domain),
jf AS (SELECT source_domain AS domain, count(DISTINCT job_url) AS jobs_found FROM jobs WHERE {} GROUP BY source_domain)""".format(
    _age("7 days"), _age("7 days", "last_seen_at"))


def _sections(where: str, parts: dict[str, tuple[str, int | None]], extra: str) -> str:
    """UNION of the counts per section; Spark does the same with grouping sets."""
    out = []
    for name, (expr, cap) in parts.items():
        out.append(
            f"SELECT '{name}' AS section, v AS value, n, CAST(rk AS INT) AS rank FROM (SELECT {expr} AS v, count(*) AS n, row_number() OVER "
            f"(ORDER BY count(*) DESC, {expr}) AS rk FROM error_logs {where} GROUP BY {expr}) q" + (f" WHERE rk <= {cap}" if cap else ""))
    return " UNION ALL ".join(out) + f" UNION ALL SELECT 'total', NULL, count(*), 1 FROM error_logs {where}{extra}"


ORACLES = {
    "i01_severity_share": _sql(f"""SELECT severity, count(*) AS error_count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS percentage
FROM error_logs WHERE {_age('24 hours')} GROUP BY severity"""),
    "i02_top_failing_domains": _sql(f"""SELECT domain, count(*) AS error_count, count(DISTINCT error_type) AS unique_error_types, max(created_at) AS latest_error
FROM error_logs WHERE {_age('7 days')} GROUP BY domain ORDER BY error_count DESC, domain LIMIT 10"""),
    "i03_crawler_errors_by_stage": _sql(f"""SELECT stage, error_type, count(*) AS occurrences, count(DISTINCT domain) AS affected_domains, max(created_at) AS latest_occurrence
FROM error_logs WHERE component = 'crawler' AND {_age('7 days')} GROUP BY stage, error_type"""),
    "i04_llm_failures": _sql(f"""SELECT stage, error_type, count(*) AS failures, count(DISTINCT domain) AS affected_domains, avg(length(message)) AS avg_message_length
FROM error_logs WHERE component = 'llm' AND severity IN ('error', 'critical') AND {_age('7 days')} GROUP BY stage, error_type"""),
    "i05_db_validation_errors": _sql(f"""SELECT stage, error_type, domain, {_M('page_title')} AS page_title, count(*) AS validation_errors, max(created_at) AS latest_error
FROM error_logs WHERE component = 'db' AND error_type = 'validation_error' AND {_age('7 days')} GROUP BY ALL
ORDER BY validation_errors DESC, stage, error_type, domain, page_title LIMIT 20"""),
    "i06_domain_history": _sql(f"""SELECT created_at, component, stage, error_type, severity, message, url, exception_type, metadata
FROM error_logs WHERE domain = '{DOMAIN}' ORDER BY created_at DESC, component, stage, error_type, message LIMIT 50"""),
    "i07_domain_hourly_timeline": _sql(f"""SELECT date_trunc('hour', created_at) AS hour, component, count(*) AS error_count
FROM error_logs WHERE domain = '{DOMAIN}' AND {_age('48 hours')} GROUP BY ALL"""),
    "i08_common_timeouts": _sql(f"""SELECT component, stage, domain, TRY_CAST({_M('nav_timeout_ms')} AS INT) AS timeout_setting, count(*) AS timeout_count, max(created_at) AS latest
FROM error_logs WHERE error_type = 'timeout' AND {_age('7 days')} GROUP BY ALL
ORDER BY timeout_count DESC, component, stage, domain, timeout_setting NULLS FIRST LIMIT 20"""),
    "i09_json_parse_failures": _sql(f"""SELECT domain, count(*) AS parse_failures, max(created_at) AS latest_failure, avg(TRY_CAST({_M('response_length')} AS INT)) AS avg_response_length,
string_agg(DISTINCT {_M('page_title')}, ', ' ORDER BY {_M('page_title')}) AS affected_pages
FROM error_logs WHERE error_type = 'json_error' AND {_age('7 days')} GROUP BY domain"""),
    "i10_browser_errors": _sql(f"""SELECT domain, error_type, CAST(sum(n) AS BIGINT) AS error_count, max(latest) AS latest, arg_min(message, (-n, message)) AS most_common_message
FROM (SELECT domain, error_type, message, count(*) AS n, max(created_at) AS latest FROM error_logs
  WHERE error_type IN ('browser_error', 'navigation_error', 'timeout') AND component = 'crawler' AND {_age('7 days')} GROUP BY ALL) q
GROUP BY domain, error_type ORDER BY error_count DESC, domain, error_type LIMIT 20"""),
    "i11_daily_error_rate": _sql(f"""SELECT date_trunc('day', created_at)::TIMESTAMP AS day, component, error_type, count(*) AS error_count
FROM error_logs WHERE {_age('30 days')} GROUP BY ALL"""),
    "i12_new_vs_recurring": _sql("""SELECT domain, first_error,
CASE WHEN first_error > TIMESTAMP '2024-01-08 12:00:00' - INTERVAL '7 days' THEN 'New (< 7 days)'
  WHEN first_error > TIMESTAMP '2024-01-08 12:00:00' - INTERVAL '30 days' THEN 'Recent (< 30 days)' ELSE 'Recurring (> 30 days)' END AS error_age,
(SELECT count(*) FROM error_logs l WHERE l.domain = r.domain) AS total_errors
FROM (SELECT domain, min(created_at) AS first_error FROM error_logs WHERE severity IN ('error', 'critical') GROUP BY domain) r"""),
    "i13_timeout_config_analysis": _sql(f"""SELECT TRY_CAST({_M('nav_timeout_ms')} AS INT) AS timeout_ms, count(*) AS timeout_errors, count(DISTINCT domain) AS affected_domains,
round(avg(TRY_CAST({_M('attempt')} AS INT)), 1) AS avg_retry_attempt
FROM error_logs WHERE error_type = 'timeout' AND {_M('nav_timeout_ms')} IS NOT NULL AND {_age('7 days')} GROUP BY 1"""),
    "i14_job_validation_failures": _sql(f"""SELECT {_M('job_title')} AS failing_job_title, domain, count(*) AS validation_failures, max(message) AS error_message
FROM error_logs WHERE stage = 'validate_job' AND {_M('job_title')} IS NOT NULL AND {_age('7 days')} GROUP BY ALL
ORDER BY validation_failures DESC, failing_job_title, domain LIMIT 20"""),
    "i15_healthy_domains": _sql("""SELECT jf.domain, jobs_found, coalesce(error_count, 0) AS errors, round(jobs_found::DOUBLE / nullif(coalesce(error_count, 0), 0), 2) AS jobs_per_error
FROM jf LEFT JOIN je ON jf.domain = je.domain ORDER BY errors, jobs_found DESC, jf.domain LIMIT 20""", ERROR_LOGS_SQL, JOBS_SQL, _JE),
    "i16_critical_errors": _sql(f"""SELECT created_at, domain, component, stage, error_type, message, url, exception_type, metadata
FROM error_logs WHERE severity = 'critical' AND {_age('24 hours')}"""),
    "i17_failing_completely": _sql(f"""SELECT * FROM (SELECT domain, count(*) AS total_errors, count(DISTINCT date_trunc('hour', created_at)) AS error_hours,
min(created_at) AS first_error, max(created_at) AS latest_error, count(DISTINCT error_type) AS unique_error_types
FROM error_logs WHERE {_age('48 hours')} GROUP BY domain) s WHERE error_hours >= 4 AND total_errors >= 20"""),
    "i18_errors_per_domain_by_component": _sql(f"""SELECT component, count(DISTINCT domain) AS affected_domains, count(*) AS total_errors,
round(count(*)::DOUBLE / count(DISTINCT domain), 2) AS errors_per_domain FROM error_logs WHERE {_age('7 days')} GROUP BY component"""),
    "i19_errors_by_weekday": _sql(f"""SELECT dayname(created_at) AS day_of_week, CAST(dayofweek(created_at) AS INT) AS dow_num, count(*) AS error_count, count(DISTINCT domain) AS affected_domains
FROM error_logs WHERE {_age('30 days')} GROUP BY 1, 2"""),
    "i20_table_stats": _sql("SELECT count(*) AS total_errors, min(created_at) AS oldest_error, max(created_at) AS newest_error FROM error_logs"),
    "i21_retention": _sql(f"""SELECT created_at, domain, component, stage, error_type, severity,
CASE WHEN severity IN ('debug', 'info') AND created_at < {AS_OF_SQL} - INTERVAL '14 days' THEN 'purged'
  WHEN created_at < {AS_OF_SQL} - INTERVAL '20 days' THEN 'archived' ELSE 'kept' END AS fate FROM error_logs"""),
    "i22a_timeouts_by_domain_stage": _sql(f"SELECT domain, stage, count(*) AS timeout_count FROM error_logs WHERE error_type = 'timeout' AND {_age('7 days')} GROUP BY domain, stage"),
    "i22b_parse_failures_by_domain": _sql("SELECT domain, count(*) AS parse_failures FROM error_logs WHERE error_type = 'json_error' AND component = 'llm' GROUP BY domain"),
    "i23_healthy_domains_having": _sql("""SELECT jf.domain, jobs_found, coalesce(error_count, 0) AS errors FROM jf LEFT JOIN je ON jf.domain = je.domain
WHERE coalesce(error_count, 0) < 5""", ERROR_LOGS_SQL, JOBS_SQL, _JE),
    "i24_domain_error_rate_pct": _sql("""SELECT je.domain, error_count AS errors, coalesce(jobs_found, 0) AS jobs,
round(error_count::DOUBLE / (error_count + coalesce(jobs_found, 0)) * 100, 2) AS error_rate_pct
FROM je LEFT JOIN jf ON je.domain = jf.domain WHERE error_count > 5""", ERROR_LOGS_SQL, JOBS_SQL, _JE),
    "i25_error_summary": _sql("SELECT section, value, n, rank, round(n * 100.0 / (SELECT count(*) FROM error_logs), 1)::DOUBLE AS pct, first_at, last_at, span_hours FROM (SELECT s.*, "
        "CASE WHEN section = 'total' THEN (SELECT min(created_at) FROM error_logs) END AS first_at, "
        "CASE WHEN section = 'total' THEN (SELECT max(created_at) FROM error_logs) END AS last_at, "
        "CASE WHEN section = 'total' THEN (SELECT round((epoch_us(max(created_at)) - epoch_us(min(created_at))) / 3.6e9, 1) FROM error_logs) END AS span_hours FROM ("
        + _sections("", {"severity": ("severity", None), "component": ("component", None), "error_type": ("error_type", 10)}, "") + ") s) t"),
    "i26_by_domain": _sql("""SELECT domain, CAST(sum(c) AS BIGINT) AS total, arg_min(error_type, (-c, error_type)) AS top_type, max(latest) AS latest
FROM (SELECT domain, error_type, count(*) AS c, max(created_at) AS latest FROM error_logs GROUP BY ALL) q GROUP BY domain ORDER BY total DESC, domain LIMIT 30"""),
    "i27_by_stage": _sql("""SELECT component || ':' || stage AS stage_key, count(*) AS errors, count(DISTINCT domain) AS domains FROM error_logs
GROUP BY 1 ORDER BY errors DESC, stage_key LIMIT 20"""),
    "i28_critical_list": _sql(f"""SELECT created_at, severity, domain, component, stage, error_type, substring(message, 1, 100) AS message, url
FROM error_logs WHERE severity IN ('critical', 'error') ORDER BY {_NEWEST} LIMIT 20"""),
    "i29a_domain_detail": _sql(_sections(f"WHERE domain = '{DOMAIN}'", {
        "component": ("component", None), "stage": ("component || ':' || stage", 10), "error_type": ("error_type", None)}, "")),
    "i29b_domain_timeline": _sql(f"SELECT * EXCLUDE (stack_trace) FROM error_logs WHERE domain = '{DOMAIN}' ORDER BY {_NEWEST} LIMIT 10"),
    "a11_scan_errors": _sql(f"""SELECT * EXCLUDE (stack_trace) FROM error_logs WHERE created_at >= {AS_OF_SQL} - INTERVAL '240 hours' AND component = 'crawler'
AND severity = 'error' ORDER BY {_NEWEST} LIMIT 1000"""),
}
