"""The engine's tables derived from the test tables, for Spark and for DuckDB.

Expressions both engines read alike are written once; the few that differ come in pairs. Every
entity keeps all rows of the table it is made from.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.session import configure

AS_OF = dt.datetime(2024, 1, 31)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(exprs: dict[str, str]) -> str:
    return ",\n  ".join(f"{e} AS {n}" for n, e in exprs.items())


# ---- logs ----------------------------------------------------------------------------------

_DOMAIN = "'jobs.site' || CAST(user_id % 40 AS STRING) || '.example.com'"
ERROR_EXPRS = {
    "created_at": "ts",
    "domain": _DOMAIN,
    "component": "CASE WHEN event_type IN ('view', 'click') THEN 'crawler' WHEN event_type = 'error' THEN 'llm' "
                 "WHEN event_type = 'purchase' THEN 'db' ELSE 'utils' END",
    "severity": "CASE k % 5 WHEN 0 THEN 'debug' WHEN 1 THEN 'info' WHEN 2 THEN 'warning' WHEN 3 THEN 'error' ELSE 'critical' END",
    "error_type": "CASE WHEN event_type IN ('view', 'click') THEN CASE event_id % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'browser_error' "
                  "ELSE 'navigation_error' END WHEN event_type = 'error' THEN 'json_error' "
                  "WHEN event_type = 'purchase' THEN 'validation_error' ELSE 'unknown' END",
    "stage": "CASE WHEN event_type IN ('view', 'click') THEN 'navigate_seed' WHEN event_type = 'error' THEN 'parse_json' "
             "WHEN event_type = 'purchase' THEN 'validate_job' ELSE 'unknown' END",
    "message": "event_type || ' failed with code ' || CAST(k % 7 AS STRING)",
    "url": f"'https://' || {_DOMAIN} || '/careers'",
    "exception_type": "CASE k % 4 WHEN 0 THEN 'builtins.ValueError' WHEN 1 THEN 'net.ReadTimeout' WHEN 2 THEN 'json.DecodeError' END",
    "stack_trace": "CASE WHEN k % 3 <> 0 THEN 'Traceback ' || repeat('frame ', k * 40) END",
    "metadata": "'{\"page_title\":\"Page ' || CAST(k % 10 AS STRING) || '\",\"response_length\":' || CAST(k * 10 AS STRING) || "
                "',\"attempt\":' || CAST(1 + k % 3 AS STRING) || CASE WHEN k % 10 <> 0 THEN ',\"nav_timeout_ms\":' || "
                "CAST(15000 * (1 + k % 3) AS STRING) || ',\"job_title\":\"Job ' || CAST(k % 10 AS STRING) || '\"' ELSE '' END || '}'",
}
PROCESS_EXPRS = {
    "run_id": "CAST(user_id AS STRING)",
    "step": "CASE event_type WHEN 'view' THEN 'crawl_start' WHEN 'click' THEN 'crawl_complete' WHEN 'signup' THEN 'llm_start' "
            "WHEN 'error' THEN 'llm_complete' ELSE 'db_complete' END",
    "company": "CASE WHEN k % 9 = 0 THEN '  ' ELSE ' Site ' || CAST(user_id % 40 AS STRING) || ' ' END",
    "domain": "CASE WHEN k % 8 = 0 THEN CAST(NULL AS STRING) ELSE 'Jobs.Site' || CAST(user_id % 40 AS STRING) || '.example.com' END",
    "started_at": "ts",
    "status": "CASE WHEN k % 10 = 0 THEN 'in_progress' WHEN k % 10 = 1 THEN 'failed' WHEN k % 10 = 2 THEN 'odd' ELSE 'success' END",
    "metadata": "'{\"jobs_found\":' || CAST(k AS STRING) || '}'",
    "created_at": "ts",
    "jobs_found": "CASE WHEN k % 6 <> 0 THEN k END",
    "jobs_saved": "CASE WHEN k % 7 <> 0 THEN k END",
    "event_id": "event_id",
}
_K_SPARK = "TRY_CAST(get_json_object(props, '$.k') AS INT)"
_EVENTS_SQL = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"


def events_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Generated, so that a filter on columns made from k does not parse the JSON once per mention.
    return table(spark, sf_dir, "events").withColumn("k", F.explode(F.array(F.expr(_K_SPARK))))


def error_logs(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    events = (source if source is not None else table(spark, sf_dir, "events")).withColumn("k", F.expr(_K_SPARK))
    return events.select(*[F.expr(e).alias(n) for n, e in ERROR_EXPRS.items()])


ERROR_LOGS_SQL = f"error_logs AS (SELECT {_columns(ERROR_EXPRS)}\n  FROM {_EVENTS_SQL} e)"


def process_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.expr("CASE WHEN k % 10 <> 0 THEN timestampadd(MICROSECOND, CAST(round(value * 1000000) AS BIGINT), ts) END")
    return events_k(spark, sf_dir).select(*[F.expr(e).alias(n) for n, e in PROCESS_EXPRS.items()], end.alias("completed_at"))


PROCESS_LOGS_SQL = (
    f"process_logs AS (SELECT {_columns(PROCESS_EXPRS)},\n"
    "  CASE WHEN k % 10 <> 0 THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS completed_at\n"
    f"  FROM {_EVENTS_SQL} e)"
)


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_k(spark, sf_dir).select(
        F.col("user_id").alias("seed"), F.col("event_id").alias("seq"), F.col("event_type").alias("url"),
        F.sha1(F.concat("event_type", F.col("k").cast("string"))).alias("text_fp"),
        F.col("k").alias("job_count"), (F.col("k") * 10).alias("scroll_h"), "ts", "value",
    )


FINGERPRINTS_SQL = (
    "fingerprints AS (SELECT user_id AS seed, event_id AS seq, event_type AS url, sha1(event_type || CAST(k AS STRING)) AS text_fp,\n"
    f"  k AS job_count, k * 10 AS scroll_h, ts, value FROM {_EVENTS_SQL} e)"
)

# ---- postings ------------------------------------------------------------------------------

_BUCKETS = (
    "intern,internship,co-op,coop,entry,new grad,new_grad,junior,jr,mid,mid-level,mid level,midlevel,senior,sr,staff,"
    "principal,director,vp,vice president,head,executive,cxo,c-level,c level,ceo,Cto,guru"
)
_JAVA = ["yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss",
         "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy"]
_C = ["%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%d/%m/%Y", "%m/%d/%Y", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S",
      "%B %-d, %Y", "%b %-d, %Y", "%-d %B %Y", "%-d %b %Y"]
POSTED_SPARK = "CASE l_partkey % 11 " + " ".join(
    f"WHEN {i} THEN date_format(l_shipdate, \"{f}\")" for i, f in enumerate(_JAVA)) + " END"
POSTED_SQL = "CASE l_partkey % 11 " + " ".join(f"WHEN {i} THEN strftime(l_shipdate, '{f}')" for i, f in enumerate(_C)) + " END"

RAW_JOB_EXPRS = {
    "page": "l_suppkey",
    # Unique within a page: the line number alone repeats within an order.
    "pos": "(l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey % 1000000",
    "job_url": "CASE WHEN l_linenumber <> 3 THEN '/jobs/' || CAST(l_partkey AS STRING) END",
    "requisition_id": "CASE WHEN l_linenumber IN (2, 3) THEN 'REQ' || CAST(l_partkey AS STRING) END",
    "title": "'  ' || replace(p_name, ' ', '   ') || '  '",
    "company": "CASE WHEN l_linenumber = 4 THEN '   ' ELSE s_name END",
    "location": "n_name",
    "employment_type": "CASE l_returnflag WHEN 'A' THEN 'Full-time' WHEN 'N' THEN ' ' END",
    "seniority_bucket": f"split_part('{_BUCKETS}', ',', CAST(p_size % 28 + 1 AS INT))",
    "seniority_level": "CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END",
}
# Keys of the open map per line number; blank values are dropped by cleaning.
EXTRA_SPARK = (
    "CASE l_linenumber WHEN 5 THEN map('job_id', 'J' || CAST(l_partkey AS STRING), 'apply_url', ' /a ', 'job_family', 'f', 'other', 'x') "
    "WHEN 6 THEN map('job_id', ' ', 'job_description', 'd') END"
)
EXTRA_SIZE_SQL = "CASE l_linenumber WHEN 5 THEN 3 WHEN 6 THEN 1 ELSE 0 END"
JOB_DOMAIN = "'jobs.site' || CAST(l_suppkey % 60 AS STRING) || '.example.com'"
_FROM_SQL = "lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"


def postings_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with part, supplier and nation. Which sides are small enough to broadcast is left to
    the session's size threshold."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    seller = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    # The text work that follows is heavy; the test table is a single row group.
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(seller, F.col("l_suppkey") == F.col("s_suppkey"))


def raw_jobs(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return postings_base(spark, sf_dir).select(
        *[F.expr(e).alias(n) for n, e in RAW_JOB_EXPRS.items()],
        F.expr(POSTED_SPARK).alias("date_posted"), F.expr(EXTRA_SPARK).alias("extra"), *more,
    )


RAW_JOBS_SQL = (
    f"raw_jobs AS (SELECT {_columns(RAW_JOB_EXPRS)},\n  {POSTED_SQL} AS date_posted, {EXTRA_SIZE_SQL} AS extra_size,\n"
    f"  l_partkey, l_suppkey, l_shipdate, l_linenumber FROM {_FROM_SQL})"
)

# Cleaned postings in SQL: the same rules, written for DuckDB.
_WS = r"[\t-\r\x1c-\x1f\x85\p{Z}]+"
_squash = lambda c: f"trim(regexp_replace({c}, '{_WS}', ' ', 'g'))"
CLEAN_JOBS_SQL = RAW_JOBS_SQL + f""",
clean_jobs AS (SELECT page, pos, nullif({_squash('job_url')}, '') AS job_url, nullif({_squash('requisition_id')}, '') AS requisition_id,
  nullif({_squash('title')}, '') AS title, nullif({_squash('company')}, '') AS company, nullif({_squash('location')}, '') AS location,
  nullif({_squash('employment_type')}, '') AS employment_type, nullif({_squash('date_posted')}, '') AS date_posted,
  coalesce(nullif({_squash('seniority_level')}, ''), 'Unknown') AS seniority_level,
  CASE WHEN lower(seniority_bucket) IN ('intern', 'internship', 'co-op', 'coop') THEN 'intern'
    WHEN lower(seniority_bucket) IN ('entry', 'new grad', 'new_grad', 'junior', 'jr') THEN 'entry'
    WHEN lower(seniority_bucket) IN ('mid', 'mid-level', 'mid level', 'midlevel') THEN 'mid'
    WHEN lower(seniority_bucket) IN ('senior', 'sr', 'staff', 'principal') THEN 'senior'
    WHEN lower(seniority_bucket) IN ('director', 'vp', 'vice president', 'head', 'director_vp') THEN 'director_vp'
    WHEN lower(seniority_bucket) IN ('executive', 'cxo', 'c-level', 'c level', 'ceo', 'cto', 'cfo') THEN 'executive'
    ELSE 'unknown' END AS seniority_bucket,
  extra_size, l_partkey, l_suppkey FROM raw_jobs),
signed_jobs AS (SELECT *,
  CASE WHEN coalesce(job_url, '') <> '' THEN 'url::' || lower(job_url)
    WHEN coalesce(requisition_id, '') <> '' THEN 'rid::' || lower(requisition_id)
    ELSE 'tl::' || lower(coalesce(title, '')) || '@@' || lower(coalesce(location, '')) END AS sig,
  CAST((title IS NOT NULL)::INT + (job_url IS NOT NULL)::INT + (company IS NOT NULL)::INT + (location IS NOT NULL)::INT
    + (employment_type IS NOT NULL)::INT + (date_posted IS NOT NULL)::INT + (requisition_id IS NOT NULL)::INT
    + (seniority_level IS NOT NULL)::INT + (seniority_bucket IS NOT NULL)::INT + extra_size AS INT) AS score
  FROM clean_jobs),
deduped_jobs AS (SELECT * EXCLUDE (pos, rn), first_pos AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY page, sig ORDER BY score DESC, pos) AS rn,
    min(pos) OVER (PARTITION BY page, sig) AS first_pos, count(*) OVER (PARTITION BY page, sig) AS copies FROM signed_jobs) WHERE rn = 1)"""


def jobs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A jobs table for the reports: one row per line item, some URLs repeated."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr(JOB_DOMAIN).alias("source_domain"),
        F.expr(f"'https://' || {JOB_DOMAIN} || '/jobs/' || CAST(l_partkey AS STRING)").alias("job_url"),
        F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00' - make_dt_interval(CAST(l_partkey % 14 AS INT))").alias("last_seen_at"),
    )


JOBS_SQL = (
    f"jobs AS (SELECT {JOB_DOMAIN} AS source_domain, 'https://' || {JOB_DOMAIN} || '/jobs/' || CAST(l_partkey AS STRING) AS job_url,\n"
    f"  {AS_OF_SQL} - to_days(CAST(l_partkey % 14 AS INT)) AS last_seen_at FROM lineitem)"
)
