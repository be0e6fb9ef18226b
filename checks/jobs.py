"""Postings: cleaning, deduplication, dates, validation, upsert, enrichment (families E, F, G, K)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.entities import (
    AS_OF, AS_OF_SQL, CLEAN_JOBS_SQL, JOB_DOMAIN, RAW_JOBS_SQL, _squash, postings_base, raw_jobs, table,
)
from postings.operators import dates as D
from postings.operators import enrich as K
from postings.operators import normalize as N
from postings.operators import upsert as G
from postings.operators.urls import incomplete_urls
from postings.schemas import JOBS
from postings.session import exchanges_leave, scratch_dir
from postings.sources.job_table import append_jobs, read_jobs, replace_jobs

# A rare flag on line items, so that some pages are hit and others are not.
_RARE = "(l_quantity = 50 AND l_linenumber = 7 AND l_discount > 0.085)"

_KEPT = ["page", "pos", "title", "job_url", "company", "location", "employment_type", "date_posted", "requisition_id",
         "seniority_level", "seniority_bucket"]


def e01(spark, sf):
    return N.normalize_whitespace(raw_jobs(spark, sf)).select("page", "pos", "title", "company", "employment_type", "seniority_level", "date_posted")


def e02(spark, sf):
    return N.normalize_seniority(raw_jobs(spark, sf)).select("page", "pos", "seniority_bucket", "seniority_level")


def e03(spark, sf):
    return N.omit_empty(raw_jobs(spark, sf)).select(
        "page", "pos", "title", "company", "employment_type", "seniority_level",
        F.coalesce(F.size("extra"), F.lit(-1)).alias("extra_size"))


def e04(spark, sf):
    listed = postings_base(spark, sf).select(
        F.col("l_suppkey").alias("page"), F.expr("l_orderkey * 10 + l_linenumber").alias("pos"),
        F.expr("CASE WHEN l_linenumber < 5 THEN array(' ' || n_name || ' ', '  ', s_name, CAST(NULL AS STRING)) "
               "WHEN l_linenumber = 5 THEN array(' ') END").alias("location"))
    return N.canonical_location(listed)


def e05(spark, sf):
    return N.job_signature(raw_jobs(spark, sf)).select("page", "pos", "sig")


def e06(spark, sf):
    return N.clean_jobs(raw_jobs(spark, sf)).select("page", "pos", "sig", "score")


def e07(spark, sf):
    return N.normalize_and_dedupe(raw_jobs(spark, sf)).select(*_KEPT, "sig", "score", "copies")


def e08(spark, sf):
    return N.dedupe_stats(N.normalize_and_dedupe(raw_jobs(spark, sf)))


def e09(spark, sf):
    flagged = raw_jobs(spark, sf, F.expr(_RARE).alias("failed"))
    return N.normalize_with_fallback(flagged, failed="failed").select("page", "pos", "title", "job_url", "company", "warning")


def _finalized(spark, sf):
    deduped = N.normalize_and_dedupe(raw_jobs(spark, sf))
    return N.finalize_job_urls(deduped.withColumns({
        "source_url": F.expr("CASE WHEN page % 3 = 0 THEN '' ELSE 'https://host' || CAST(page AS STRING) || '.example.com/careers/list' END"),
        "domain": F.expr("CASE WHEN page % 6 = 0 THEN '' ELSE 'alt' || CAST(page AS STRING) || '.example.com' END"),
    }))


def e10(spark, sf):
    return _finalized(spark, sf)[0].select("page", "pos", "job_url")


def e10b(spark, sf):
    return _finalized(spark, sf)[1].select("page", "pos", "job_url")


def e10c(spark, sf):
    """Missing and relative URLs among raw postings."""
    return incomplete_urls(raw_jobs(spark, sf)).select("page", "pos", "job_url")


def f01(spark, sf):
    return D.parse_posted_date(raw_jobs(spark, sf), "date_posted").select("page", "pos", "date_posted", "posted_at")


_RELATIVE = (
    "CASE l_linenumber WHEN 1 THEN 'Posted Today' WHEN 2 THEN 'yesterday' WHEN 3 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ' days ago' "
    "WHEN 4 THEN 'about ' || CAST(CAST(l_quantity AS INT) AS STRING) || 'weeks ago' WHEN 5 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ' Month ago' "
    "WHEN 6 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ' years  ago' ELSE 'recently' END"
)


def _relative(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(_RELATIVE).alias("phrase"), "l_shipdate",
        F.expr("CASE WHEN l_partkey % 2 = 0 THEN date_format(l_shipdate, 'dd/MM/yyyy') ELSE " + _RELATIVE + " END").alias("mixed"))


def f02(spark, sf):
    return D.parse_relative_date(_relative(spark, sf), "phrase", AS_OF).select("l_orderkey", "l_linenumber", "phrase", "posted_at")


def f03(spark, sf):
    return D.filter_recent(table(spark, sf, "events"), "ts", AS_OF - dt.timedelta(days=3), days=10).select("event_id", "ts")


def f04(spark, sf):
    out = D.format_dates(table(spark, sf, "events"), "ts", out="day")
    return D.format_dates(out, "ts", "yyyy-MM-dd'T'HH:mm:ss", out="stamp").select("event_id", "day", "stamp")


def f05(spark, sf):
    return D.resolve_posted_date(_relative(spark, sf), "mixed", "l_shipdate", AS_OF).select("l_orderkey", "l_linenumber", "mixed", "posted_at")


def _typed(spark, sf, *more):
    """Postings as they come out of cleaning, with some faults, before validation."""
    return raw_jobs(
        spark, sf, F.expr(JOB_DOMAIN).alias("domain"), F.expr(_RARE).alias("rare"), "l_linestatus", *more,
    ).withColumns({
        "title": F.when(F.col("employment_type") == " ", F.lit("   ")).otherwise(F.col("title")),
        "source_url": F.concat(F.lit("https://"), "domain", F.lit("/careers")),
        "page_title": F.concat(F.lit("Jobs at "), "company"),
        "type_errors": F.when(F.col("rare"), F.array(F.lit("company"))).otherwise(F.array().cast("array<string>")),
    })


def g02(spark, sf):
    valid, rejected = G.validate_jobs(_typed(spark, sf))
    cols = ["page", "pos", "job_url", "title"]
    return valid.select(*cols, F.lit("").alias("reasons")).unionByName(rejected.select(*cols, F.array_join("reasons", ",").alias("reasons")))


def g02b(spark, sf):
    _, rejected = G.validate_jobs(_typed(spark, sf))
    return G.rejected_to_errors(rejected).select("domain", "url", "message", "component", "stage", "severity",
                                                 F.get_json_object("metadata", "$.job_title").alias("job_title"))


def g03(spark, sf):
    flagged = raw_jobs(spark, sf, F.expr(_RARE).alias("rare")).withColumn(
        "job_url", F.when(F.col("rare"), F.lit(" ")).otherwise(F.coalesce("job_url", "requisition_id")))
    ok, failed = G.validate_page_strict(flagged)
    return ok.groupBy("page").agg(F.count(F.lit(1)).alias("n")).withColumn("first_bad", F.lit(None).cast("bigint")).unionByName(
        failed.select("page", F.lit(None).cast("bigint").alias("n"), F.col("pos").alias("first_bad")))


def g04(spark, sf):
    jobs = raw_jobs(spark, sf).withColumn("country", F.when(F.col("company").isNotNull() & (F.trim("company") != ""), F.col("location")))
    return G.apply_job_defaults(jobs.withColumn("seniority_level", F.nullif("seniority_level", F.lit("")))).select(
        "page", "pos", "country", "seniority_level", "seniority_bucket")


def g05(spark, sf):
    valid, _ = G.validate_jobs(_typed(spark, sf))
    records = G.build_job_records(G.apply_job_defaults(valid.withColumn("country", F.lit(None).cast("string"))), AS_OF, keep_posted_date=True)
    return records.select("job_url", "title", "company", "source_domain", "source_page_url", "source_page_title", "date_posted_raw",
                          "pos", "last_seen_at", F.get_json_object("raw_job", "$.title").alias("raw_title"),
                          F.get_json_object("raw_job", "$.apply_url").alias("raw_apply"),
                          F.get_json_object("raw_extra", "$.other").alias("extra_other"))


def g06(spark, sf):
    return G.promote_extra_fields(raw_jobs(spark, sf)).select("page", "pos", "job_id", "apply_url", "job_description", "job_family")


def _records(spark, sf, status):
    """Job records of the lines with one status: "F" was crawled before, "O" is the new batch."""
    jobs = _typed(spark, sf).filter(F.col("l_linestatus") == status)
    absolute = jobs.withColumn("job_url", F.concat(F.lit("https://"), "domain", "job_url"))
    valid, rejected = G.validate_jobs(absolute)
    return G.build_job_records(G.apply_job_defaults(valid.withColumn("country", F.lit(None).cast("string"))), AS_OF), rejected


def _current(spark, sf):
    """The stored table: some postings without a first-seen time."""
    old = G.dedupe_batch(_records(spark, sf, "F")[0])
    number = F.regexp_extract("job_url", r"(\d+)$", 1).cast("bigint")
    return old.withColumns({
        "last_seen_at": F.lit(AS_OF - dt.timedelta(days=14)).cast("timestamp"),
        "first_seen_at": F.when(number % 50 != 0, F.lit(AS_OF - dt.timedelta(days=44)).cast("timestamp")),
    })


def g07(spark, sf):
    batch = G.dedupe_batch(_records(spark, sf, "O")[0])
    return G.match_existing(batch, _current(spark, sf)).select("job_url", "is_new", "existing_first_seen")


_UPSERTED = ["job_url", "title", "company", "seniority_bucket", "source_domain", "first_seen_at", "last_seen_at"]


def g08(spark, sf):
    batch = G.dedupe_batch(_records(spark, sf, "O")[0])
    return G.upsert_jobs(_current(spark, sf), batch, AS_OF).select(*_UPSERTED)


def g08b(spark, sf):
    """The same through the bucketed table: batches of a fifth each, some buckets merged on the way."""
    root = scratch_dir(spark, "job-table")
    replace_jobs(_current(spark, sf), root, buckets=16)
    incoming = scratch_dir(spark, "job-batch")
    with exchanges_leave(spark):
        G.dedupe_batch(_records(spark, sf, "O")[0]).write.parquet(incoming)
    for part in range(5):
        append_jobs(spark.read.parquet(incoming).filter(F.pmod(F.crc32("job_url"), F.lit(5)) == part), root, AS_OF, tag=f"batch-{part}", max_deltas=3)
    return read_jobs(spark, root).select(*_UPSERTED)


def g09(spark, sf):
    both = [_records(spark, sf, status) for status in "FO"]
    return G.upsert_summary(both[0][0].unionByName(both[1][0]), both[0][1].unionByName(both[1][1]))


_LOCATION = (
    "CASE c_custkey % 26 WHEN 0 THEN 'San Francisco, CA' WHEN 1 THEN 'Remote in United States' WHEN 2 THEN n_name || ', UK' "
    "WHEN 3 THEN 'Amsterdam,  Netherlands ' WHEN 4 THEN 'Offices: ' || c_name || ', Germany and France' WHEN 5 THEN 'Remote' "
    "WHEN 6 THEN n_name || ', canada' WHEN 7 THEN c_mktsegment || ', TX' WHEN 8 THEN n_name WHEN 9 THEN 'Georgia, GA, U.S.' "
    "WHEN 10 THEN 'Albuquerque, New Mexico' WHEN 11 THEN 'Jersey City, New Jersey' WHEN 12 THEN 'Atlanta, Georgia' WHEN 13 THEN 'Berlin, DE' "
    "WHEN 14 THEN 'Toronto, CA' WHEN 15 THEN 'Chennai, IN' WHEN 16 THEN 'Bogotá, CO' WHEN 17 THEN 'Indianapolis, Indiana' WHEN 18 THEN 'Tbilisi, Georgia' "
    "WHEN 19 THEN 'Dover, DE' WHEN 20 THEN 'Remote - New Mexico or Mexico' WHEN 21 THEN 'Kraków, PL' WHEN 22 THEN c_name || ' / ' || n_name "
    "WHEN 23 THEN 'Mexico, MO' WHEN 24 THEN 'Paris, FRA' WHEN 25 THEN n_name || ' New ' || n_name END"
)
_ROLES = (
    "Software Engineer,Senior Software Engineer,Staff Engineer,ML Engineer,Product Designer,SWE Intern,VP of Sales,"
    "Engineering Manager,Data Scientist,Security Analyst,Program Manager,Customer Support Lead,Account Executive,Growth Marketing,"
    "Accountant,Recruiter,Legal Counsel,Research Fellow,Logistics Coordinator,CTO,Junior Developer,Barista,Head of People,New Grad UX"
)
_TITLE = f"split_part('{_ROLES}', ',', CAST(p_partkey % 24 + 1 AS INT)) || ' ' || p_name"


def k01(spark, sf):
    customers = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return K.infer_country(customers.select("c_custkey", F.expr(_LOCATION).alias("location")))


def k02(spark, sf):
    return K.infer_category(table(spark, sf, "part").select("p_partkey", F.expr(_TITLE).alias("title")))


def k03(spark, sf):
    parts = K.infer_seniority(table(spark, sf, "part").select("p_partkey", F.expr(_TITLE).alias("title")))
    return parts.withColumn("normalized", N.seniority_bucket(F.col("seniority_bucket")))


def k04(spark, sf):
    return K.clean_description(table(spark, sf, "pages"), "html").select("page_id", "job_description")


QUERIES = {
    "e01_normalize_whitespace": e01, "e02_normalize_seniority": e02, "e03_omit_empty": e03, "e04_canonical_location": e04,
    "e05_job_signature": e05, "e06_richness_score": e06, "e07_dedupe_jobs": e07, "e08_dedupe_stats": e08,
    "e09_normalize_fallback": e09, "e10a_finalize_job_urls": e10, "e10b_finalize_report": e10b, "e10c_incomplete_urls": e10c,
    "f01_parse_posted_date": f01, "f02_parse_relative_date": f02, "f03_filter_recent": f03, "f04_format_dates": f04,
    "f05_resolve_posted_date": f05,
    "g02a_validate_jobs": g02, "g02b_rejected_to_errors": g02b, "g03_validate_page_strict": g03, "g04_apply_job_defaults": g04,
    "g05_build_job_records": g05, "g06_promote_extra_fields": g06, "g07_match_existing": g07, "g08a_upsert_jobs": g08,
    "g08b_upsert_small_batch": g08b, "g09_upsert_summary": g09,
    "k01_infer_country": k01, "k02_infer_category": k02, "k03_infer_seniority": k03, "k04_clean_description": k04,
}

# ---- SQL -----------------------------------------------------------------------------------

_RAW = "WITH " + RAW_JOBS_SQL.replace("l_linenumber FROM", f"l_linenumber, l_linestatus, {_RARE} AS rare, {JOB_DOMAIN} AS domain FROM")
_CLEAN = "WITH " + CLEAN_JOBS_SQL
_TRY = (
    "coalesce(try_strptime(date_posted, '%Y-%m-%d'), try_strptime(date_posted, '%Y/%m/%d'), try_strptime(date_posted, '%d-%m-%Y'), "
    "try_strptime(date_posted, '%d/%m/%Y'), try_strptime(date_posted, '%m/%d/%Y'), try_strptime(date_posted, '%Y-%m-%dT%H:%M:%S'), "
    "try_strptime(date_posted, '%Y-%m-%d %H:%M:%S'), try_strptime(date_posted, '%B %d, %Y'), try_strptime(date_posted, '%b %d, %Y'), "
    "try_strptime(date_posted, '%d %B %Y'), try_strptime(date_posted, '%d %b %Y'))"
)


def _relative_sql(c: str) -> str:
    number = f"TRY_CAST(regexp_extract(lower({c}), '([0-9]+)\\s*(day|week|month|year)s?\\s*ago', 1) AS INT)"
    unit = f"regexp_extract(lower({c}), '([0-9]+)\\s*(day|week|month|year)s?\\s*ago', 2)"
    days = f"{number} * CASE {unit} WHEN 'day' THEN 1 WHEN 'week' THEN 7 WHEN 'month' THEN 30 WHEN 'year' THEN 365 END"
    return (f"CASE WHEN contains(lower({c}), 'today') THEN {AS_OF_SQL} WHEN contains(lower({c}), 'yesterday') THEN {AS_OF_SQL} - INTERVAL '1 day' "
            f"WHEN {unit} <> '' THEN {AS_OF_SQL} - to_days(CAST({days} AS INT)) END")


_MIXED = "CASE WHEN l_partkey % 2 = 0 THEN strftime(l_shipdate, '%d/%m/%Y') ELSE " + _RELATIVE + " END"
_TYPED = _RAW + """,
typed AS (SELECT * REPLACE (CASE WHEN employment_type = ' ' THEN '   ' ELSE title END AS title),
  'https://' || domain || '/careers' AS source_url, 'Jobs at ' || company AS page_title FROM raw_jobs),
checked AS (SELECT *, concat_ws(',', CASE WHEN coalesce(trim(job_url), '') = '' THEN 'job_url' END, CASE WHEN trim(title) = '' THEN 'title' END,
  CASE WHEN rare THEN 'company' END) AS reasons FROM typed)"""
_RECORDS = _TYPED + """,
records AS (SELECT 'https://' || domain || trim(job_url) AS job_url, trim(title) AS title, trim(company) AS company,
  CASE WHEN seniority_bucket IN ('intern', 'entry', 'mid', 'senior', 'director_vp', 'executive', 'unknown') THEN seniority_bucket ELSE 'unknown' END AS seniority_bucket,
  domain AS source_domain, l_linestatus, pos,
  (nullif(title, NULL) IS NOT NULL)::INT + (company IS NOT NULL)::INT + (employment_type IS NOT NULL)::INT AS filled, source_url
  FROM checked WHERE reasons = ''),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_linestatus, job_url ORDER BY filled DESC, pos) AS rn FROM records),
batch AS (SELECT * FROM ranked WHERE l_linestatus = 'O' AND rn = 1),
current_jobs AS (SELECT *, CASE WHEN CAST(regexp_extract(job_url, '([0-9]+)$', 1) AS BIGINT) % 50 <> 0 THEN TIMESTAMP '2024-01-31' - INTERVAL '44 days' END AS first_seen_at,
  TIMESTAMP '2024-01-31' - INTERVAL '14 days' AS last_seen_at FROM ranked WHERE l_linestatus = 'F' AND rn = 1)"""
_UPSERT = _RECORDS + """
SELECT coalesce(n.job_url, o.job_url) AS job_url, coalesce(n.title, o.title) AS title, coalesce(n.company, o.company) AS company,
  coalesce(n.seniority_bucket, o.seniority_bucket) AS seniority_bucket, coalesce(n.source_domain, o.source_domain) AS source_domain,
  CASE WHEN o.job_url IS NOT NULL THEN o.first_seen_at ELSE TIMESTAMP '2024-01-31' END AS first_seen_at,
  CASE WHEN n.job_url IS NOT NULL THEN TIMESTAMP '2024-01-31' ELSE o.last_seen_at END AS last_seen_at
FROM current_jobs o FULL JOIN batch n ON o.job_url = n.job_url"""


def _country_sql() -> str:
    text = _squash("location")
    last = f"trim(split_part({text}, ',', -1))"
    accents = K._ACCENTS
    normal = lambda c: f"trim(regexp_replace(translate(lower({c}), '{accents[0]}', '{accents[1]}'), '[^\\p{{L}}]+', ' ', 'g'))"
    quoted = lambda items: ", ".join(f"'{i}'" for i in items)
    # Of all countries and codes, those that occur in the rows besides the common ones.
    names = [*K.COUNTRIES, "Algeria", "Ethiopia", "Iran", "Iraq", "Jordan", "Morocco", "Mozambique", "Peru", "Russia"]
    states = [n for n in K.US_STATE_NAMES if n != "Georgia"]
    named = {K.normal_name(n): n for n in names} | {K.normal_name(n): "United States" for n in states}
    codes = {"CA": "Canada", "DE": "Germany", "IN": "India", "CO": "Colombia", "PL": "Poland", "FRA": "France"}
    head = f"left({text}, length({text}) - length(split_part({text}, ',', -1)))"
    city = lambda code: f"regexp_matches(' ' || {normal(head)} || ' ', ' (?:{'|'.join(map(K.normal_name, K.CITIES[code]))}) ')"
    abroad = " ".join(f"WHEN {last} = '{c}' AND {city(c)} THEN '{codes[c]}'" for c in ("CA", "DE", "IN", "CO"))
    alias = " ".join(f"WHEN {normal(last)} IN ({quoted(map(K.normal_name, a))}) THEN '{c}'" for c, a in K.COUNTRY_ALIASES.items())
    full = " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in named.items())
    code = " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in codes.items())
    longest = "|".join(sorted(named, key=len, reverse=True))
    mention = f"regexp_extract(' ' || {normal('location')} || ' ', ' ({longest}) ', 1)"
    return (f"coalesce(CASE WHEN {last} IN ({quoted(K.US_STATES)}) AND contains({text}, ',') THEN CASE {abroad} ELSE 'United States' END END, "
            f"CASE {alias} END, CASE WHEN {normal(last)} = 'georgia' THEN CASE WHEN contains({text}, ',') AND NOT {city('GE')} THEN 'United States' ELSE 'Georgia' END END, "
            f"CASE {normal(last)} {full} END, CASE {last} {code} END, CASE {mention} {full} END, 'Unknown')")


def _rules_sql(text: str, rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{v}'" for v, p in rules) + f" ELSE '{default}' END"


_DROP_TAGS = "(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<noscript\\b.*?</noscript\\s*>|<template\\b.*?</template\\s*>"
_SENIORITY = _rules_sql("lower(title)", K.SENIORITY_RULES, "mid")

_FINAL = _CLEAN + """, done AS (SELECT page, pos, CASE WHEN job_url IS NULL THEN NULL
  WHEN page % 3 <> 0 THEN 'https://host' || page || '.example.com' || job_url WHEN page % 6 <> 0 THEN 'https://alt' || page || '.example.com' || job_url
  ELSE job_url END AS job_url FROM deduped_jobs)"""

ORACLES = {
    "e01_normalize_whitespace": _RAW + f"""
SELECT page, pos, {_squash('title')} AS title, {_squash('company')} AS company, {_squash('employment_type')} AS employment_type,
  {_squash('seniority_level')} AS seniority_level, date_posted FROM raw_jobs""",
    "e02_normalize_seniority": _CLEAN + " SELECT page, pos, seniority_bucket, seniority_level FROM clean_jobs",
    "e03_omit_empty": _RAW + """
SELECT page, pos, trim(title) AS title, nullif(trim(company), '') AS company, nullif(trim(employment_type), '') AS employment_type,
  nullif(seniority_level, '') AS seniority_level, CAST(CASE l_linenumber WHEN 5 THEN 4 WHEN 6 THEN 1 ELSE -1 END AS INT) AS extra_size FROM raw_jobs""",
    "e04_canonical_location": f"""SELECT l_suppkey AS page, l_orderkey * 10 + l_linenumber AS pos,
  CASE WHEN l_linenumber < 5 THEN n_name || ', ' || s_name END AS location
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "e05_job_signature": _RAW + f"""
SELECT page, pos, CASE WHEN job_url IS NOT NULL THEN 'url::' || lower(job_url) WHEN requisition_id IS NOT NULL THEN 'rid::' || lower(requisition_id)
  ELSE 'tl::' || lower({_squash('title')}) || '@@' || lower(location) END AS sig FROM raw_jobs""",
    "e06_richness_score": _CLEAN + " SELECT page, pos, sig, score FROM signed_jobs",
    "e07_dedupe_jobs": _CLEAN + f" SELECT {', '.join(_KEPT)}, sig, score, copies FROM deduped_jobs",
    "e08_dedupe_stats": _CLEAN + """ SELECT page, count(*) AS input_jobs, count(DISTINCT sig) AS deduped_out, count(*) - count(DISTINCT sig) AS duplicates_removed
FROM signed_jobs GROUP BY page""",
    "e09_normalize_fallback": _CLEAN + f""", bad AS (SELECT DISTINCT l_suppkey AS page FROM lineitem WHERE {_RARE})
SELECT page, pos, title, job_url, company, NULL AS warning FROM deduped_jobs WHERE page NOT IN (SELECT page FROM bad)
UNION ALL SELECT page, pos, title, job_url, company, 'normalize_error' FROM raw_jobs WHERE page IN (SELECT page FROM bad)""",
    "e10a_finalize_job_urls": _FINAL + " SELECT page, pos, job_url FROM done",
    "e10b_finalize_report": _FINAL + " SELECT page, pos, job_url FROM done WHERE NOT starts_with(job_url, 'http')",
    "e10c_incomplete_urls": _RAW + " SELECT page, pos, job_url FROM raw_jobs WHERE coalesce(NOT starts_with(job_url, 'http'), TRUE)",
    "f01_parse_posted_date": _RAW + f" SELECT page, pos, date_posted, {_TRY} AS posted_at FROM raw_jobs",
    "f02_parse_relative_date": f"SELECT l_orderkey, l_linenumber, phrase, {_relative_sql('phrase')} AS posted_at FROM (SELECT l_orderkey, l_linenumber, {_RELATIVE} AS phrase FROM lineitem) q",
    "f03_filter_recent": f"SELECT event_id, ts FROM events WHERE {AS_OF_SQL} - INTERVAL '3 days' - ts <= INTERVAL '10 days'",
    "f04_format_dates": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM events",
    "f05_resolve_posted_date": f"SELECT l_orderkey, l_linenumber, mixed, coalesce(try_strptime(mixed, '%d/%m/%Y'), {_relative_sql('mixed')}, l_shipdate) AS posted_at "
                               f"FROM (SELECT l_orderkey, l_linenumber, l_shipdate, {_MIXED} AS mixed FROM lineitem) q",
    "g02a_validate_jobs": _TYPED + " SELECT page, pos, CASE WHEN reasons = '' THEN trim(job_url) ELSE job_url END AS job_url, CASE WHEN reasons = '' THEN trim(title) ELSE title END AS title, reasons FROM checked",
    "g02b_rejected_to_errors": _TYPED + " SELECT domain, source_url AS url, 'invalid job: ' || replace(reasons, ',', ', ') AS message, 'db' AS component, 'validate_job' AS stage, 'warning' AS severity, title AS job_title FROM checked WHERE reasons <> ''",
    "g03_validate_page_strict": _RAW + """
SELECT page, CASE WHEN count(*) FILTER (WHERE bad) = 0 THEN count(*) END AS n, min(pos) FILTER (WHERE bad) AS first_bad
FROM (SELECT *, rare OR coalesce(job_url, requisition_id) IS NULL AS bad FROM raw_jobs) q GROUP BY page""",
    "g04_apply_job_defaults": _RAW + """
SELECT page, pos, CASE WHEN trim(company) <> '' THEN location ELSE 'Unknown' END AS country, coalesce(nullif(seniority_level, ''), 'Unknown') AS seniority_level,
  CASE WHEN seniority_bucket IN ('intern', 'entry', 'mid', 'senior', 'director_vp', 'executive', 'unknown') THEN seniority_bucket ELSE 'unknown' END AS seniority_bucket FROM raw_jobs""",
    "g05_build_job_records": _TYPED + """
SELECT trim(job_url) AS job_url, trim(title) AS title, trim(company) AS company, domain AS source_domain, source_url AS source_page_url, page_title AS source_page_title,
  date_posted AS date_posted_raw, pos, TIMESTAMP '2024-01-31' AS last_seen_at, trim(title) AS raw_title, CAST(NULL AS VARCHAR) AS raw_apply,
  CASE WHEN l_linenumber = 5 THEN 'x' END AS extra_other FROM checked WHERE reasons = ''""",
    "g06_promote_extra_fields": _RAW + """
SELECT page, pos, CASE l_linenumber WHEN 5 THEN 'J' || l_partkey WHEN 6 THEN ' ' END AS job_id, CASE l_linenumber WHEN 5 THEN ' /a ' END AS apply_url,
  CASE l_linenumber WHEN 6 THEN 'd' END AS job_description, CASE l_linenumber WHEN 5 THEN 'f' END AS job_family FROM raw_jobs""",
    "g07_match_existing": _RECORDS + " SELECT n.job_url, o.job_url IS NULL AS is_new, o.first_seen_at AS existing_first_seen FROM batch n LEFT JOIN current_jobs o ON n.job_url = o.job_url",
    "g08a_upsert_jobs": _UPSERT,
    "g08b_upsert_small_batch": _UPSERT,
    "g09_upsert_summary": _TYPED + """ SELECT domain, count(*) FILTER (WHERE reasons = '') AS jobs_saved, count(*) FILTER (WHERE reasons <> '') AS skipped,
count(*) FILTER (WHERE reasons <> '') AS validation_errors FROM checked GROUP BY domain""",
    "k01_infer_country": f"SELECT c_custkey, location, {_country_sql()} AS country FROM (SELECT c_custkey, {_LOCATION} AS location FROM customer JOIN nation ON c_nationkey = n_nationkey) q",
    "k02_infer_category": f"SELECT p_partkey, title, {_rules_sql('lower(title)', K.CATEGORY_RULES, 'Other')} AS team_or_category FROM (SELECT p_partkey, {_TITLE} AS title FROM part) q",
    "k03_infer_seniority": f"SELECT *, CASE seniority_bucket WHEN 'staff' THEN 'senior' ELSE seniority_bucket END AS normalized FROM (SELECT p_partkey, title, {_SENIORITY} AS seniority_bucket FROM (SELECT p_partkey, {_TITLE} AS title FROM part) q) r",
    "k04_clean_description": f"""SELECT page_id, substring(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '{_DROP_TAGS}', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '(?i)</?(?:p|div|section|article|ul|ol|li|h[1-6]|tr|table)\\b[^>]*>|<br\\s*/?>', chr(1), 'g'),
  '<[^>]*>', '', 'g'), '[\\t-\\r\\x1c-\\x1f\\x85\\p{{Z}}]+', ' ', 'g'), '( ?\\x01 ?)+', chr(10) || chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g'), 1) AS job_description FROM pages""",
}
