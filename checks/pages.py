"""Page analysis and extraction (families C and D)."""

from __future__ import annotations

import json
import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.entities import AS_OF, FINGERPRINTS_SQL, fingerprints, table
from checks.links import FOCUS, LITE, _HOST, _LINKS, _PLAIN_BASE, _ROOT, _TITLE, _normalized, links
from postings.functions.urls import base_name
from postings.operators import extraction as X
from postings.operators import pages as P
from postings.operators import progress as R
from postings.operators import upsert as G
from postings.operators.urls import with_domain
from postings.plans.load import jobs_from_responses, load_responses, records_from_jobs
from postings.session import scratch_dir
from postings.sources.captures import write_manifest

# The stand-in model goes to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The stored pages link from a nav only. Variants of the markup put the links where the operators
# look for them and add controls and banners; every page is kept.
_SECTION = "replace(replace(html, '<nav>', '<section>'), '</nav>', '</section>')"
_MAIN = "replace(replace(html, '<nav>', '<main>'), '</nav>', '</main>')"
_EVIDENCE = (
    f"CASE WHEN contains(url, '/en/') THEN replace({_SECTION}, 'href=\"/', 'href=\"/jobs/') "
    f"WHEN contains(url, '/de/') THEN replace({_SECTION}, 'href=\"/', 'href=\"/careers') "
    f"WHEN contains(url, '/es/') THEN replace(html, '<footer>', '<footer><a rel=\"next\" href=\"?p=2\">2</a>') ELSE html END"
)
_BANNERS = (
    "CASE WHEN contains(url, '/en/') THEN replace(html, '<div class=\"ad\">', '<div id=\"ad\" class=\"cookie-bar\" style=\"position: fixed; top:0\">') "
    "WHEN contains(url, '/de/') THEN replace(html, '<div class=\"ad\">', '<div id=\"ad\" style=\"color:red; display : none\">') "
    "WHEN contains(url, '/es/') THEN replace(html, '<div class=\"ad\">', '<div style=\"display:none\">') ELSE html END"
)
_CONTROLS = (
    "CASE WHEN contains(url, '/en/') THEN replace(html, '<footer>', '<button>Load More jobs</button><footer>') "
    "WHEN contains(url, '/de/') THEN replace(html, '<footer>', '<a href=\"?p=2\" aria-label=\"Next results\">2</a><footer>') "
    "WHEN contains(url, '/es/') THEN replace(html, '<ul>', '<ul><li><a href=\"?p=2\">»</a></li>') ELSE html END"
)
_PATTERN = "(?i)tion|er"


def _parsed(spark, sf, markup: str = "html"):
    # The stored pages are one file with one row group or two.
    return P.html_nodes(table(spark, sf, "pages").withColumn("html", F.expr(markup)), partitions=spark.sparkContext.defaultParallelism)


def c01(spark, sf):
    return P.node_rows(_parsed(spark, sf)).groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


def c02(spark, sf):
    return P.ordered_job_links(_parsed(spark, sf, _SECTION), pattern=_PATTERN)


def c03(spark, sf):
    return P.job_list_len(_parsed(spark, sf))


def c04(spark, sf):
    return P.page_text_fingerprint(_parsed(spark, sf, _MAIN))


def c05(spark, sf):
    return P.results_fingerprint(_parsed(spark, sf, _MAIN), pattern=_PATTERN)


def c06(spark, sf):
    return R.capture_progress(fingerprints(spark, sf), block=1000).select(
        "seed", "seq", "changed", F.array_join("reasons", ",").alias("reasons"))


def _checks(spark, sf):
    # Four seeds share all events, so that sequences are long and cross blocks.
    return fingerprints(spark, sf).select(
        F.floor(F.col("seed") / 40).alias("seed"), "seq", (F.col("job_count") % 3 != 0).alias("changed"),
        (F.col("job_count") + F.col("seq") / 100).alias("job_count"), F.col("value").alias("elapsed"),
        (F.col("job_count") != 7).alias("has_next"))


def c07a(spark, sf):
    return R.replay_stop_reason(_checks(spark, sf), jobs_max=150, time_budget=400, no_change_cap=6, block=1000)


def c07b(spark, sf):
    return R.replay_stop_reason(_checks(spark, sf), pages_max=40, no_change_cap=5, mode="pagination", block=10)


def c08(spark, sf):
    return P.detect_jobs_present(_parsed(spark, sf, _EVIDENCE))[0]


def c08b(spark, sf):
    return P.detect_jobs_present(_parsed(spark, sf, _EVIDENCE))[1].select("domain", "url", "stage", "error_type", "severity", "message")


def c09(spark, sf):
    hrefs = links(spark, sf).withColumn("href", F.expr(
        "CASE pos % 4 WHEN 0 THEN href WHEN 1 THEN 'https://Boards.Greenhouse.IO' || href WHEN 2 THEN '/Careers' || href ELSE href || '?gh_jid=1' END"))
    return P.classify_job_hrefs(hrefs).select("page_id", "pos", "href", "is_job_link")


def c10(spark, sf):
    return P.reduce_focus(_parsed(spark, sf)).select("page_id", "title", "kept_count", "total_candidates")


def c10c(spark, sf):
    """Length and best score, which SQL cannot derive."""
    return P.reduce_focus(_parsed(spark, sf)).select(
        "page_id", F.length("focus_html").alias("n_chars"), F.round(F.get("signals", F.lit(0))["score"], 6).alias("best_score"))


def c10b(spark, sf):
    """Candidates on pages whose only long container is the article."""
    focus = P.reduce_focus(_parsed(spark, sf), min_text=0)
    return focus.select("page_id", "kept_count", "total_candidates")


def c11a(spark, sf):
    return P.reduce_lite(table(spark, sf, "pages")).select("page_id", "lite_html")


def c11b(spark, sf):
    return P.ignored_nodes(_parsed(spark, sf, _BANNERS)).select("page_id", "tag", F.col("attrs")["id"].alias("elem_id"))


def c12(spark, sf):
    parsed = _parsed(spark, sf, _SECTION)
    base = base_name(F.col("url"), F.col("title"))
    captures = with_domain(parsed).select("domain", base.alias("seed_base"), base.alias("base"), "page_id", (F.col("page_id") * 60).alias("ts"))
    counts = P.results_fingerprint(parsed, pattern=_PATTERN).select("page_id", F.col("job_count").alias("unique_jobs")).join(
        P.job_list_len(parsed).withColumnRenamed("n", "list_len"), "page_id")
    stops = captures.filter(F.col("page_id") % 2 == 0).select(
        "domain", "seed_base", F.lit("pagination").alias("mode"), F.lit("no_next").alias("stop_reason")).distinct()
    joined = lambda *parts: F.array_join(F.transform("pages", lambda p: F.concat_ws(":", *[f(p) for f in parts])), ",")
    counted = joined(*[lambda p, c=c: p["counts"][c].cast("string") for c in ("list_len", "unique_jobs")])
    return R.crawl_manifest(captures, counts, stops, config={"pages_max": 3, "headed": False}).select(
        "domain", "seed_base", "mode", "stop_reason", "ts", joined(lambda p: p["page_id"].cast("string")).alias("pages"), counted.alias("counts"),
        joined(lambda p: p["files"]["focus"], lambda p: p["files"]["meta"]).alias("files"), F.to_json("config").alias("config"))


def a08(spark, sf):
    """Manifests of all pages, then of some domains again, read back."""
    out = scratch_dir(spark, "manifest")
    entries = with_domain(table(spark, sf, "pages")).groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last_page"))
    write_manifest(entries, out)
    write_manifest(entries.filter("n % 2 = 0").withColumn("n", -F.col("n")), out)
    return spark.read.schema("n bigint, last_page bigint, domain string").json(out).select("domain", "n", "last_page")


def c13(spark, sf):
    return P.detect_pagination_controls(_parsed(spark, sf, _CONTROLS))


# ---- extraction ----------------------------------------------------------------------------

_JOBS = (
    "'{\"title\":\"' || p_name || '\",\"job_url\":\"/jobs/' || CAST(p_partkey AS STRING) || '\"},{\"title\":\" ' || p_name || ' \",\"job_url\":\"/JOBS/' || "
    "CAST(p_partkey AS STRING) || '\",\"company\":\"' || p_brand || '\",\"weekly_hours\":' || CAST(p_size AS STRING) || '},\"note\",{\"title\":\"' || p_type || "
    "'\",\"location\":[\"A\",\" \",\" B  C \"]}'"
)
_PAGE = f"'{{\"source_url\":\"https://s' || CAST(p_size AS STRING) || '.example.com/c\",\"jobs\":[' || {_JOBS} || ']}}'"
# Model responses, one per part, damaged in different ways.
_RESPONSE = (
    f"CASE p_partkey % 9 WHEN 0 THEN {_PAGE} WHEN 1 THEN '```json' || chr(10) || {_PAGE} || chr(10) || '```' WHEN 2 THEN replace({_PAGE}, ']}}', '],}}') "
    f"WHEN 3 THEN 'Here is the result: ' || {_PAGE} WHEN 4 THEN {_PAGE} || ' Hope this helps!' WHEN 5 THEN substring({_PAGE}, 1, 60) "
    f"WHEN 6 THEN replace({_PAGE}, '\"', '“') WHEN 7 THEN replace({_PAGE}, '\"', '''') ELSE '[1, 2]' END"
)


def responses(spark, sf):
    # Some bytes of a part become a response that takes a thousand times as long to read: dealt by rows, not by bytes.
    parts = table(spark, sf, "part")
    parts = parts.repartition(max(3 * spark.sparkContext.defaultParallelism, parts.count() // 20_000))
    return parts.select(
        F.col("p_partkey").alias("page"), F.expr(_RESPONSE).alias("response"), F.concat(F.lit("site"), "p_size").alias("domain"),
        F.lit("https://given.example.com/list").alias("url"), F.col("p_brand").alias("title"))


def d01(spark, sf):
    out = X.build_extraction_requests(table(spark, sf, "pages"), "Extract all jobs.")
    return out.select("page_id", "truncated", "request")


def _stub(text: str) -> str:
    """Stands in for a model: depends on the text alone, refuses some requests."""
    if len(text) % 5 == 0:
        raise RuntimeError("busy")
    return '{"jobs": [], "chars": %d}' % len(text)


def d02(spark, sf):
    requests = X.build_extraction_requests(table(spark, sf, "pages"), "Extract all jobs.")
    return X.extract_with_model(requests, _stub, key="page_id", base_sleep=0.001, max_delay=0.002)


def d03(spark, sf):
    return X.sanitize_json_text(responses(spark, sf), "response").select("page", "response")


def d04(spark, sf):
    good, bad = X.decode_json_robust(responses(spark, sf))
    first = F.try_variant_get("value", "$.jobs[0].title", "string")
    return good.select("page", "strategy", first.alias("first_title")).unionByName(
        bad.select("page", F.lit("quarantine").alias("strategy"), F.lit(None).cast("string").alias("first_title")))


def _repair(text: str) -> str:
    if "green" in text:
        return "sorry"
    return '{"jobs": [], "fixed": true}'


def d05(spark, sf):
    _, quarantine = X.decode_json_robust(responses(spark, sf))
    asked = X.repair_failed_json(quarantine, _repair, base_sleep=0.001, max_delay=0.002)
    return asked.select("page", F.col("strategy").isNotNull().alias("fixed"))


def d06(spark, sf):
    pages, _ = X.page_results(*X.decode_json_robust(responses(spark, sf)))
    n = F.coalesce(F.size(F.try_variant_get("jobs", "$", "array<variant>")), F.lit(-1))
    return pages.select("page", "source_url", "page_title", "error", n.alias("n_jobs"))


def d06b(spark, sf):
    _, logged = X.page_results(*X.decode_json_robust(responses(spark, sf)))
    return logged.select("domain", "error_type", "stage", F.get_json_object("metadata", "$.response_length").alias("n"),
                         F.get_json_object("metadata", "$.page_title").alias("page_title"))


def d07(spark, sf):
    pages, _ = X.page_results(*X.decode_json_robust(responses(spark, sf)))
    rows, _ = X.explode_jobs(pages)
    typed = X.job_columns(rows)
    from postings.operators.normalize import canonical_location

    return canonical_location(typed).select("page", "pos", "title", "job_url", "company", "weekly_hours", "location",
                                            F.array_join("type_errors", ",").alias("type_errors"), "page_failed")


def d07b(spark, sf):
    pages, _ = X.page_results(*X.decode_json_robust(responses(spark, sf)))
    return X.explode_jobs(pages)[1].select("page", "skipped")


def load(spark, sf):
    """Responses to job records in one go."""
    jobs, _ = jobs_from_responses(responses(spark, sf))
    records, _ = records_from_jobs(jobs, AS_OF)
    return records.select("job_url", "title", "company", "weekly_hours", "source_domain", "source_page_url")


def _link_model(text: str) -> str:
    """Stands in for a model: a posting for each whole address in the text."""
    return json.dumps({"jobs": [{"title": f"t{href}", "job_url": href} for href in re.findall(r'href="([^"]*)"', text)]})


def d08(spark, sf):
    """Pages asked in parts of 900 characters that overlap; postings in an overlap come once."""
    pages = with_domain(table(spark, sf, "pages")).select(F.col("page_id").alias("page"), "domain", "url", F.lit("T").alias("title"), "html")
    requests = X.build_extraction_requests(X.split_long_pages(pages, 900, 200), "Extract all jobs.")
    answers = scratch_dir(spark, "part-answers")
    X.extract_with_model(requests, _link_model, keep=["part", "domain", "url", "title"]).write.parquet(answers)
    jobs, _ = jobs_from_responses(spark.read.parquet(answers), part="part")
    place = F.row_number().over(Window.partitionBy("page").orderBy("pos"))
    return jobs.select("page", place.alias("place"), "title", "job_url")


def g09b(spark, sf):
    """Counts per domain and step rows of a load from responses."""
    loaded = load_responses(responses(spark, sf), AS_OF, "run-1", store=scratch_dir(spark, "load"))
    steps = loaded.steps.select("domain", "run_id", "step", "status", F.get_json_object("metadata", "$.jobs_saved").alias("logged"))
    return loaded.summary.join(steps, "domain", "left")


def g09c(spark, sf):
    """Error rows of the same load."""
    loaded = load_responses(responses(spark, sf), AS_OF, "run-1", store=scratch_dir(spark, "load"))
    return loaded.errors.groupBy("component", "stage", "error_type", "severity").agg(F.count(F.lit(1)).alias("n"))


def g01(spark, sf):
    pages = with_domain(table(spark, sf, "pages")).select(
        "page_id", "domain", F.col("url").alias("source_url"), F.expr(_TITLE).alias("page_title"),
        F.parse_json(F.expr("CASE page_id % 4 WHEN 0 THEN '[{\"title\":\"' || page_id || '\"}]' WHEN 1 THEN '[{\"a\":1},\"x\"]' WHEN 2 THEN '{\"a\":1}' ELSE '[]' END")).alias("jobs"))
    valid, errors = G.validate_pages(pages)
    return valid.select("domain", F.col("source_url").alias("url"), F.lit("ok").alias("message"), F.lit(None).cast("string").alias("jobs_count")).unionByName(
        errors.select("domain", "url", "message", F.get_json_object("metadata", "$.jobs_count").alias("jobs_count")))


QUERIES = {
    "a08_write_manifest": a08,
    "c01_html_nodes": c01, "c02_ordered_job_links": c02, "c03_job_list_len": c03, "c04_page_text_fingerprint": c04,
    "c05_results_fingerprint": c05, "c06_capture_progress": c06, "c07a_replay_expansion": c07a, "c07b_replay_pagination": c07b,
    "c08a_detect_jobs_present": c08, "c08b_pages_without_jobs": c08b, "c09_classify_job_hrefs": c09, "c10a_reduce_focus": c10, "c10c_focus_scores": c10c,
    "c10b_focus_candidates": c10b, "c11a_reduce_lite": c11a, "c11b_ignored_nodes": c11b, "c12_crawl_manifest": c12,
    "c13_detect_pagination_controls": c13,
    "d01_build_extraction_requests": d01, "d02_extract_with_model": d02, "d03_sanitize_json_text": d03, "d04_decode_json_robust": d04,
    "d05_repair_failed_json": d05, "d06a_page_results": d06, "d06b_json_error_rows": d06b, "d07a_explode_jobs": d07,
    "d07b_skipped_entries": d07b, "d08_long_pages": d08, "g09b_load_summary": g09b, "g09c_load_errors": g09c, "g01_validate_pages": g01, "g05b_records_from_responses": load,
}

# ---- SQL -----------------------------------------------------------------------------------

_BARE = "regexp_replace(html, '(?is)<(?:script|style)\\b.*?</(?:script|style)\\s*>', '', 'g')"
# Anchors with address and text.
_ANCHORS = """anchors AS (SELECT page_id, url, CAST(generate_subscripts(a, 1) - 1 AS INT) AS i, regexp_extract(unnest(a), 'href="([^"]*)"', 1) AS href,
  regexp_extract(unnest(a), '>(.*)</a>', 1) AS label FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="[^"]*">.*?</a>') AS a FROM pages) q)"""
_LINK_HITS = f"""{_ANCHORS}, hits AS (SELECT page_id, url, i, href, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos FROM anchors
  WHERE regexp_matches(href, '{_PATTERN}') OR regexp_matches(label, '{_PATTERN}'))"""
_PLAIN_TITLE = f"trim(regexp_replace(replace({_TITLE}, '&amp;', '&'), '\\s+', ' ', 'g'))"
_REQUEST = ("'Extract all jobs.' || chr(10) || chr(10) || 'Return compact JSON on a single line if possible.' || chr(10) || chr(10) || '=== HTML START ===' || chr(10) "
            "|| {} || chr(10) || '=== HTML END ===' || chr(10)")
_RESP = f"responses AS (SELECT p_partkey AS page, {_RESPONSE} AS response, p_name, p_type, p_brand, p_size FROM part)"
_OK = "page % 9 NOT IN (5, 8)"

ORACLES = {
    "c01_html_nodes": f"""SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(regexp_replace({_BARE}, '<!--.*?-->', '', 'g'), '<([a-z][a-z0-9]*)(?:\\s[^>]*)?>', 1)) AS tag FROM pages) q
GROUP BY page_id, tag""",
    "c02_ordered_job_links": f"WITH {_LINK_HITS} SELECT page_id, CAST(pos AS INT) AS pos, {_ROOT} || href AS link FROM hits",
    "c03_job_list_len": "SELECT page_id, CAST(len(regexp_extract_all(html, '<li>')) + len(regexp_extract_all(html, '<article>')) AS INT) AS n FROM pages",
    "c04_page_text_fingerprint": f"WITH {_ANCHORS} SELECT page_id, sha1(string_agg(trim(label), chr(10) || chr(10) ORDER BY i)) AS text_fp FROM anchors GROUP BY page_id",
    "c05_results_fingerprint": f"""WITH {_LINK_HITS}, fp AS (SELECT page_id, sha1(string_agg(trim(label), chr(10) || chr(10) ORDER BY i)) AS text_fp FROM anchors GROUP BY page_id),
n AS (SELECT page_id, count(*) AS c FROM hits GROUP BY page_id)
SELECT p.page_id, {_normalized('p.url')} AS url, text_fp, CAST(coalesce(c, 0) AS INT) AS job_count, 0 AS scroll_h
FROM pages p JOIN fp ON p.page_id = fp.page_id LEFT JOIN n ON p.page_id = n.page_id""",
    "c06_capture_progress": f"""WITH {FINGERPRINTS_SQL}, w AS (SELECT *, lag(url) OVER s AS u0, lag(text_fp) OVER s AS t0, lag(job_count) OVER s AS j0, lag(scroll_h) OVER s AS h0
  FROM fingerprints WINDOW s AS (PARTITION BY seed ORDER BY seq)),
r AS (SELECT seed, seq, u0, concat_ws(',', CASE WHEN url <> u0 THEN 'url_changed' END, CASE WHEN text_fp <> t0 THEN 'text_changed' END,
  CASE WHEN job_count > j0 THEN 'more_jobs' END, CASE WHEN scroll_h > h0 + 500 THEN 'scroll_grew' END) AS reasons FROM w)
SELECT seed, seq, CASE WHEN u0 IS NOT NULL THEN reasons <> '' END AS changed, CASE WHEN u0 IS NOT NULL THEN reasons END AS reasons FROM r""",
}
_CHECKS_SQL = f"""WITH {FINGERPRINTS_SQL}, checks AS (SELECT seed // 40 AS seed, seq, job_count % 3 <> 0 AS changed, job_count + seq / 100 AS job_count, value AS elapsed,
  job_count <> 7 AS has_next, row_number() OVER (PARTITION BY seed // 40 ORDER BY seq) AS rn FROM fingerprints),
runs AS (SELECT *, rn - coalesce(max(CASE WHEN changed THEN rn END) OVER (PARTITION BY seed ORDER BY seq), 0) AS streak,
  1 + count(*) FILTER (WHERE changed) OVER (PARTITION BY seed ORDER BY seq) AS pages FROM checks),
hits AS (SELECT *, {{}} AS reason FROM runs)
SELECT CAST(seed AS BIGINT) AS seed, coalesce(arg_min(reason, seq), 'none') AS stop_reason, min(seq) FILTER (WHERE reason IS NOT NULL) AS stop_seq,
  coalesce(min(rn) FILTER (WHERE reason IS NOT NULL), max(rn)) AS checks FROM hits GROUP BY seed"""
ORACLES |= {
    "c07a_replay_expansion": _CHECKS_SQL.format("CASE WHEN NOT changed AND streak >= 6 THEN 'stable' WHEN job_count >= 150 THEN 'jobs_cap' WHEN elapsed >= 400 THEN 'time' END"),
    "c07b_replay_pagination": _CHECKS_SQL.format("CASE WHEN NOT has_next THEN 'no_next' WHEN changed AND pages >= 40 THEN 'pages_cap' WHEN NOT changed AND streak >= 5 THEN 'pagination_stable' END"),
    "c08a_detect_jobs_present": f"""WITH {_ANCHORS} SELECT p.page_id, found_by IS NOT NULL AS jobs_present, found_by FROM (SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'selector'
  WHEN contains(url, '/de/') THEN 'link' WHEN contains(url, '/es/') THEN 'next' END AS found_by FROM pages) p""",
    "c08b_pages_without_jobs": f"""SELECT lower({_HOST}) AS domain, url, 'wait_for_jobs' AS stage, 'timeout' AS error_type, 'warning' AS severity,
  'No job listings detected after 35000ms wait' AS message FROM pages WHERE NOT regexp_matches(url, '/(en|de|es)/')""",
    "c09_classify_job_hrefs": f"""WITH {_LINKS} SELECT page_id, pos, CASE pos % 4 WHEN 0 THEN href WHEN 1 THEN 'https://Boards.Greenhouse.IO' || href WHEN 2 THEN '/Careers' || href ELSE href || '?gh_jid=1' END AS href,
  pos % 4 <> 0 OR regexp_matches(lower(href), '/(jobs?|careers?|positions?)/') AS is_job_link FROM links""",
    "c10b_focus_candidates": """SELECT page_id, CAST(len(regexp_extract_all(html, '<article>|<div')) AS INT) AS kept_count, CAST(len(regexp_extract_all(html, '<article>|<div')) AS INT) AS total_candidates FROM pages""",
    "c10a_reduce_focus": f"SELECT page_id, {_PLAIN_TITLE} AS title, {FOCUS} AS kept_count, {FOCUS} AS total_candidates FROM pages",
    "c11a_reduce_lite": f"SELECT page_id, {LITE} AS lite_html FROM pages",
    "c11b_ignored_nodes": "SELECT page_id, 'div' AS tag, 'ad' AS elem_id FROM pages WHERE regexp_matches(url, '/(en|de)/')",
    "c12_crawl_manifest": f"""WITH {_LINK_HITS}, n AS (SELECT page_id, count(*) AS jobs FROM hits GROUP BY page_id),
caps AS (SELECT lower({_HOST}) AS domain, {_PLAIN_BASE} AS seed_base, p.page_id, p.page_id * 60 AS ts, coalesce(jobs, 0) AS jobs,
  len(regexp_extract_all(html, '<li>')) + len(regexp_extract_all(html, '<article>')) AS n FROM pages p LEFT JOIN n ON p.page_id = n.page_id)
SELECT domain, seed_base, CASE WHEN bool_or(page_id % 2 = 0) THEN 'pagination' ELSE 'expansion' END AS mode, CASE WHEN bool_or(page_id % 2 = 0) THEN 'no_next' ELSE 'none' END AS stop_reason,
  max(ts) AS ts, string_agg(page_id, ',' ORDER BY page_id) AS pages, string_agg(n || ':' || jobs, ',' ORDER BY page_id) AS counts,
  string_agg(domain || '/reduced_focus/' || seed_base || '.' || page_id || '.html:' || domain || '/meta/' || seed_base || '.' || page_id || '.json', ',' ORDER BY page_id) AS files,
  '{{"headed":"False","pages_max":"3"}}' AS config FROM caps GROUP BY domain, seed_base""",
    "a08_write_manifest": f"SELECT lower({_HOST}) AS domain, CAST(CASE WHEN count(*) % 2 = 0 THEN -count(*) ELSE count(*) END AS BIGINT) AS n, max(page_id) AS last_page FROM pages GROUP BY 1",
    "c13_detect_pagination_controls": "SELECT page_id, contains(url, '/en/') AS has_load_more, regexp_matches(url, '/(de|es)/') AS has_next FROM pages",
    "d01_build_extraction_requests": f"SELECT page_id, false AS truncated, {_REQUEST.format('html')} AS request FROM pages",
    "d02_extract_with_model": f"""SELECT page_id, CASE WHEN n % 5 <> 0 THEN '{{"jobs": [], "chars": ' || n || '}}' END AS response, CAST(CASE WHEN n % 5 = 0 THEN 3 ELSE 1 END AS INT) AS attempts,
  CASE WHEN n % 5 = 0 THEN 'busy' END AS error FROM (SELECT page_id, length({_REQUEST.format('html')}) AS n FROM pages) q""",
    "d03_sanitize_json_text": f"""WITH {_RESP} SELECT page, trim(regexp_replace(regexp_replace(translate(regexp_replace(trim(response), '(?i)^```(?:json)?\\s*|\\s*```$', '', 'g'),
  '‘’“”«»', repeat(chr(39), 2) || repeat(chr(34), 4)), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g'), ',(\\s*[\\]}}])', '\\1', 'g'), ' ' || chr(10)) AS response FROM responses""",
    "d04_decode_json_robust": f"""WITH {_RESP} SELECT page, CASE page % 9 WHEN 0 THEN 'strict' WHEN 1 THEN 'sanitized' WHEN 2 THEN 'sanitized' WHEN 3 THEN 'slice' WHEN 4 THEN 'slice'
  WHEN 5 THEN 'quarantine' WHEN 6 THEN 'sanitized' WHEN 7 THEN 'lenient' ELSE 'strict' END AS strategy, CASE WHEN {_OK} THEN p_name END AS first_title FROM responses""",
    "d05_repair_failed_json": f"WITH {_RESP} SELECT page, NOT contains(response, 'green') AS fixed FROM responses WHERE page % 9 = 5",
    "d06a_page_results": f"""WITH {_RESP} SELECT page, CASE WHEN {_OK} THEN 'https://s' || p_size || '.example.com/c' ELSE 'https://given.example.com/list' END AS source_url, p_brand AS page_title,
  CASE page % 9 WHEN 5 THEN 'LLM returned non-JSON output; all repair attempts failed' WHEN 8 THEN 'response is of type list, not an object' END AS error,
  CAST(CASE WHEN {_OK} THEN 4 ELSE -1 END AS INT) AS n_jobs FROM responses""",
    "d06b_json_error_rows": f"WITH {_RESP} SELECT 'given.example.com' AS domain, 'json_error' AS error_type, 'parse_json' AS stage, CAST(length(response) AS VARCHAR) AS n, p_brand AS page_title FROM responses WHERE page % 9 = 5",
    "d07a_explode_jobs": f"""WITH {_RESP}, rows AS (SELECT *, unnest([0, 1, 3]) AS pos FROM responses WHERE {_OK})
SELECT page, pos, CASE pos WHEN 0 THEN p_name WHEN 1 THEN ' ' || p_name || ' ' ELSE p_type END AS title, CASE pos WHEN 0 THEN '/jobs/' || page WHEN 1 THEN '/JOBS/' || page END AS job_url,
  CASE pos WHEN 1 THEN p_brand END AS company, CASE pos WHEN 1 THEN CAST(p_size AS VARCHAR) END AS weekly_hours, CASE pos WHEN 3 THEN 'A, B C' END AS location, '' AS type_errors, false AS page_failed FROM rows""",
    "d07b_skipped_entries": f"WITH {_RESP} SELECT page, CAST(CASE WHEN {_OK} THEN 1 ELSE 0 END AS BIGINT) AS skipped FROM responses",
    "d08_long_pages": f"""WITH {_LINKS}, firsts AS (SELECT page_id, min(pos) AS pos, arg_min(href, pos) AS href FROM links WHERE trim(href) <> '' GROUP BY page_id, lower(trim(href)))
SELECT l.page_id AS page, CAST(row_number() OVER (PARTITION BY l.page_id ORDER BY pos) AS INT) AS place, 't' || href AS title, {_ROOT} || href AS job_url
FROM firsts l JOIN pages p ON l.page_id = p.page_id""",
    "g09b_load_summary": f"""SELECT 'site' || p_size AS domain, CAST(count(*) FILTER (WHERE {_OK}) AS BIGINT) AS jobs_saved, CAST(2 * count(*) FILTER (WHERE {_OK}) AS BIGINT) AS skipped,
  CAST(count(*) FILTER (WHERE {_OK}) AS BIGINT) AS validation_errors, CASE WHEN count(*) FILTER (WHERE {_OK}) > 0 THEN 'run-1' END AS run_id,
  CASE WHEN count(*) FILTER (WHERE {_OK}) > 0 THEN 'db_complete' END AS step, CASE WHEN count(*) FILTER (WHERE {_OK}) > 0 THEN 'success' END AS status,
  CASE WHEN count(*) FILTER (WHERE {_OK}) > 0 THEN CAST(count(*) FILTER (WHERE {_OK}) AS VARCHAR) END AS logged FROM (SELECT *, p_partkey AS page FROM part) q GROUP BY 1""",
    "g09c_load_errors": f"""SELECT 'llm' AS component, 'parse_json' AS stage, 'json_error' AS error_type, 'error' AS severity, count(*) AS n FROM part WHERE p_partkey % 9 = 5
UNION ALL SELECT 'db', 'validate_job', 'validation_error', 'warning', count(*) FROM (SELECT p_partkey AS page FROM part) q WHERE {_OK}""",
    "g01_validate_pages": f"""SELECT lower({_HOST}) AS domain, url, CASE WHEN page_id % 4 IN (1, 2) THEN 'invalid page: jobs' ELSE 'ok' END AS message,
  CASE page_id % 4 WHEN 1 THEN '2' WHEN 2 THEN '0' END AS jobs_count FROM pages""",
    "g05b_records_from_responses": f"""WITH {_RESP} SELECT 'https://s' || p_size || '.example.com/JOBS/' || page AS job_url, p_name AS title, p_brand AS company, CAST(p_size AS VARCHAR) AS weekly_hours,
  'site' || p_size AS source_domain, 'https://s' || p_size || '.example.com/c' AS source_page_url FROM responses WHERE {_OK}""",
}
