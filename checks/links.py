"""Seeds, captures and URLs (families A and B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.entities import table
from checks.files import write_files
from postings.functions.urls import TRACKING_PARAMS
from postings.operators import urls as U
from postings.plans.capture import reduced_captures
from postings.session import scratch_dir
from postings.sources import captures as C
from postings.sources import seeds as S
from postings.sources.tables import read_snapshot, write_snapshot

_LINE = "CASE WHEN page_id % 7 = 0 THEN '  # ' || url WHEN page_id % 11 = 0 THEN '   ' ELSE ' ' || split_part(split_part(url, '?', 1), '/en/', 1) || ' ' END"
_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_HREF = (
    "href || CASE pos % 5 WHEN 0 THEN '' WHEN 1 THEN '?utm_source=a&q=1&UTM_Medium=x' WHEN 2 THEN '#frag' "
    "WHEN 3 THEN '?x=a%20b+c~*&flag' ELSE '?gclid=1#t' END"
)
_JOB_HREF = (
    "CASE pos % 5 WHEN 0 THEN href WHEN 1 THEN url WHEN 2 THEN ' ' || href || '?utm_source=a#f ' WHEN 3 THEN '' ELSE '//cdn.example.com' || href END"
)
_CHECKED = "CASE pos % 5 WHEN 0 THEN href WHEN 1 THEN url WHEN 2 THEN 'https://' WHEN 3 THEN 'ftp://host' || href ELSE ' ' || url END"


def links(spark, sf):
    """One row per href of a page, in order."""
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, sf, "pages").select("page_id", "url", F.posexplode(hrefs).alias("pos", "href"))


def a01(spark, sf):
    return S.seeds_from_lines(table(spark, sf, "pages").select(F.col("page_id").alias("pos"), F.expr(_LINE).alias("value")))


def a02(spark, sf):
    seeds = S.seeds_from_lines(table(spark, sf, "pages").select(F.col("page_id").alias("pos"), F.expr(_LINE).alias("value")))
    return S.group_seeds_by_domain(seeds, block=100).select("domain", "block", F.array_join("urls", " ").alias("urls"))


def _captures(spark, sf):
    named = U.with_domain(table(spark, sf, "pages")).withColumn("title", F.expr(_TITLE))
    return named.withColumn("page_id", F.format_string("p%03d", F.col("page_id")))


def capture_files(spark, sf, root, sidecar: str = "TRUE"):
    """Captures as files: HTML of every page, a sidecar where the condition holds."""
    pages = U.with_domain(table(spark, sf, "pages")).withColumn("title", F.expr(_TITLE))
    place = lambda folder, ext: F.concat(F.lit(f"{root}/"), "domain", F.lit(f"/{folder}/"), F.col("page_id").cast("string"), F.lit(ext))
    write_files(pages.select(place("reduced_focus", ".html").alias("path"), F.col("html").alias("content")))
    said = pages.filter(sidecar).withColumn("other", F.col("page_id") % 2 == 0)
    meta = F.to_json(F.struct(
        F.when(~F.col("other"), F.col("url")).alias("url"), F.when(F.col("other"), F.col("url")).alias("source_url"), F.when(F.col("other"), F.col("title")).alias("title"),
        F.struct(F.col("title").alias("title")).alias("reduce_meta")))
    write_files(said.select(place("meta", ".json").alias("path"), meta.alias("content")))


def a03(spark, sf):
    root = scratch_dir(spark, "capture-files")
    capture_files(spark, sf, root, "page_id % 4 <> 0")
    return C.scan_captures(spark, root).select("domain", "stem", "url", "title", F.sha1("html").alias("sha1"))


def a04(spark, sf):
    """All five things kept per page, written and read back."""
    path = scratch_dir(spark, "captures")
    pages = table(spark, sf, "pages").withColumn("page_id", F.format_string("p%03d", F.col("page_id")))
    C.write_captures(reduced_captures(pages), path)
    meta = lambda name: F.get_json_object("meta", f"$.{name}")
    return spark.read.parquet(path).select(
        "domain", "url", "page_id", "base", "sha1", F.length("html").alias("n_chars"), F.sha1("lite_html").alias("lite_sha1"),
        F.col("focus_html").startswith("<!doctype html>").alias("has_focus"), F.size("signals").alias("n_signals"),
        meta("reduce_meta.kept_count").alias("kept"), (meta("sha1") == F.col("sha1")).alias("same_sha1"), meta("page_id").alias("meta_page"))


def a05(spark, sf):
    return U.capture_paths(C.capture_records(_captures(spark, sf))).select(
        "page_id", "full_path", "focus_path", "lite_path", "meta_path", "signals_path")


def a06(spark, sf):
    """Documents with the cleaned postings of each page, written and read back."""
    from checks.pages import responses
    from postings.plans.load import jobs_from_responses

    path = scratch_dir(spark, "pages-json")
    pages = responses(spark, sf).select("page", "domain", F.col("url").alias("source_url"), F.col("title").alias("page_title"))
    jobs, _ = jobs_from_responses(responses(spark, sf))
    C.write_page_json(C.page_documents(jobs.select("page", "pos", "title", "job_url", "company"), pages), path)
    docs = spark.read.schema("page int, source_url string, page_title string, domain string, jobs array<struct<title:string,job_url:string,company:string>>").json(path)
    listed = lambda c: F.array_join(F.transform("jobs", lambda j: F.coalesce(j[c], F.lit("-"))), "|")
    return docs.select(F.col("page").cast("bigint").alias("page"), "source_url", "page_title", "domain", F.size("jobs").alias("n_jobs"),
                       listed("title").alias("titles"), listed("job_url").alias("urls"), listed("company").alias("companies"))


def a07(spark, sf):
    pages = C.capture_records(_captures(spark, sf))
    done = pages.filter(F.col("url").contains("/en/"))
    return C.skip_processed(pages, done).select("domain", "base")


def b01(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.concat(F.lit(" "), F.initcap(F.col("url"))).alias("url"))
    out = U.with_domain(U.with_domain(pages), out="exact_domain", lower=False)
    return out.select("page_id", "domain", "exact_domain")


def b02(spark, sf):
    return U.canonicalize_links(links(spark, sf).withColumn("href", F.expr(_HREF)), "url", "href").select("page_id", "pos", "href", "canonical_url")


def b03(spark, sf):
    return U.normalize_urls(table(spark, sf, "pages")).select("page_id", "normalized_url")


def b04(spark, sf):
    jobs = U.with_domain(links(spark, sf)).withColumn("job_url", F.expr(_JOB_HREF))
    jobs = jobs.withColumn("source_url", F.when(F.col("page_id") % 2 == 0, F.col("url")))
    return U.absolutize_job_urls(jobs).select("page_id", "pos", "job_url")


def b05(spark, sf):
    return U.flag_valid_urls(links(spark, sf).withColumn("link", F.expr(_CHECKED)), "link").select("page_id", "pos", "link", "is_valid", "is_absolute")


_COMPANY = (
    "CASE page_id % 5 WHEN 0 THEN 'careers.x.com' WHEN 1 THEN regexp_extract(url, '//([^/?#]*)', 1) WHEN 2 THEN 'jobs-' || regexp_extract(url, '//([^/?#.]*)', 1) "
    "|| '_3m.com' WHEN 3 THEN '' ELSE 'my-' || regexp_extract(url, '([a-z-]+)\\\\.example', 1) || 'work.io' END"
)


def b06(spark, sf):
    return U.with_company_name(table(spark, sf, "pages").select("page_id", F.expr(_COMPANY).alias("domain")))


def b07(spark, sf):
    return U.with_base_name(table(spark, sf, "pages").withColumn("title", F.expr(_TITLE))).select("page_id", "base")


def b08(spark, sf):
    return U.with_sha1(table(spark, sf, "pages"), "html").select("page_id", "sha1")


def snapshot(spark, sf):
    """Two versions of a table; the newer one is read back."""
    root = scratch_dir(spark, "snapshot")
    pages = table(spark, sf, "pages").select("page_id", "url")
    write_snapshot(pages.limit(0), root, 1)
    write_snapshot(pages, root, 2)
    return read_snapshot(spark, root, pages.schema)


def a01b(spark, sf):
    """Seeds written to files, read back and grouped."""
    out = scratch_dir(spark, "seeds")
    table(spark, sf, "pages").orderBy("page_id").select(F.expr(_LINE).alias("value")).write.text(out)
    grouped = S.group_seeds_by_domain(S.read_seeds(spark, out), block=500)  # positions are byte offsets: many blocks
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "urls"))), lambda b: b["urls"]))
    return grouped.groupBy("domain").agg(F.array_join(ordered, " ").alias("urls"))


QUERIES = {
    "a01_seeds_from_lines": a01, "a01b_read_seeds": a01b, "a02_group_seeds_by_domain": a02, "a03_scan_captures": a03, "a04_write_captures": a04, "a05_capture_paths": a05,
    "a06_write_page_json": a06, "a07_skip_processed": a07,
    "b01_with_domain": b01, "b02_canonicalize_links": b02, "b03_normalize_urls": b03, "b04_absolutize_job_urls": b04,
    "b05_flag_valid_urls": b05, "b06_with_company_name": b06, "b07_with_base_name": b07, "b08_with_sha1": b08,
    "g08c_snapshot_versions": snapshot,
}

# ---- SQL -----------------------------------------------------------------------------------

_LINKS = """links AS (SELECT page_id, url, CAST(generate_subscripts(h, 1) - 1 AS INT) AS pos, unnest(h) AS href
  FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS h FROM pages) q)"""
_P = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(c: str, i: int) -> str:
    return f"regexp_extract({c}, '{_P}', {i})"


def _query(q: str) -> str:
    dec = lambda x: f"url_decode(replace({x}, '+', ' '))"
    enc = lambda x: f"replace(url_encode({x}), '%20', '+')"
    key, value = "split_part(p, '=', 1)", "CASE WHEN contains(p, '=') THEN substring(p, strpos(p, '=') + 1) ELSE '' END"
    drop = ", ".join(f"'{t}'" for t in TRACKING_PARAMS)
    kept = f"list_filter(string_split({q}, '&'), lambda p: p <> '' AND lower({dec(key)}) NOT IN ({drop}))"
    return f"array_to_string(list_transform({kept}, lambda p: {enc(dec(key))} || '=' || {enc(dec(value))}), '&')"


def _with_query(q: str) -> str:
    return f"CASE WHEN {_query(q)} <> '' THEN '?' || {_query(q)} ELSE '' END"


def _normalized(u: str) -> str:
    return (f"lower({_part(u, 1)}) || '://' || lower({_part(u, 2)}) || {_part(u, 3)} || {_with_query(_part(u, 4))}")


_HOST = _part("url", 2)
_ROOT = f"{_part('url', 1)} || '://' || {_HOST}"
_FOLD = "lower(strip_accents(regexp_replace({}, '([À-ÅÇ-ÏÑ-ÖÙ-Ýà-åç-ïñ-öù-ýÿ])', '\\1-', 'g')))"


def _slug(c: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace({_FOLD.format(c)}, '[^a-z0-9-]+', '-', 'g'), '-{{2,}}', '-', 'g'), '^-|-$', '', 'g')"


_SEGMENT = f"coalesce(nullif(regexp_extract({_part('url', 3)}, '([^/]+)/*$', 1), ''), 'index')"
_BARE = f"coalesce(nullif(regexp_replace(regexp_replace({_SEGMENT}, '^[0-9]+[-_]*', ''), '[-_]*[0-9]+$', ''), ''), 'index')"
_NAME = f"substring(coalesce(nullif({_slug(_BARE)}, ''), 'index'), 1, 40)"
_BASE = (f"CASE WHEN {_NAME} IN ('index', 'page') AND {_TITLE} <> '' THEN substring(coalesce(nullif({_slug(_TITLE)}, ''), 'page'), 1, 40) ELSE {_NAME} END "
         "|| '__' || substring(sha1(url), 1, 8)")
_SEEDS = f"seeds AS (SELECT min(page_id) AS pos, u AS url FROM (SELECT page_id, trim({_LINE}) AS u FROM pages) q WHERE u <> '' AND NOT starts_with(u, '#') GROUP BY u)"
_CAP = f"caps AS (SELECT lower({_HOST}) AS domain, url, printf('p%03d', page_id) AS page_id, {_BASE} AS base, html FROM pages)"
# The parsed title has its entities resolved.
_PLAIN_BASE = _BASE.replace(_TITLE, f"replace({_TITLE}, '&amp;', '&')")
LITE = """'<!doctype html><meta charset="utf-8">' || regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<noscript\\b.*?</noscript\\s*>|<template\\b.*?</template\\s*>', '', 'g'), '(?is)^\\s*<!doctype[^>]*>', ''),
  '[\\t-\\r\\x1c-\\x1f\\x85\\x{feff}\\p{Z}]{2,}', ' ', 'g'), '>[\\t-\\r\\x1c-\\x1f\\x85\\x{feff}\\p{Z}]+<', '><', 'g')"""


def _text_of(element: str) -> str:
    """Trimmed text of the one such element of a page."""
    inner = f"regexp_extract(regexp_replace(html, '(?is)<(?:script|style)\\b.*?</(?:script|style)\\s*>|<!--.*?-->', '', 'g'), '(?s){element}', 1)"
    plain = f"regexp_replace({inner}, '<[^>]*>', '', 'g')"
    for name, c in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("middot", "·"), ("copy", "©"), ("nbsp", "\u00a0"), ("#39", "''"), ("amp", "&")):
        plain = f"replace({plain}, '&{name};', '{c}')"
    return f"trim({plain}, ' ' || chr(9) || chr(10) || chr(13))"


#: Containers with more than 200 characters of text: the article and the box before it.
FOCUS = (f"CAST((length({_text_of('<article>(.*)</article>')}) > 200)::INT + (length({_text_of('<div class=.ad.>(.*?)</div>')}) > 200)::INT AS INT)")
_WORDS = "domain_part"
for _w in ["jobs", "careers", "career", "hiring", "join", "work"]:
    _WORDS = f"replace({_WORDS}, '{_w}', '')"
_LABEL = f"trim(regexp_replace(replace(replace({_WORDS}, '-', ' '), '_', ' '), ' +', ' ', 'g'))"

ORACLES = {
    "a01b_read_seeds": f"WITH {_SEEDS} SELECT lower({_HOST}) AS domain, string_agg(url, ' ' ORDER BY pos) AS urls FROM seeds GROUP BY 1",
    "a01_seeds_from_lines": f"WITH {_SEEDS} SELECT pos, url FROM seeds",
    "a02_group_seeds_by_domain": f"WITH {_SEEDS} SELECT lower({_HOST}) AS domain, CAST(pos // 100 AS BIGINT) AS block, string_agg(url, ' ' ORDER BY pos) AS urls FROM seeds GROUP BY 1, 2",
    "a03_scan_captures": f"""SELECT lower({_HOST}) AS domain, CAST(page_id AS VARCHAR) AS stem, CASE WHEN page_id % 4 <> 0 THEN url ELSE '' END AS url,
  CASE WHEN page_id % 4 <> 0 THEN {_TITLE} ELSE '' END AS title, sha1(html) AS sha1 FROM pages""",
    "a04_write_captures": f"""SELECT lower({_HOST}) AS domain, url, printf('p%03d', page_id) AS page_id, {_PLAIN_BASE} AS base, sha1(html) AS sha1,
  CAST(length(html) AS INT) AS n_chars, sha1({LITE}) AS lite_sha1, true AS has_focus, CASE WHEN {FOCUS} > 0 THEN {FOCUS} END AS n_signals,
  CAST({FOCUS} AS VARCHAR) AS kept, true AS same_sha1, printf('p%03d', page_id) AS meta_page FROM pages""",
    "a05_capture_paths": f"""WITH {_CAP} SELECT page_id, domain || '/full/' || base || '.' || page_id || '.html' AS full_path,
  domain || '/reduced_focus/' || base || '.' || page_id || '.html' AS focus_path, domain || '/reduced_lite/' || base || '.' || page_id || '.html' AS lite_path,
  domain || '/meta/' || base || '.' || page_id || '.json' AS meta_path, domain || '/signals/' || base || '.' || page_id || '.json' AS signals_path FROM caps""",
    "a06_write_page_json": """SELECT p_partkey AS page, 'https://given.example.com/list' AS source_url, p_brand AS page_title, 'site' || p_size AS domain,
  CAST(CASE WHEN ok THEN 2 ELSE 0 END AS INT) AS n_jobs, CASE WHEN ok THEN p_name || '|' || p_type ELSE '' END AS titles,
  CASE WHEN ok THEN 'https://s' || p_size || '.example.com/JOBS/' || p_partkey || '|-' ELSE '' END AS urls, CASE WHEN ok THEN p_brand || '|-' ELSE '' END AS companies
FROM (SELECT *, p_partkey % 9 NOT IN (5, 8) AS ok FROM part) q""",
    "a07_skip_processed": f"WITH {_CAP} SELECT domain, base FROM caps WHERE NOT contains(url, '/en/')",
    "b01_with_domain": f"SELECT page_id, lower({_HOST}) AS domain, nullif({_HOST}, '') AS exact_domain FROM (SELECT page_id, upper(url[1]) || lower(url[2:]) AS url FROM pages) q",
    "b02_canonicalize_links": f"""WITH {_LINKS}, l AS (SELECT page_id, pos, url, {_HREF} AS href FROM links)
SELECT page_id, pos, href, lower({_ROOT}) || {_part('href', 3)} || {_with_query(_part('href', 4))} AS canonical_url FROM l""",
    "b03_normalize_urls": f"SELECT page_id, {_normalized('url')} AS normalized_url FROM pages",
    "b04_absolutize_job_urls": f"""WITH {_LINKS} SELECT page_id, pos, CASE pos % 5 WHEN 1 THEN url WHEN 3 THEN NULL
  WHEN 4 THEN CASE WHEN page_id % 2 = 0 THEN {_part('url', 1)} ELSE 'https' END || '://cdn.example.com' || href
  ELSE CASE WHEN page_id % 2 = 0 THEN {_ROOT} ELSE 'https://' || lower({_HOST}) END || trim({_JOB_HREF}) END AS job_url FROM links""",
    "b05_flag_valid_urls": f"""WITH {_LINKS} SELECT page_id, pos, {_CHECKED} AS link, pos % 5 IN (1, 4) AS is_valid, pos % 5 IN (1, 3, 4) AS is_absolute FROM links""",
    "b06_with_company_name": f"""SELECT page_id, domain, CASE WHEN domain = '' THEN 'Unknown' WHEN {_LABEL} = '' THEN domain
  ELSE array_to_string(list_transform(regexp_extract_all({_LABEL}, '([\\p{{L}}]+|[^\\p{{L}}]+)'), lambda w: upper(w[1]) || lower(w[2:])), '') END AS company
FROM (SELECT *, split_part(domain, '.', 1) AS domain_part FROM (SELECT page_id, {_COMPANY.replace(chr(92) * 2, chr(92))} AS domain FROM pages) q) r""",
    "b07_with_base_name": f"SELECT page_id, {_BASE} AS base FROM pages",
    "b08_with_sha1": "SELECT page_id, sha1(html) AS sha1 FROM pages",
    "g08c_snapshot_versions": "SELECT page_id, url FROM pages",
}
