from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postings.operators import dates as D
from postings.operators import enrich as K
from postings.operators import extraction as X
from postings.operators import normalize as N
from postings.plans.load import jobs_from_responses


@pytest.fixture
def run(spark):
    """Decode one response and return its cleaned postings in order, with the input."""
    def load(page: dict | str):
        text = page if isinstance(page, str) else json.dumps(page)
        df = spark.createDataFrame([(1, "e.com", "https://e.com/list", "Given", text)], "page int, domain string, url string, title string, response string")
        jobs, errors = jobs_from_responses(df)
        return [r.asDict() for r in jobs.orderBy("pos").collect()], errors

    return load


def test_sanitize(spark):
    cases = [
        ('```json\n{"key": "value"}\n```', '{"key": "value"}'), ('```\n{"key": "value"}\n```', '{"key": "value"}'),
        ("{“key”: “value”}", '{"key": "value"}'), ('{"items": [1, 2, 3,], "last": "value",}', '{"items": [1, 2, 3], "last": "value"}'),
        ('{"key": "value\x00\x08\x0B"}', '{"key": "value"}'), ("‘a’ «b»", "'a' \"b\""),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    assert [r.t for r in X.sanitize_json_text(df, "t").collect()] == [c[1] for c in cases]


DECODED = [
    ('{"key": "value", "number": 42}', "strict", '{"key":"value","number":42}'),
    ('```json\n{"key": "value"}\n```', "sanitized", '{"key":"value"}'),
    ('{"items": [1, 2, 3,]}', "sanitized", '{"items":[1,2,3]}'),
    ('Here is the JSON: {"key": "value"}', "slice", '{"key":"value"}'),
    ('{"key": "value"} and some more text', "slice", '{"key":"value"}'),
    ("{'a': 1, b: 2}", "lenient", '{"a":1,"b":2}'),
    ("so: {'a': 1} ok", "slice_lenient", '{"a":1}'),
    ('{"a": 1, "a": 2}', "strict", '{"a":2}'),
    ('{"a": 1}] junk', "slice", '{"a":1}'),
    ('{"a": 1} {"b": 2}', None, None),
    ("not json at all", None, None), ("", None, None), (None, None, None),
]


def test_decode(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(DECODED)], "page int, response string")
    good, bad = X.decode_json_robust(df)
    got = {r.page: (r.strategy, r.v) for r in good.select("page", "strategy", F.to_json("value").alias("v")).collect()}
    assert got == {i: c[1:] for i, c in enumerate(DECODED) if c[1]}
    assert {r.page for r in bad.collect()} == {i for i, c in enumerate(DECODED) if not c[1]}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='{}[]",:\'`1a \\\n“', max_size=30), min_size=1, max_size=60))
def test_decoding_never_fails(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "page int, response string")
    good, bad = X.decode_json_robust(df)
    assert good.count() + bad.count() == len(texts)


def test_model_calls_back_off(spark):
    assert X.backoff_delays(3, 1.0, 2.0, 3.0) == [1.0, 2.0, 3.0]
    for kwargs in ({"max_retries": -1, "base": 1}, {"max_retries": 1, "base": 0}, {"max_retries": 1, "base": 10, "max_delay": 5},
                   {"max_retries": 1, "base": 1, "factor": 1}):
        with pytest.raises(ValueError):
            X.backoff_delays(**kwargs)

    def call(text: str) -> str:
        if text == "bad":
            raise ConnectionError("down")
        if text == "fatal":
            raise KeyError("no")
        return text.upper()

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "fatal")], "page int, request string")
    out = X.extract_with_model(df, call, base_sleep=0.001, retry_on=(ConnectionError,)).orderBy("page").collect()
    assert [(r.response, r.attempts, r.error) for r in out] == [("GOOD", 1, None), (None, 3, "down"), (None, 1, "'no'")]


@pytest.mark.parametrize("bucket, want", [
    *[(b, "intern") for b in ("internship", "Co-Op", "coop")], *[(b, "entry") for b in ("junior", "jr", "new grad", "new_grad")],
    *[(b, "mid") for b in ("mid-level", "mid level", "midlevel")], *[(b, "senior") for b in ("sr", " staff ", "principal")],
    *[(b, "director_vp") for b in ("director", "vp", "vice president", "head", "director_vp")],
    *[(b, "executive") for b in ("cxo", "c-level", "ceo", "cto", "cfo")], ("invalid_bucket", "unknown"), ("", "unknown"), (None, "unknown"),
])
def test_seniority_bucket(spark, bucket, want):
    df = spark.createDataFrame([(bucket, " ")], "seniority_bucket string, seniority_level string")
    assert N.normalize_seniority(df).first() == (want, "Unknown")


def test_white_space_lists_and_maps(spark):
    df = spark.createDataFrame([(" a  \n b ", [" x ", None, ""], {"k": " v  w ", "e": " "})], "title string, location array<string>, extra map<string,string>")
    squashed = N.normalize_whitespace(df).first()
    assert (squashed.title, squashed.location, squashed.extra) == ("a b", ["x", ""], {"k": "v w", "e": ""})
    dropped = N.omit_empty(N.normalize_whitespace(df)).first()
    assert (dropped.location, dropped.extra) == (["x"], {"k": "v w"})


def test_cleaning(run):
    jobs, errors = run({"source_url": " https://example.com/x ", "page_title": " Jobs ", "jobs": [
        {"title": "  Software  Engineer ", "job_url": "https://example.com/job1", "company": None, "location": "", "seniority_bucket": "jr"}]})
    job = jobs[0]
    assert (job["title"], job["company"], job["location"]) == ("Software Engineer", None, None)
    assert (job["seniority_bucket"], job["seniority_level"]) == ("entry", "Unknown")
    assert (job["source_url"], job["page_title"]) == ("https://example.com/x", "Jobs")
    assert errors.count() == 0


def test_duplicates_keep_the_richest_at_the_first_place(run):
    jobs, _ = run({"jobs": [
        {"title": "A", "job_url": "https://e.com/1"}, {"title": "B", "requisition_id": "REQ1"},
        {"title": "A2", "job_url": "HTTPS://e.com/1", "location": "SF", "company": "Acme"}, {"title": "B2", "requisition_id": "req1"},
        {"title": "C", "location": "SF"}, {"title": "c", "location": "sf"}]})
    assert [(j["title"], j["pos"], j["copies"]) for j in jobs] == [("A2", 0, 2), ("B", 1, 2), ("C", 4, 2)]


def test_relative_and_absolute_forms_survive_cleaning(run):
    jobs, _ = run({"source_url": "https://h.com/l", "jobs": [{"title": "x", "job_url": "/x"}, {"title": "x", "job_url": "https://h.com/x"}]})
    assert [j["job_url"] for j in jobs] == ["https://h.com/x", "https://h.com/x"]


def test_locations(run):
    jobs, _ = run({"jobs": [{"title": "a", "location": ["San Francisco", " ", 3, "New  York"]}, {"title": "b", "location": 7}, {"title": "c", "location": " x  y "}]})
    assert [j["location"] for j in jobs] == ["San Francisco, New York", None, "x y"]


def test_entries_that_are_no_objects(run):
    assert [j["title"] for j in run({"jobs": [{"title": "Valid Job"}, "invalid job", 123, None]})[0]] == ["Valid Job"]
    assert run({"jobs": "not a list"})[0] == []
    assert run("[1, 2]")[0] == []
    jobs, errors = run("nothing here")
    assert jobs == [] and errors.first().error_type == "json_error"


def test_page_with_a_broken_posting_stays_raw(run):
    jobs, _ = run({"jobs": [{"title": " A ", "job_url": "u"}, {"title": " A ", "job_url": "u"}, {"title": "B", "job_url": 5}]})
    assert [(j["title"], j["warning"]) for j in jobs] == [(" A ", "normalize_error"), (" A ", "normalize_error"), ("B", "normalize_error")]
    assert run({"jobs": [{"title": "A", "job_url": 0}, {"title": "B", "seniority_bucket": []}]})[0][0]["warning"] is None


def test_stats(spark):
    rows = [("p", i, t) for i, t in enumerate(["a", "b", "a", "c"])]
    jobs = spark.createDataFrame(rows, "page string, pos int, title string")
    for c in ("job_url", "requisition_id", "location", "company", "seniority_bucket", "seniority_level"):
        jobs = jobs.withColumn(c, F.lit(None).cast("string"))
    skipped = spark.createDataFrame([("p", 2), ("q", 1)], "page string, skipped bigint")
    stats = N.dedupe_stats(N.normalize_and_dedupe(jobs), skipped=skipped).orderBy("page").collect()
    assert [tuple(r) for r in stats] == [("p", 6, 3, 1), ("q", 1, 0, 0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["", "x", "X ", "y"]), st.sampled_from(["", "t", "u"]), st.sampled_from(["", "c"])), min_size=1, max_size=40))
def test_dedupe_against_brute_force(spark, rows):
    jobs = spark.createDataFrame([(p, i, u, t, c) for i, (p, u, t, c) in enumerate(rows)], "page string, pos int, job_url string, title string, company string")
    for c in ("requisition_id", "location", "seniority_bucket", "seniority_level"):
        jobs = jobs.withColumn(c, F.lit(None).cast("string"))
    best: dict = {}
    for i, (p, u, t, c) in enumerate(rows):
        u = u.strip()
        key = (p, f"url::{u.lower()}" if u else f"tl::{t}@@")
        score = sum(map(bool, (u, t, c)))
        if key not in best:
            best[key] = [i, score, (t or None, c or None)]
        elif score > best[key][1]:
            best[key][1:] = [score, (t or None, c or None)]
    got = {(r.page, r.sig): (r.pos, (r.title, r.company)) for r in N.normalize_and_dedupe(jobs).collect()}
    assert got == {k: (v[0], v[2]) for k, v in best.items()}


def test_posted_dates(spark):
    cases = [("2026-01-08", (2026, 1, 8)), ("2026/01/08", (2026, 1, 8)), ("08-01-2026", (2026, 1, 8)), ("08/01/2026", (2026, 1, 8)),
             ("January 8, 2026", (2026, 1, 8)), ("Jan 8, 2026", (2026, 1, 8)), ("8 january 2026", (2026, 1, 8)), ("01/18/2026", (2026, 1, 18)),
             (" 2026-1-8 ", (2026, 1, 8)), ("2026-01-08T12:30:45", (2026, 1, 8, 12, 30, 45)), ("2026-01-08 01:02:03", (2026, 1, 8, 1, 2, 3)),
             ("not-a-date", None), ("", None), ("99/99/9999", None), ("2026-02-30", None), (None, None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    got = [r.posted_at for r in D.parse_posted_date(df, "t").collect()]
    assert got == [dt.datetime(*c[1]) if c[1] else None for c in cases]


def test_relative_dates_and_recency(spark):
    now = dt.datetime(2024, 1, 31, 12)
    cases = [("today", 0), ("Posted yesterday", 1), ("3 days ago", 3), ("2 weeks ago", 14), ("1 month ago", 30), ("2 years ago", 730), ("3daysago", 3)]
    df = spark.createDataFrame([(c[0],) for c in cases] + [("not-relative",), ("",), ("99999999999999999999 years ago",), ("9999999 years ago",)], "t string")
    out = D.parse_relative_date(df, "t", now)
    assert [r.posted_at for r in out.collect()] == [now - dt.timedelta(days=c[1]) for c in cases] + [None] * 4
    assert D.filter_recent(out.filter("posted_at is not null"), "posted_at", now, days=30).count() == 6


def test_enrichment(spark):
    places = {"San Francisco, CA": "United States", "Remote in United States": "United States", "London, UK": "United Kingdom",
              "Amsterdam, Netherlands": "Netherlands", "Multiple locations": "Unknown", "Remote": "Unknown", "": "Unknown",
              "Offices in Germany and France": "Germany", "Toronto, canada": "Canada", "Indianapolis": "Unknown", "CA": "Unknown"}
    titles = {"Software Engineer": ("Engineering", "mid"), "SWE": ("Engineering", "mid"), "ML Engineer": ("Data Science", "mid"),
              "Product Designer": ("Design", "mid"), "Senior Software Engineer": ("Engineering", "senior"), "Staff Engineer": ("Engineering", "staff"),
              "Engineering Manager": ("Engineering", "director_vp"), "Intern": ("Other", "intern"), "Finance Internship": ("Finance", "intern"),
              "Account Executive": ("Sales", "mid"), "International Recruiter": ("HR", "mid"), "": ("Other", "unknown")}
    got = K.infer_country(spark.createDataFrame([(p,) for p in places], "location string")).collect()
    assert {r.location: r.country for r in got} == places
    rows = K.infer_seniority(K.infer_category(spark.createDataFrame([(t,) for t in titles], "title string"))).collect()
    assert {r.title: (r.team_or_category, r.seniority_bucket) for r in rows} == titles
    html = spark.createDataFrame([("<p>One <b>two</b></p><script>x</script><p>three<br>four</p>",), (None,)], "h string")
    assert [r.job_description for r in K.clean_description(html, "h").collect()] == ["One two\n\nthree\n\nfour", ""]
