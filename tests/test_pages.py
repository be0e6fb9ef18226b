from __future__ import annotations

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from postings.operators import pages as P
from postings.operators import progress as R

LONG = "words and more words " * 15

CAREERS = f"""<!DOCTYPE html><html><head><title> Careers
 at  X </title><script>var a = "<a href='/jobs/9'>";</script></head><body>
<nav><a href="/about">About</a><a href="/p/2">Next ›</a></nav>
<main><h1>Open roles</h1>
<div class="job-listing card"><h2>Engineer</h2><p>{LONG}<a href="/jobs/1?utm_source=x#top">Apply</a></div>
<div class="job-listing card"><h2>Designer</h2><p>{LONG}<a href="../jobs/2">Apply &amp; win</a></div>
<ul><li>one<li>two<li>three</ul><button>Load more</button></main>
<div id="consent" class="cookie" style="position:fixed">{LONG}</div>
<div id="hid" style="display: none">{LONG}</div>
<div id="hidjobs" style="display:none">{LONG}<a href="https://boards.greenhouse.io/x">hidden role</a></div>
<div style="display:none">{LONG} no id</div>
<noscript><a href="/jobs/3">x</a></noscript></body></html>"""


@pytest.fixture(scope="module")
def parsed(spark):
    return P.html_nodes(spark.createDataFrame([(1, "https://e.com/careers/list", CAREERS)], "page_id int, url string, html string")).cache()


def nodes_of(spark, html):
    df = spark.createDataFrame([(1, "https://e.com", html)], "page_id int, url string, html string")
    return P.html_nodes(df).first()


def test_tree(spark):
    page = nodes_of(spark, "<ul><li>a<li>b <i>c</i></ul><p>x<p>y<div>z<br/></div><script>no</script><template><b>no</b></template>")
    shape = [(n.tag, n.parent, n.last, page.text[n.text_start:n.text_end]) for n in page.nodes]
    assert shape == [("ul", -1, 3, "ab c"), ("li", 0, 1, "a"), ("li", 0, 3, "b c"), ("i", 2, 3, "c"), ("p", -1, 4, "x"), ("p", -1, 5, "y"),
                     ("div", -1, 7, "z"), ("br", 6, 7, "")]
    assert page.clean_html == "<ul><li>a</li><li>b <i>c</i></li></ul><p>x</p><p>y</p><div>z<br></div>"


@pytest.mark.parametrize("html", [
    None, "", "plain", "<", "<div", "</p></div>", "<a href=x y>t", "<!doctype", "<![CDATA[x", "<b><i></b>t</i>", "<p" * 50, "<div>" * 3000 + "x",
    "&#xffffff;&bogus;&amp", "<td><td><tr><li></table>", "<script>never closed <div>", "<template><template></template>x</template>y",
])
def test_broken_markup_never_fails(spark, html):
    page = nodes_of(spark, html)
    for n in page.nodes:
        assert n.parent < n.id <= n.last < len(page.nodes)
        assert 0 <= n.text_start <= n.trim_start <= n.trim_end <= n.text_end <= len(page.text)
        assert page.text[n.trim_start:n.trim_end] == page.text[n.text_start:n.text_end].strip()
        assert page.clean_html[n.html_start:n.html_end].startswith(f"<{n.tag}")


def test_reparsing_clean_markup_changes_nothing(spark):
    first = nodes_of(spark, CAREERS)
    second = nodes_of(spark, first.clean_html)
    assert (second.text, second.clean_html, second.nodes) == (first.text, first.clean_html, first.nodes)


def test_odd_markup_loses_nothing(spark):
    page = nodes_of(spark, "<div>a<![foo[ x ]]></div><p>c</p>")
    assert page.text.startswith("a") and page.text.endswith("c") and "marked section" in page.parse_error  # skipped, and said so
    lite = P.reduce_lite(spark.createDataFrame([("<div><template-card>KEEP</template-card><p>mid</p><template>t</template>Z</div>",)], "html string")).first().lite_html
    assert lite.endswith("<div><template-card>KEEP</template-card><p>mid</p>Z</div>")


def test_long_pages_in_parts(spark):
    from postings.operators.extraction import build_extraction_requests, split_long_pages

    pages = spark.createDataFrame([(1, "x" * 95), (2, None), (3, "y" * 30), (4, "z" * 31)], "page int, html string")
    parts = split_long_pages(pages, 30, overlap=10).orderBy("page", "part").collect()
    assert [(r.page, r.part, len(r.html)) for r in parts if r.page != 1] == [(2, 0, 0), (3, 0, 30), (4, 0, 30), (4, 1, 11)]
    own = [r.html for r in parts if r.page == 1]
    assert own[0] + "".join(p[10:] for p in own[1:]) == "x" * 95 and max(map(len, own)) == 30
    assert not build_extraction_requests(pages, "p").filter("truncated").count()


def test_links(parsed):
    links = [r.link for r in P.ordered_job_links(parsed).orderBy("pos").collect()]
    assert links == ["https://e.com/jobs/1", "https://e.com/jobs/2", "https://boards.greenhouse.io/x"]
    assert P.ordered_job_links(parsed, cap=1).count() == 1


def test_counts_and_flags(parsed):
    # three list items and two cards
    assert P.job_list_len(parsed).first().n == 5
    controls = P.detect_pagination_controls(parsed).first()
    assert (controls.has_load_more, controls.has_next) == (True, True)
    flags, errors = P.detect_jobs_present(parsed)
    assert flags.first().found_by == "selector"
    assert errors.count() == 0


def test_listitem_roles_win_from_five_on(spark):
    html = "".join(f'<div role="listitem">{i}</div>' for i in range(5)) + "<li>x</li>"
    df = spark.createDataFrame([(1, html), (2, html[23:])], "page_id int, html string")
    assert {r.page_id: r.n for r in P.job_list_len(P.html_nodes(df)).collect()} == {1: 5, 2: 1}


def test_fingerprint(parsed):
    row = P.results_fingerprint(parsed, scroll_h=None).first()
    want = hashlib.sha1("one\n\ntwo\n\nthree".encode()).hexdigest()
    assert (row.url, row.text_fp, row.job_count, row.scroll_h) == ("https://e.com/careers/list", want, 3, 0)


def test_page_without_postings_is_reported(spark):
    df = spark.createDataFrame([(1, "https://E.com/x", "<title>T</title><p>nothing")], "page_id int, url string, html string")
    flags, errors = P.detect_jobs_present(P.html_nodes(df))
    row = errors.first()
    assert flags.first().jobs_present is False
    assert (row.domain, row.stage, row.error_type, row.severity) == ("e.com", "wait_for_jobs", "timeout", "warning")
    assert '"page_title":"T"' in row.metadata


def test_ignored(parsed):
    assert [r.attrs["id"] for r in P.ignored_nodes(parsed).collect()] == ["consent", "hid"]


def brute_focus(page, boost=25.0, min_text=200, top_n=10):
    """The scoring worked out in plain Python on the element table."""
    nodes, text = page.nodes, page.text
    job = lambda n: any(p in (n.attrs.get("href") or "").lower() for p in [*P.VENDOR_HOSTS, *P.JOB_PATHS])
    gone = [n for n in nodes if n.attrs.get("id") in ("consent", "hid")]
    alive = [n for n in nodes if not any(g.id <= n.id <= g.last for g in gone)]

    def text_of(n):
        out, at = "", n.text_start
        for g in gone:
            if g.id > n.id and g.last <= n.last:
                out, at = out + text[at:g.text_start], g.text_end
        return out + text[at:n.text_end]

    found = []
    for c in alive:
        body = text_of(c).strip()
        if not (c.tag in ("main", "article", "section", "div") or c.attrs.get("id") == "content") or len(body) <= min_text:
            continue
        inner = [n for n in alive if c.id < n.id <= c.last]
        links = [n for n in inner if n.tag == "a"]
        kids = [n for n in inner if n.parent == c.id]
        score = math.log2(1 + len(body)) + (3 if c.tag in ("main", "article") else 0)
        score += 1.5 if any(n.tag in ("h1", "h2", "h3") for n in inner) else 0
        score += 2 * sum(k.tag == kids[0].tag for k in kids) / len(kids) if len(kids) > 3 else 0
        score -= 2 * sum(len(text_of(n)) for n in links) / len(body)
        score += boost if any(job(n) for n in links) else 0
        found.append((score, c))
    found.sort(key=lambda f: (-f[0], f[1].id))
    return [f[0] for f in found[:top_n]], len(found)


@pytest.mark.parametrize("boost, top_n", [(25.0, 10), (0.0, 3)])
def test_focus_against_brute_force(parsed, boost, top_n):
    row = P.reduce_focus(parsed, top_n=top_n, job_link_boost=boost).first()
    scores, total = brute_focus(parsed.first(), boost, top_n=top_n)
    assert [s.score for s in row.signals] == pytest.approx(scores)
    assert (row.kept_count, row.total_candidates) == (len(scores), total)


def test_focus_markup(parsed):
    row = P.reduce_focus(parsed).first()
    assert row.focus_html.startswith('<!doctype html><meta charset="utf-8"><title>Careers at X</title><main>')
    assert "script" not in row.focus_html and "consent" not in row.focus_html and 'id="hid"' not in row.focus_html
    assert 'id="hidjobs"' in row.focus_html
    assert not re.search(r">\s+<", row.focus_html.split("</title>")[1].split("\n")[0])
    # an ignored banner inside a kept container is cut out of it
    assert row.total_candidates == 5


def test_cutting_inside_a_container(spark):
    html = f'<article>{LONG}<div id="b" class="promo" style="position: fixed">BANNER<a href="/jobs/1">x</a></div><p>tail</p></article>'
    row = P.reduce_focus(P.html_nodes(spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string"))).first()
    assert "BANNER" not in row.focus_html and "tail" in row.focus_html
    assert row.signals[0].text_len == len((LONG + "tail").strip())
    assert row.signals[0].has_job_links is False


def test_lite(spark):
    html = "<!DOCTYPE html><html>\n <body>  <p>a   b</p>\n<script>x</script><style>y</style></body></html>"
    row = P.reduce_lite(spark.createDataFrame([(html,)], "html string")).first()
    assert row.lite_html == '<!doctype html><meta charset="utf-8"><html><body><p>a b</p></body></html>'


def test_job_hrefs(spark):
    hrefs = {"https://Jobs.Lever.co/x": True, "/careers/1": True, "/x?gh_jid=1": True, "/about": False, "/job": False, None: False}
    df = P.classify_job_hrefs(spark.createDataFrame([(h,) for h in hrefs], "href string"))
    assert {r.href: r.is_job_link for r in df.collect()} == hrefs


# ---- capture sequences -----------------------------------------------------------------------


def replay(checks, jobs_max, budget, cap):
    streak = 0
    for i, (changed, count, elapsed) in enumerate(checks, 1):
        streak = 0 if changed else streak + 1
        if not changed and streak >= cap:
            return "stable", i
        if count >= jobs_max:
            return "jobs_cap", i
        if elapsed >= budget:
            return "time", i
    return "none", len(checks)


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_replay_across_blocks(spark, block):
    import random

    rng = random.Random(5)
    runs = {s: [(rng.random() < 0.6, rng.randint(0, 30), i) for i in range(rng.randint(1, 25))] for s in range(40)}
    rows = [(s, i, *c) for s, run in runs.items() for i, c in enumerate(run)]
    df = spark.createDataFrame(rows, "seed int, seq int, changed boolean, job_count int, elapsed int")
    out = R.replay_stop_reason(df, jobs_max=30, time_budget=20, no_change_cap=3, block=block).collect()
    assert {r.seed: (r.stop_reason, r.checks) for r in out} == {s: replay(run, 30, 20, 3) for s, run in runs.items()}


@pytest.mark.parametrize("block", [1, 4, 1000])
def test_progress_across_blocks(spark, block):
    states = [("u", "a", 1, 0), ("u", "a", 1, 500), ("u", "b", 3, 501), ("v", "b", 2, 1002), ("v", "b", 2, 1002), ("v", None, 2, None)]
    rows = [("s", i * 3, *st) for i, st in enumerate(states)]
    df = spark.createDataFrame(rows, "seed string, seq int, url string, text_fp string, job_count int, scroll_h int")
    out = R.capture_progress(df, block=block).orderBy("seq").collect()
    assert [r.reasons for r in out] == [None, [], ["text_changed", "more_jobs"], ["url_changed", "scroll_grew"], [], ["text_changed"]]
    assert [r.changed for r in out] == [None, False, True, True, False, True]


def test_pagination_stops(spark):
    def run(*checks):
        df = spark.createDataFrame([("s", i, *c) for i, c in enumerate(checks)], "seed string, seq int, changed boolean, has_next boolean")
        return R.replay_stop_reason(df, pages_max=3, mode="pagination").first().stop_reason

    assert run((True, True), (True, True)) == "pages_cap"
    assert run((True, True), (None, False)) == "no_next"
    assert run((False, True), (False, True)) == "pagination_stable"
    assert run((False, True), (True, True), (False, True)) == "none"
