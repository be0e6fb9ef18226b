"""Analysis and reduction of stored HTML.

:func:`html_nodes` is the one step that needs Python: it reads each page once and returns one row
per page with its elements as an array. Everything after it works on that array inside the row -
counting, ranking, cutting - so none of the per-page operators shuffles or depends on how pages
are spread over hosts. An element knows the span of its text in ``text``, of its markup in
``clean_html`` and of its descendants in the array, which makes subtree questions range checks.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import urls as U
from postings.functions.text import WS, WS_CHARS, strip
from postings.operators.upsert import error_rows

# Worker processes get the parser by value: they need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values.
KEYWORDS = "(?i)(job|jobs|career|opening|openings|position|positions|role|roles|req|requisition|opportunit)"
VENDOR_HOSTS = [
    "greenhouse.io", "myworkdayjobs.com", "ashbyhq.com", "lever.co", "smartrecruiters.com", "jobvite.com",
    "boards.eu.greenhouse.io",
]
JOB_PATHS = [
    "/jobs/", "/job/", "/careers/", "/career/", "/positions/", "/position/", "gh_jid=", "gh_src=",
]
BANNER_WORDS = "cookie|consent|newsletter|subscribe|sign-?up|login|advert|promo|overlay|modal|toast|social|gdpr"

def _job_href(href: str) -> bool:
    text = href.lower()
    return any(part in text for part in (*VENDOR_HOSTS, *JOB_PATHS))


_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset(["script", "style", "noscript", "template"])
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
# An opening tag ends an open element of the given kinds, up to the nearest boundary.
_IMPLIED_END = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "a": (("a",), ("td", "th", "table")),
}

_NODE = pa.struct([
    ("id", pa.int32()), ("parent", pa.int32()), ("last", pa.int32()), ("depth", pa.int32()),
    ("child_pos", pa.int32()), ("n_children", pa.int32()), ("tag", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())), ("within", pa.list_(pa.string())), ("label", pa.string()),
    ("text_start", pa.int32()), ("text_end", pa.int32()), ("trim_start", pa.int32()), ("trim_end", pa.int32()),
    ("html_start", pa.int32()), ("html_end", pa.int32()), ("ignored", pa.bool_()), ("gone", pa.bool_()), ("ink", pa.int32()),
    ("link_text", pa.int32()), ("heads", pa.int32()), ("job_links", pa.int32()), ("kids", pa.int32()), ("kin", pa.int32()),
])
_NODE_DDL = (
    "struct<id:int,parent:int,last:int,depth:int,child_pos:int,n_children:int,tag:string,"
    "attrs:map<string,string>,within:array<string>,label:string,text_start:int,text_end:int,"
    "trim_start:int,trim_end:int,html_start:int,html_end:int,ignored:boolean,gone:boolean,ink:int,"
    "link_text:int,heads:int,job_links:int,kids:int,kin:int>"
)


_BANNER = re.compile(BANNER_WORDS)
_HIDDEN = re.compile(r"(^|;)(display:none|visibility:hidden|opacity:0(\.0*)?(;|!|\Z))")
_FIXED = re.compile("(^|;)position:fixed")
_BLANKS = np.array(sorted(map(ord, WS_CHARS)), np.uint32)


def _is_ignored(node: dict, job_ids: list[int]) -> bool:
    """Has an id, and is hidden without job links inside, or a fixed banner. Only inline styles are known offline."""
    attrs = node["attrs"]
    if not attrs.get("id"):
        return False
    style = re.sub(r"\s", "", attrs.get("style", ""), flags=re.ASCII).lower()
    if "hidden" in attrs or _HIDDEN.search(style):
        at = bisect_right(job_ids, node["id"])
        if at == len(job_ids) or job_ids[at] > node["last"]:
            return True
    return bool(_FIXED.search(style) and _BANNER.search(f"{attrs['id']} {attrs.get('class', '')}".lower()))


def _measure(nodes: list[dict], text: str) -> None:
    """Mark what the focus reduction leaves out, and sum up for every element what remains inside it.

    ``ignored``: outermost element left out; ``gone``: that or inside one; ``ink``: characters of the text, trimmed;
    ``link_text``: characters of links; ``heads``, ``job_links``: headings and job links; ``kids``: children, and
    ``kin`` those of the first one's tag. One pass over the elements, then differences of running sums.
    """
    links = [(n["id"], _job_href(n["attrs"].get("href", ""))) for n in nodes if n["tag"] == "a"]
    job_ids = [i for i, job in links if job]
    spans, at = [], 0
    while at < len(nodes):
        node = nodes[at]
        hit = _is_ignored(node, job_ids)
        if hit:
            spans.append((node["id"], node["last"], node["text_start"], node["text_end"]))
        end = node["last"] + 1 if hit else at + 1
        for n in nodes[at:end]:
            n["ignored"], n["gone"], n["kids"], n["kin"] = n is node and hit, hit, 0, 0
        at = end
    first: dict[int, str] = {}
    for n in nodes:
        if not n["gone"] and n["parent"] >= 0:
            parent = nodes[n["parent"]]
            parent["kids"] += 1
            parent["kin"] += first.setdefault(n["parent"], n["tag"]) == n["tag"]
    ids, last = (np.array([n[c] for n in nodes], np.int64) for c in ("id", "last"))
    low, high = (np.array([n[c] for n in nodes], np.int64) for c in ("text_start", "text_end"))
    lost_at = np.array([s[0] for s in spans], np.int64)
    lost = np.concatenate(([0], np.cumsum([s[3] - s[2] for s in spans], dtype=np.int64)))

    def within(places: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Sum over those of ``places`` (ids in order) that lie behind an element's start and not behind its end."""
        return sums[np.searchsorted(places, last, "right")] - sums[np.searchsorted(places, ids, "right")]

    inside = within(lost_at, lost)
    alive = [(i, job) for i, job in links if not nodes[i]["gone"]]
    link_ids = np.array([i for i, _ in alive], np.int64)
    own = (high - low - inside)[link_ids] if len(link_ids) else np.zeros(0, np.int64)
    head_ids = np.array([n["id"] for n in nodes if n["tag"] in ("h1", "h2", "h3") and not n["gone"]], np.int64)
    sums = {
        "link_text": within(link_ids, np.concatenate(([0], np.cumsum(own)))),
        "job_links": within(link_ids, np.concatenate(([0], np.cumsum([job for _, job in alive], dtype=np.int64)))),
        "heads": within(head_ids, np.arange(len(head_ids) + 1)),
    }
    if spans:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        keep = np.ones(len(code), bool)
        for _, _, a, b in spans:
            keep[a:b] = False
        ink = np.flatnonzero(keep & ~np.isin(code, _BLANKS))
        behind = np.concatenate(([0], np.cumsum(keep)))  # characters that remain before a place
        a, b = np.searchsorted(ink, low), np.searchsorted(ink, high)
        full = b > a
        sums["ink"] = np.zeros(len(nodes), np.int64)
        sums["ink"][full] = behind[ink[b[full] - 1] + 1] - behind[ink[a[full]]]
    else:
        sums["ink"] = np.array([n["trim_end"] - n["trim_start"] for n in nodes], np.int64)
    for name, values in sums.items():
        for n, value in zip(nodes, values.tolist()):
            n[name] = value


class _Outline(HTMLParser):
    """Collects elements in document order with their spans; broken markup never raises."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[dict] = []
        self.text: list[str] = []
        self.html: list[str] = []
        self.text_len = self.html_len = self.last_ink = 0
        self.skipping = 0
        self.title: list[str] | None = None
        self.failure: str | None = None
        self.reached = 0

    def _emit(self, markup: str) -> None:
        self.html.append(markup)
        self.html_len += len(markup)

    def _close_top(self) -> None:
        node = self.open.pop()
        if node["tag"] not in _VOID:
            self._emit(f"</{node['tag']}>")
        node["last"] = len(self.nodes) - 1
        node["text_end"], node["html_end"] = self.text_len, self.html_len
        if node["trim_start"] is None:
            node["trim_start"] = node["trim_end"] = node["text_start"]
        else:
            node["trim_end"] = self.last_ink
        if node["tag"] in ("a", "button") or node["attrs"].get("role") in ("button", "link"):
            span = "".join(self.text[node["_chunk"]:])
            node["label"] = span.strip()

    def _close_until(self, kinds: tuple[str, ...], boundary: tuple[str, ...]) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.open[depth]["tag"]
            if tag in kinds:
                while len(self.open) > depth:
                    self._close_top()
                return
            if tag in boundary:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skipping or tag in _DROPPED:
            self.skipping += tag in _DROPPED
            return
        if tag in _ENDS_PARAGRAPH:
            self._close_until(("p",), ("button", "td", "th", "caption", "object"))
        if tag in _IMPLIED_END:
            self._close_until(*_IMPLIED_END[tag])
        parent = self.open[-1] if self.open else None
        named: dict[str, str] = {}
        for name, value in attrs:
            named.setdefault(name, value or "")
        within = parent["_inside"] if parent else ()
        node = {
            "id": len(self.nodes), "parent": parent["id"] if parent else -1, "last": None,
            "depth": len(self.open), "child_pos": parent["n_children"] if parent else 0, "n_children": 0,
            "tag": tag, "attrs": named, "within": within, "label": None,
            "text_start": self.text_len, "text_end": None, "trim_start": None, "trim_end": None,
            "html_start": self.html_len, "html_end": None,
            "_inside": within if tag in within else (*within, tag), "_chunk": len(self.text),
        }
        if parent:
            parent["n_children"] += 1
        self.nodes.append(node)
        self.open.append(node)
        shown = "".join(f' {k}="{escape(v, quote=False).replace(chr(34), "&quot;")}"' for k, v in named.items())
        self._emit(f"<{tag}{shown}>")
        if tag == "title" and self.title is None:
            self.title = []
        if tag in _VOID:
            self._close_top()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A trailing slash means nothing in HTML, also not on a skipped element.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.skipping:
            self.skipping -= tag in _DROPPED
            return
        if any(node["tag"] == tag for node in self.open):
            while self.open[-1]["tag"] != tag:
                self._close_top()
            self._close_top()

    def handle_data(self, data: str) -> None:
        if self.skipping or not data:
            return
        if self.title is not None and self.open and self.open[-1]["tag"] == "title":
            self.title.append(data)
        body = data.rstrip()
        if body:
            first = self.text_len + len(data) - len(data.lstrip())
            for node in reversed(self.open):
                if node["trim_start"] is not None:
                    break
                node["trim_start"] = first
            self.last_ink = self.text_len + len(body)
        self.text.append(data)
        self.text_len += len(data)
        self._emit(escape(data, quote=False))

    def updatepos(self, i: int, j: int) -> int:
        """Called as the parser moves on: remembers how far it has come in the text at hand."""
        self.reached = max(i, j)
        return super().updatepos(i, j)

    def read(self, html: str) -> None:
        """Read a page. A declaration that cannot be read is left out up to its ">", and the page goes on behind it."""
        while True:
            self.reached = 0
            try:
                self.feed(html)
                self.close()
                return
            except (AssertionError, ValueError, IndexError) as exc:
                self.failure = self.failure or f"{type(exc).__name__}: {exc}"
                rest = self.rawdata[self.reached:]
                end = rest.find(">")
                self.rawdata = ""
                if end < 0:
                    return
                html = rest[end + 1:]

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections end at their ">", like a comment that is not closed properly; unknown kinds are noted."""
        kind = re.match(r"<!\[\s*(\w*)", self.rawdata[i:i + 40])
        if not kind or kind[1].lower() not in ("cdata", "if", "else", "endif"):
            self.failure = self.failure or f"marked section of unknown kind at {self.getpos()}"
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def parse_bogus_comment(self, i: int, report: int = 1) -> int:
        if self.rawdata.startswith("<!", i):
            self.failure = self.failure or f"malformed comment at {self.getpos()}"
        return super().parse_bogus_comment(i, report)

    def handle_comment(self, data: str) -> None:
        if not self.skipping:
            self._emit(f"<!--{data}-->")

    def finish(self) -> dict:
        while self.open:
            self._close_top()
        for node in self.nodes:
            del node["_inside"], node["_chunk"]
        text = "".join(self.text)
        _measure(self.nodes, text)
        return {
            "parse_error": self.failure,
            "title": " ".join("".join(self.title or []).split()),
            "text": text,
            "clean_html": "".join(self.html),
            "nodes": self.nodes,
        }


def _outline(html: str | None) -> dict:
    parser = _Outline()
    parser.read(html or "")
    return parser.finish()


def html_nodes(
    pages: DataFrame, key: str | list[str] = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",), partitions: int | None = None,
) -> DataFrame:
    """Parse each page once: keys and kept columns, ``title``, ``text``, ``clean_html``, ``nodes``, and ``parse_error``
    where some markup could not be read (it is skipped up to its ">").

    script, style, noscript and template are left out. ``nodes`` is in document order; ``last``
    is the id of an element's last descendant, ``within`` the distinct tags around it. Write the
    result to a table when several of the operators below are to use it.

    Parsing costs far more than reading: ``partitions`` deals the pages anew to so many tasks, for input that comes in
    fewer files or row groups than there are cores. By default pages are parsed where they are read.
    """
    keys = [key] if isinstance(key, str) else list(key)
    carried = [*keys, *[c for c in keep if c in pages.columns and c not in keys and c != html]]
    source = pages.select(*carried, html)
    if partitions:
        source = source.repartition(partitions)
    fields = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in carried)
    node_type = _NODE

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few pages at a time keep the outgoing batches small whatever the page size.
            for start in range(0, batch.num_rows, 16):
                part = batch.slice(start, 16)
                pages_out = [_outline(h) for h in part.column(html).to_pylist()]
                for page in pages_out:
                    for node in page["nodes"]:
                        node["attrs"] = list(node["attrs"].items())
                        node["within"] = list(node["within"])
                columns = [part.column(c) for c in carried]
                columns += [pa.array([p[c] for p in pages_out], pa.string()) for c in ("title", "text", "clean_html")]
                columns.append(pa.array([p["nodes"] for p in pages_out], pa.list_(node_type)))
                columns.append(pa.array([p["parse_error"] for p in pages_out], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*carried, "title", "text", "clean_html", "nodes", "parse_error"])

    return source.mapInArrow(parse, f"{fields}, title string, text string, clean_html string, nodes array<{_NODE_DDL}>, parse_error string")


def node_rows(parsed: DataFrame) -> DataFrame:
    """One row per element, for ad-hoc analysis."""
    keys = [c for c in parsed.columns if c not in {"title", "text", "clean_html", "nodes", "parse_error"}]
    return parsed.select(*keys, F.explode("nodes").alias("n")).select(*keys, "n.*")


# ---- expressions on an element -------------------------------------------------------------


def _attr(node: Column, name: str) -> Column:
    return F.coalesce(node["attrs"][name], F.lit(""))


def _span(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def _text_of(node: Column) -> Column:
    return _span(F.col("text"), node["trim_start"], node["trim_end"])


def _under(node: Column, *tags: str) -> Column:
    return F.arrays_overlap(node["within"], F.array(*[F.lit(t) for t in tags]))


def _href(node: Column) -> Column:
    return strip(_attr(node, "href"))


def is_job_href(href: Column) -> Column:
    """Link to a known job-board host or a path that looks like postings."""
    text = F.lower(F.coalesce(href, F.lit("")))
    hit = F.lit(False)
    for part in [*VENDOR_HOSTS, *JOB_PATHS]:
        hit = hit | text.contains(part)
    return hit


def classify_job_hrefs(links: DataFrame, href: str = "href", out: str = "is_job_link") -> DataFrame:
    return links.withColumn(out, is_job_href(F.col(href)))


def _first(items: Column, cap: int | None) -> Column:
    return items if cap is None else F.slice(items, 1, cap)


def _job_links(pattern: str, cap: int | None, base: str) -> Column:
    """Canonical URLs of the (first ``cap``) links whose address or text matches, document order."""
    anchors = F.filter("nodes", lambda n: (n["tag"] == "a") & (_href(n) != "") & _under(n, "main", "article", "section", "div"))
    hits = F.filter(anchors, lambda n: _href(n).rlike(pattern) | F.coalesce(n["label"], F.lit("")).rlike(pattern))
    urls = F.transform(hits, lambda n: U.canonical(F.col(base), _href(n)))
    return _first(F.filter(urls, lambda u: u.isNotNull() & (u != "")), cap)


def ordered_job_links(parsed: DataFrame, pattern: str = KEYWORDS, cap: int | None = None, base: str = "url", key: str = "page_id") -> DataFrame:
    """Job links per page in document order (``pos``, ``url``); repeats stay."""
    return parsed.select(key, F.posexplode(_job_links(pattern, cap, base)).alias("pos", "job_link")).withColumnRenamed("job_link", "link")


def _list_len() -> Column:
    items = F.size(F.filter("nodes", lambda n: _attr(n, "role") == "listitem"))
    cards = F.size(F.filter("nodes", lambda n: n["tag"].isin("article", "li") | (
        (n["tag"] == "div") & (_attr(n, "class").contains("card") | _attr(n, "class").contains("result")))))
    return F.when(items >= 5, items).otherwise(cards)


def job_list_len(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """Estimated number of listed postings: list items by role, else articles, items and cards."""
    return parsed.select(key, _list_len().alias("n"))


def _text_fingerprint(cap: int | None) -> Column:
    def is_item(n: Column) -> Column:
        listitem = _attr(n, "role") == "listitem"
        return (_under(n, "main") & (listitem | n["tag"].isin("article", "li"))) | (
            _under(n, "section") & (listitem | (n["tag"] == "article")))

    items = _first(F.filter("nodes", is_item), cap)
    return F.sha1(F.array_join(F.transform(items, _text_of), "\n\n"))


def page_text_fingerprint(parsed: DataFrame, cap: int | None = None, key: str = "page_id") -> DataFrame:
    """SHA-1 of the (first ``cap``) item texts, joined by blank lines."""
    return parsed.select(key, _text_fingerprint(cap).alias("text_fp"))


def results_fingerprint(
    parsed: DataFrame, pattern: str = KEYWORDS, cap: int | None = None, key: str = "page_id", base: str = "url",
    scroll_h: str | None = None,
) -> DataFrame:
    """State of a result page: URL, text fingerprint, number of job links, scroll height."""
    height = F.coalesce(F.col(scroll_h), F.lit(0)) if scroll_h else F.lit(0)
    return parsed.select(
        key,
        F.coalesce(U.normalized(F.col(base)), F.col(base)).alias("url"),
        _text_fingerprint(cap).alias("text_fp"),
        F.size(_job_links(pattern, cap, base)).alias("job_count"),
        height.alias("scroll_h"),
    )


def _any(test) -> Column:
    return F.exists("nodes", test)


def _label(n: Column) -> Column:
    return F.coalesce(n["label"], F.lit(""))


def _pagination_flags() -> dict[str, Column]:
    # Wording of "load more" and "next" controls.
    more_button = "(?i)load more|show more|see more|view more"
    more_other = "(?i)load more|show more"
    aria_more = "load more|show more"  # attribute values are compared as they are written

    def is_more(n: Column) -> Column:
        button = n["tag"] == "button"
        return (
            (button & (_label(n).rlike(more_button) | _attr(n, "aria-label").rlike(aria_more)))
            | (((n["tag"] == "a") | (_attr(n, "role") == "button")) & _label(n).rlike(more_other))
        )

    def is_next(n: Column) -> Column:
        is_link = ((n["tag"] == "a") & (_attr(n, "href") != "")) | (_attr(n, "role") == "link")
        is_button = (n["tag"] == "button") | (_attr(n, "role") == "button")
        name = F.when(_attr(n, "aria-label") != "", _attr(n, "aria-label")).otherwise(_label(n))
        arrow = _under(n, "nav") & n["tag"].isin("a", "button") & _label(n).rlike("[>›»]")
        by_rel = (n["tag"] == "a") & (_attr(n, "rel") == "next")
        return ((is_link | is_button) & F.lower(name).contains("next")) | by_rel | arrow

    return {"has_load_more": _any(is_more), "has_next": _any(is_next)}


def detect_pagination_controls(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """Per page: is there a "load more" control, is there a way to the next page."""
    return parsed.select(key, *[c.alias(n) for n, c in _pagination_flags().items()])


def detect_jobs_present(
    parsed: DataFrame, pattern: str = KEYWORDS, key: str = "page_id", base: str = "url", max_wait_ms: int = 35000,
) -> tuple[DataFrame, DataFrame]:
    """Per page the first evidence of postings (``found_by``), and warnings for pages without."""
    def is_item(n: Column) -> Column:
        cls = _attr(n, "class")
        return (
            (_attr(n, "role") == "listitem")
            | ((n["tag"] == "article") & cls.contains("job"))
            | ((n["tag"] == "div") & cls.contains("job-card"))
            | ((n["tag"] == "li") & cls.contains("position"))
            | ((n["tag"] == "a") & _attr(n, "href").contains("/jobs/"))
        )

    def is_next(n: Column) -> Column:
        return (
            ((n["tag"] == "button") & _under(n, "nav") & F.lower(_label(n)).contains("next"))
            | ((n["tag"] == "a") & (_attr(n, "rel") == "next"))
            | ((n["tag"] == "button") & _attr(n, "aria-label").contains("Next"))
        )

    found = (
        F.when(_any(is_item), F.lit("selector"))
        .when(F.size(_job_links(pattern, 5, base)) > 0, F.lit("link"))
        .when(_any(is_next), F.lit("next"))
    )
    flags = parsed.select(key, base, "title", found.alias("found_by"))
    flags = flags.withColumn("jobs_present", F.col("found_by").isNotNull())
    errors = error_rows(
        flags.filter(~F.col("jobs_present")), component="crawler", stage="wait_for_jobs", error_type="timeout",
        severity="warning", domain=F.lower(U.authority_of(F.col(base))), url=F.col(base),
        message=F.lit(f"No job listings detected after {max_wait_ms}ms wait"),
        metadata=F.to_json(F.struct(
            F.col(base).alias("seed_url"), F.lit(max_wait_ms).alias("max_wait_ms"), F.col("title").alias("page_title"))),
    )
    return flags.select(key, "jobs_present", "found_by"), errors


# ---- reduction -----------------------------------------------------------------------------


def _collapsed(markup: Column) -> Column:
    wide = WS[:-1] + r"\x{feff}]"  # the byte-order mark counts as white space in HTML
    return F.regexp_replace(F.regexp_replace(markup, wide + "{2,}", " "), f">{wide}+<", "><")


def reduce_lite(pages: DataFrame, html: str = "html", out: str = "lite_html") -> DataFrame:
    """Raw HTML without script, style, noscript and template, white space collapsed."""
    bare = F.regexp_replace(F.col(html), r"(?is)<(script|style|noscript|template)(?=[\s/>]).*?</\1\s*>", "")
    bare = F.regexp_replace(bare, r"(?is)^\s*<!doctype[^>]*>", "")
    return pages.withColumn(out, F.concat(F.lit('<!doctype html><meta charset="utf-8">'), _collapsed(bare)))


def _ignored() -> Column:
    """Outermost elements with an id that are hidden without job links, or fixed banners (marked by the parser)."""
    return F.filter("nodes", lambda n: n["ignored"])


def ignored_nodes(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """Elements the focus reduction leaves out, one row each."""
    return parsed.select(key, F.explode(_ignored()).alias("n")).select(key, "n.id", "n.tag", "n.attrs")


def _cut(text: Column, start: Column, end: Column, spans: Column, from_field: str, to_field: str) -> Column:
    """``text[start:end]`` without the given spans (sorted, disjoint)."""
    inside = F.filter(spans, lambda s: (s[from_field] >= start) & (s[to_field] <= end))
    stitched = F.aggregate(
        inside,
        F.struct(F.lit("").alias("done"), start.cast("int").alias("at")),
        lambda acc, s: F.struct(
            F.concat(acc["done"], _span(text, acc["at"], s[from_field])).alias("done"), s[to_field].cast("int").alias("at"),
        ),
        lambda acc: F.concat(acc["done"], _span(text, acc["at"], end)),
    )
    return F.when(F.size(inside) == 0, _span(text, start, end)).otherwise(stitched)


def reduce_focus(
    parsed: DataFrame, top_n: int = 10, min_text: int = 200, job_link_boost: float = 25.0, key: str = "page_id", url: str = "url",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Keep the best-scoring containers of a page.

    Per page ``focus_html``, the ``signals`` of the kept containers, ``kept_count`` and
    ``total_candidates``, and the ``keep`` columns; what the other containers hold, and those of up to ``min_text`` characters,
    is left out. ``job_link_boost=0`` and ``top_n=3`` give the older, plainer reduction.
    """
    def is_candidate(n: Column) -> Column:
        kind = n["tag"].isin("main", "article", "section", "div") | (_attr(n, "id") == "content")
        return kind & ~n["gone"] & (n["ink"] > min_text)

    def measured(c: Column) -> Column:
        role = F.lower(_attr(c, "role"))
        share = F.when((c["n_children"] > 3) & (c["kids"] > 3), c["kin"] / c["kids"]).otherwise(F.lit(0.0))
        return F.struct(
            c["id"].alias("id"), c["html_start"].alias("html_start"), c["html_end"].alias("html_end"),
            c["ink"].alias("text_len"), c["link_text"].alias("link_len"), c["heads"].alias("hcount"),
            (c["tag"].isin("main", "article") | (role == "main")).alias("is_main"),
            # Candidates are never nav, header or footer elements, unless picked by their id.
            (c["tag"].isin("nav", "header", "footer") | role.isin("navigation", "banner", "contentinfo")).alias("looks_nav"),
            (c["job_links"] > 0).alias("has_job_links"), share.alias("repetition"),
        )

    staged = parsed.withColumn("_measured", F.transform(F.filter("nodes", is_candidate), measured))

    def scored(m: Column) -> Column:
        density = F.when(m["text_len"] > 0, m["link_len"] / m["text_len"]).otherwise(F.lit(0.0))
        score = (
            F.log2(1 + m["text_len"]) + F.when(m["is_main"], 3.0).otherwise(0.0)
            + F.when(m["hcount"] > 0, 1.5).otherwise(0.0) + 2 * m["repetition"] - 2 * density
            - F.when(m["looks_nav"], 2.0).otherwise(0.0) + F.when(m["has_job_links"], float(job_link_boost)).otherwise(0.0)
        )
        return F.struct(
            (-score).alias("rank"), m["id"].alias("id"), m["html_start"].alias("html_start"), m["html_end"].alias("html_end"),
            F.struct(
                score.alias("score"), m["text_len"].alias("text_len"), density.alias("link_density"), m["hcount"].alias("hcount"),
                m["is_main"].alias("is_main"), m["looks_nav"].alias("looks_nav"), m["has_job_links"].alias("has_job_links"),
            ).alias("signals"),
        )

    staged = staged.withColumn("_kept", F.slice(F.array_sort(F.transform("_measured", scored)), 1, top_n))
    spans = F.col("_ignored")
    staged = staged.withColumn("_ignored", _ignored())
    pieces = F.transform("_kept", lambda k: _collapsed(
        _cut(F.col("clean_html"), k["html_start"], k["html_end"], spans, "html_start", "html_end")))
    return staged.select(
        key, F.col(url).alias("url"), "title", *keep,
        F.concat(
            F.lit('<!doctype html><meta charset="utf-8"><title>'), F.col("title"), F.lit("</title>"), F.array_join(pieces, "\n"),
        ).alias("focus_html"),
        F.transform("_kept", lambda k: k["signals"]).alias("signals"),
        F.size("_kept").alias("kept_count"),
        F.size("_measured").alias("total_candidates"),
    )
