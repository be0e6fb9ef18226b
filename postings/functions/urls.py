"""URL expressions. One regular expression splits a URL (RFC 3986, appendix B, with the strict
scheme production); everything else is string and array functions, so links never leave the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postings.functions.text import let, slug, squash, strip, title_case

URL_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
DOT_SEGMENT = r"(^|/)\.\.?(/|\z)"

# Query parameters that only track the visitor, and the schemes that carry a host.
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid",
]
HOST_SCHEMES = ["", "http", "https", "ftp", "file", "sftp", "ws", "wss"]


def _parts(url: Column) -> Column:
    """The five parts of a URL, "" where absent, from one match."""
    # Tabs and line breaks inside a URL are ignored, as are leading controls and blanks.
    clean = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    return F.split(F.regexp_replace(clean, URL_PARTS, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")


def _scheme(parts: Column) -> Column:
    return F.lower(parts[0])


def _splittable(parts: Column) -> Column:
    # An authority with an unbalanced bracket is the one form that cannot be split.
    return parts[1].contains("[") == parts[1].contains("]")


def authority_of(url: Column) -> Column:
    """Host and port as written; "" when there is none."""
    return _parts(url)[1]


def path_of(url: Column) -> Column:
    return _parts(url)[2]


def _assemble(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column) -> Column:
    """Put the parts together; every argument should be cheap to read more than once."""
    slash = F.when((path != "") & ~path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    # Without a host, schemes that usually have one still show the empty authority.
    hostless = F.when(scheme.isin(HOST_SCHEMES) & (scheme != "") & path.rlike(r"^(/|\z)"), F.lit("//")).otherwise(F.lit(""))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(authority != "", F.concat(F.lit("//"), authority, slash)).otherwise(hostless),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
    )


def _resolve_dots(segments: Column) -> Column:
    """Drop "." segments and let ".." take back the segment before it."""
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done)
        .otherwise(F.array_append(done, part)),
    )
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(kept, tail), "/")


def _join_path(base_path: Column, path: Column) -> Column:
    # Inner empty segments of a merged path vanish, the leading one (a rooted base) stays.
    merged = F.regexp_replace(F.concat(F.regexp_replace(base_path, r"[^/]*\z", ""), path), "/{2,}", "/")
    joined = let(
        F.when(path.startswith("/"), path).otherwise(merged),
        lambda p: F.when(p.rlike(DOT_SEGMENT), let(F.split(p, "/"), _resolve_dots)).otherwise(p),
    )
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("/"))


def _joined(href: Column, b: Column, h: Column) -> Column:
    own = F.coalesce(F.nullif(_scheme(h), F.lit("")), _scheme(b))

    def target(authority: Column, path: Column, query: Column) -> Column:
        return F.struct(authority.alias("authority"), path.alias("path"), query.alias("query"), own.alias("scheme"))

    parts = (
        F.when((h[1] != "") | (own != _scheme(b)), target(h[1], h[2], h[3]))
        .when(h[2] == "", target(b[1], b[2], F.coalesce(F.nullif(h[3], F.lit("")), b[3])))
        .otherwise(target(b[1], _join_path(b[2], h[2]), h[3]))
    )
    joined = let(parts, lambda t: F.when(
        (t["scheme"] != _scheme(b)) | ~t["scheme"].isin(HOST_SCHEMES), href,
    ).otherwise(_assemble(t["scheme"], t["authority"], t["path"], t["query"], h[4])))
    return F.when(_splittable(b) & _splittable(h), joined)


def resolve(base: Column, href: Column) -> Column:
    """Reference resolution of ``href`` against ``base``; NULL when either cannot be split."""
    pair = F.struct(_parts(base).alias("base"), _parts(href).alias("href"))
    joined = let(pair, lambda p: _joined(href, p["base"], p["href"]))
    return F.when(base.isNull() | (base == ""), href).when(href == "", base).otherwise(joined)


def _form_decode(text: Column) -> Column:
    # A "%" that starts no escape stands for itself.
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _form_encode(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def without_tracking(query: Column) -> Column:
    """Decode, drop tracking parameters (any case), encode again; order and blanks are kept."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            _form_decode(F.substring_index(p, "=", 1)).alias("key"),
            F.when(p.contains("="), _form_decode(p.substr(F.locate("=", p) + 1, F.length(p))))
            .otherwise(F.lit("")).alias("value"),
        ),
    )
    kept = F.filter(pairs, lambda p: ~F.lower(p["key"]).isin(TRACKING_PARAMS))
    text = F.transform(kept, lambda p: F.concat(_form_encode(p["key"]), F.lit("="), _form_encode(p["value"])))
    return F.when(query == "", F.lit("")).otherwise(F.array_join(text, "&"))


def normalized(url: Column) -> Column:
    """Lower-case scheme and authority, drop tracking parameters and the fragment."""
    def rebuilt(p: Column) -> Column:
        kept = F.struct(_scheme(p).alias("scheme"), F.lower(p[1]).alias("authority"), without_tracking(p[3]).alias("query"))
        text = let(kept, lambda k: _assemble(k["scheme"], k["authority"], p[2], k["query"], F.lit("")))
        return F.when(_splittable(p), text)

    return let(_parts(url), rebuilt)


def canonical(base: Column, href: Column) -> Column:
    """``href`` made absolute against ``base``, then normalised; NULL on failure."""
    return normalized(resolve(base, href))


def absolute_job_url(job_url: Column, source_url: Column, domain: Column) -> Column:
    """Absolute form of a posting's URL; query and fragment are left alone."""
    site = F.when(domain.rlike("^https?://"), domain).when(domain != "", F.concat(F.lit("https://"), domain))
    # The page's URL is the base; the domain where it is missing or cannot be split.
    base = F.when((source_url != "") & _splittable(_parts(source_url)), source_url).otherwise(site)

    def absolute(p: Column) -> Column:
        joined = F.when(p["base"].isNotNull(), resolve(p["base"], p["url"]))
        return F.when(p["url"].rlike("^https?://"), p["url"]).otherwise(F.coalesce(joined, p["url"]))

    pair = F.struct(strip(job_url).alias("url"), base.alias("base"))
    return F.when(job_url != "", let(pair, absolute))


def is_valid(url: Column) -> Column:
    """http(s) with an authority; False (never NULL) otherwise."""
    text = strip(url)
    http = text.startswith("http://") | text.startswith("https://")
    split = let(_parts(text), lambda p: (p[1] != "") & _splittable(p))
    return F.coalesce(http & split, F.lit(False))


def is_absolute(url: Column) -> Column:
    split = let(_parts(url), lambda p: (p[0] != "") & (p[1] != "") & _splittable(p))
    return F.coalesce(split, F.lit(False))


def company_name(domain: Column) -> Column:
    """Readable company name from the first label of a domain."""
    # Fixed values, removed in this order wherever they occur in the label.
    label = F.substring_index(domain, ".", 1)
    for word in ["jobs", "careers", "career", "hiring", "join", "work"]:
        label = F.replace(label, F.lit(word), F.lit(""))

    name = title_case(squash(F.translate(label, "-_", "  ")))
    return F.when(domain.isNull() | (domain == ""), F.lit("Unknown")).otherwise(
        F.coalesce(F.nullif(name, F.lit("")), domain))


def last_segment_slug(url: Column, fallback: str) -> Column:
    """Slug of the last path segment without leading or trailing numbers, 40 characters at most."""

    segment = F.regexp_extract(path_of(url), r"([^/]+)/*\z", 1)
    segment = F.when(segment == "", F.lit(fallback)).otherwise(segment)
    bare = F.regexp_replace(F.regexp_replace(segment, r"^\d+[-_]*", ""), r"[-_]*\d+\z", "")
    text = slug(F.when(bare == "", F.lit(fallback)).otherwise(bare))
    return F.substring(F.when(text == "", F.lit(fallback)).otherwise(text), 1, 40)


def base_name(url: Column, title: Column | None = None) -> Column:
    """File stem of a capture: slug (the title's when the path is generic) and a short hash."""

    name = last_segment_slug(url, "index")
    if title is not None:
        from_title = slug(title)
        from_title = F.substring(F.when(from_title == "", F.lit("page")).otherwise(from_title), 1, 40)
        name = F.when(name.isin("index", "page") & (title != ""), from_title).otherwise(name)
    return F.concat(name, F.lit("__"), F.substring(F.sha1(url), 1, 8))


