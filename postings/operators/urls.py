"""Operators over a link, page or posting table that add or rewrite URL columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import urls as U


def with_domain(df: DataFrame, url: str = "url", out: str = "domain", lower: bool = True) -> DataFrame:
    """Authority of a URL, port included. ``lower=False`` keeps the case and gives NULL for none."""
    host = U.authority_of(F.col(url))
    return df.withColumn(out, F.lower(host) if lower else F.nullif(host, F.lit("")))


def canonicalize_links(df: DataFrame, base: str, href: str, out: str = "canonical_url") -> DataFrame:
    """Resolve ``href`` against ``base``, drop tracking parameters and fragment; NULL on failure."""
    return df.withColumn(out, U.canonical(F.col(base), F.col(href)))


def normalize_urls(df: DataFrame, url: str = "url", out: str = "normalized_url") -> DataFrame:
    """Like :func:`canonicalize_links` without a base; a URL that cannot be split stays as it is."""
    return df.withColumn(out, F.coalesce(U.normalized(F.col(url)), F.col(url)))


def absolutize_job_urls(
    df: DataFrame, job_url: str = "job_url", source_url: str = "source_url", domain: str = "domain",
    out: str | None = None,
) -> DataFrame:
    """Make posting URLs absolute by the page URL, else by the domain; complete ones stay verbatim."""
    return df.withColumn(out or job_url, U.absolute_job_url(F.col(job_url), F.col(source_url), F.col(domain)))


def incomplete_urls(df: DataFrame, job_url: str = "job_url") -> DataFrame:
    """Postings whose URL is still missing or relative."""
    return df.filter(~F.coalesce(F.col(job_url).startswith("http"), F.lit(False)))


def flag_valid_urls(df: DataFrame, url: str = "url") -> DataFrame:
    return df.withColumns({"is_valid": U.is_valid(F.col(url)), "is_absolute": U.is_absolute(F.col(url))})


def with_company_name(df: DataFrame, domain: str = "domain", out: str = "company") -> DataFrame:
    return df.withColumn(out, U.company_name(F.col(domain)))


def with_base_name(df: DataFrame, url: str = "url", title: str | None = "title", out: str = "base") -> DataFrame:
    return df.withColumn(out, U.base_name(F.col(url), F.col(title) if title else None))


def with_sha1(df: DataFrame, text: str, out: str = "sha1") -> DataFrame:
    return df.withColumn(out, F.sha1(F.col(text)))


# Kind of file, its folder and its extension.
CAPTURE_FILES = [
    ("full", "full", "html"),
    ("focus", "reduced_focus", "html"),
    ("lite", "reduced_lite", "html"),
    ("meta", "meta", "json"),
    ("signals", "signals", "json"),
]


def capture_files() -> dict[str, Column]:
    """Relative path of each file kept per capture, from ``domain``, ``base`` and ``page_id``."""
    stem = F.concat_ws(".", "base", "page_id")
    return {
        kind: F.concat_ws("/", "domain", F.lit(folder), F.concat(stem, F.lit(f".{ext}"))) for kind, folder, ext in CAPTURE_FILES
    }


def capture_paths(captures: DataFrame) -> DataFrame:
    """The five files of :func:`capture_files` as columns ``<kind>_path``."""
    return captures.withColumns({f"{kind}_path": path for kind, path in capture_files().items()})
