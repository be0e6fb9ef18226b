"""From raw pages to what is kept of a capture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.operators.pages import html_nodes, reduce_focus, reduce_lite
from postings.operators.urls import with_domain


def reduced_captures(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url", **focus) -> DataFrame:
    """Per page its ``domain``, ``url``, ``title`` and the five things kept: ``html``, ``focus_html``, ``lite_html``, ``signals``
    and ``reduce_meta``. Pages are parsed once and never shuffled; ``focus`` goes to the focus reduction.
    :func:`postings.sources.captures.write_captures` adds names and hashes and stores them."""
    named = with_domain(reduce_lite(pages, html), url).select(
        key, F.col(url).alias("url"), "domain", "lite_html", F.col(html).alias("full_html"), F.col(html).alias("html"))
    parsed = html_nodes(named, key=key, keep=("url", "domain", "lite_html", "full_html"))
    reduced = reduce_focus(parsed, key=key, keep=("domain", "lite_html", "full_html"), **focus)
    meta = F.struct("kept_count", "total_candidates", "url", "title")
    return reduced.withColumn("reduce_meta", meta).withColumnRenamed("full_html", "html").drop("kept_count", "total_candidates")
