"""Cleaning and deduplication of extracted postings.

Every step is a projection except :func:`dedupe_jobs`, which sorts the copies of each posting after one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.functions import urls as U
from postings.functions.text import blank_to_null, squash, strip
from postings.schemas import JOB_TEXT_FIELDS, RICHNESS_FIELDS

# Raw bucket names and the bucket each belongs to.
SENIORITY_ALIASES = {
    "intern": ["intern", "internship", "co-op", "coop"],
    "entry": ["entry", "new grad", "new_grad", "junior", "jr"],
    "mid": ["mid", "mid-level", "mid level", "midlevel"],
    "senior": ["senior", "sr", "staff", "principal"],
    "director_vp": ["director", "vp", "vice president", "head"],
    "executive": ["executive", "cxo", "c-level", "c level", "ceo", "cto", "cfo"],
}


def _job_fields(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    return [c for c in df.columns if c in {*JOB_TEXT_FIELDS, "extra"}]


def _squash_value(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return squash(value)
    if isinstance(dtype, T.ArrayType):
        kept = F.filter(value, lambda v: v.isNotNull()) if isinstance(dtype.elementType, T.AtomicType) else F.filter(
            value, lambda v: F.coalesce(F.size(v) > 0, F.lit(False)))
        return F.transform(kept, lambda v: _squash_value(v, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, v: _squash_value(v, dtype.valueType))
    return value


def _drop_empty(value: Column, dtype: T.DataType) -> Column:
    """NULL for a blank string or empty container; entries of containers are dropped alike."""
    if isinstance(dtype, T.StringType):
        return blank_to_null(value)
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.StringType):
            kept = F.filter(value, lambda v: v.isNotNull() & (v != ""))
        elif isinstance(dtype.elementType, (T.ArrayType, T.MapType)):
            kept = F.filter(value, lambda v: v.isNotNull() & (F.size(v) > 0))
        else:
            kept = F.filter(value, lambda v: v.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(dtype, T.MapType):
        cleaned = F.transform_values(value, lambda _, v: _drop_empty(v, dtype.valueType))
        kept = F.map_filter(cleaned, lambda _, v: v.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    return value


def _per_field(df: DataFrame, columns: Sequence[str] | None, rewrite: Callable[[Column, T.DataType], Column]) -> DataFrame:
    return df.withColumns({c: rewrite(F.col(c), df.schema[c].dataType) for c in _job_fields(df, columns)})


def normalize_whitespace(jobs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Collapse white space in text, and inside lists and maps; NULL and empty list items go."""
    return _per_field(jobs, columns, _squash_value)


def omit_empty(jobs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL for everything blank or empty; words such as "unknown" and the number 0 stay."""
    return _per_field(jobs, columns, _drop_empty)


def seniority_bucket(raw: Column) -> Column:
    names = {alias: bucket for bucket, aliases in SENIORITY_ALIASES.items() for alias in [bucket, *aliases]}
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(lookup[F.lower(strip(raw))], F.lit("unknown"))


def normalize_seniority(jobs: DataFrame) -> DataFrame:
    """Map the bucket to an allowed one ("unknown" otherwise); an empty level becomes "Unknown"."""
    return jobs.withColumns({
        "seniority_bucket": seniority_bucket(F.col("seniority_bucket")),
        "seniority_level": F.coalesce(blank_to_null(F.col("seniority_level")), F.lit("Unknown")),
    })


def canonical_location(jobs: DataFrame, col: str = "location") -> DataFrame:
    """One string per posting: lists are joined with ", ", blanks vanish, other types give NULL."""
    dtype = jobs.schema[col].dataType
    value = F.col(col)
    if isinstance(dtype, T.VariantType):
        items = F.try_variant_get(value, "$", "array<variant>")
        texts = F.filter(items, lambda v: F.schema_of_variant(v) == "STRING")
        joined = _joined(F.transform(texts, lambda v: F.try_variant_get(v, "$", "string")))
        text = F.when(F.schema_of_variant(value) == "STRING", squash(F.try_variant_get(value, "$", "string")))
        value = F.coalesce(joined, text)
    elif isinstance(dtype, T.ArrayType):
        value = _joined(value)
    elif isinstance(dtype, T.StringType):
        value = squash(value)
    else:
        value = F.lit(None).cast("string")
    return jobs.withColumn(col, F.nullif(value, F.lit("")))


def _joined(items: Column) -> Column:
    return F.array_join(F.filter(F.transform(items, squash), lambda v: v.isNotNull() & (v != "")), ", ")


def job_signature(jobs: DataFrame, out: str = "sig") -> DataFrame:
    """Identity of a posting: its URL, else its requisition id, else title and location."""
    def tagged(tag: str, name: str) -> Column:
        # NULL unless the field holds something, so that each is looked at once.
        return F.concat(F.lit(tag), F.nullif(F.lower(squash(F.col(name))), F.lit("")))

    def text(name: str) -> Column:
        return F.coalesce(F.lower(squash(F.col(name))), F.lit(""))

    return jobs.withColumn(out, F.coalesce(
        tagged("url::", "job_url"),
        tagged("rid::", "requisition_id"),
        F.concat(F.lit("tl::"), text("title"), F.lit("@@"), text("location")),
    ))


def richness_score(jobs: DataFrame, out: str = "score") -> DataFrame:
    """Number of filled fields plus at most three for the open map."""
    filled = [
        F.coalesce((F.col(c) != "").cast("int"), F.lit(0)) for c in RICHNESS_FIELDS if c in jobs.columns
    ]
    if "extra" in jobs.columns:
        filled.append(F.least(F.lit(3), F.greatest(F.coalesce(F.size("extra"), F.lit(0)), F.lit(0))))
    total = filled[0]
    for term in filled[1:]:
        total = total + term
    return jobs.withColumn(out, total)


def dedupe_jobs(jobs: DataFrame, page: str | Sequence[str] = "page", pos: str = "pos") -> DataFrame:
    """Per page and signature keep the richest copy, the earliest of equals.

    The kept copy takes the position of the first one; ``copies`` counts all of them. Rows are shuffled and sorted once,
    with the columns that are asked for later, and none are sorted before the shuffle, where a task's part of
    the input is as large as its file split. Input needs ``sig`` and ``score`` (:func:`job_signature`, :func:`richness_score`).
    """
    keys = [page] if isinstance(page, str) else list(page)
    carried = [c for c in jobs.columns if c not in {*keys, "sig", pos}]
    ranked = Window.partitionBy(*keys, "sig").orderBy(F.asc_nulls_first("score"), F.desc_nulls_first(pos))
    group = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        jobs.withColumns({
            "_rank": F.row_number().over(ranked), "_first": F.min(pos).over(group), "copies": F.count(F.lit(1)).over(group),
        })
        .filter("_rank = copies")  # of equals without a position the last
        .select(*keys, "sig", F.col("_first").alias(pos), "copies", *[c for c in carried if c != "copies"])
    )


def dedupe_stats(deduped: DataFrame, page: str | Sequence[str] = "page", skipped: DataFrame | None = None) -> DataFrame:
    """Per page: postings in, kept, removed. ``skipped`` (page, skipped) adds entries that were no
    objects; they count as input only."""
    keys = [page] if isinstance(page, str) else list(page)
    stats = deduped.groupBy(*keys).agg(
        F.sum("copies").alias("input_jobs"),
        F.count(F.lit(1)).alias("deduped_out"),
        F.sum(F.col("copies") - 1).alias("duplicates_removed"),
    )
    if skipped is None:
        return stats
    zero = F.lit(0).cast("bigint")
    return stats.join(skipped, keys, "full_outer").select(
        *keys,
        (F.coalesce("input_jobs", zero) + F.coalesce("skipped", zero)).alias("input_jobs"),
        F.coalesce("deduped_out", zero).alias("deduped_out"),
        F.coalesce("duplicates_removed", zero).alias("duplicates_removed"),
    )


def clean_jobs(jobs: DataFrame) -> DataFrame:
    """The row-wise part in order: white space, seniority, empties, location, signature, score."""
    steps = [normalize_whitespace, normalize_seniority, omit_empty, canonical_location, job_signature, richness_score]
    for step in steps:
        jobs = step(jobs)
    return jobs


def normalize_and_dedupe(jobs: DataFrame, page: str | Sequence[str] = "page", pos: str = "pos") -> DataFrame:
    """:func:`clean_jobs`, then :func:`dedupe_jobs`."""
    return dedupe_jobs(clean_jobs(jobs), page, pos)


def finalize_job_urls(jobs: DataFrame, source_url: str = "source_url", domain: str = "domain") -> tuple[DataFrame, DataFrame]:
    """Absolute URLs on deduplicated postings, and the postings whose URL stayed incomplete.

    A posting without a URL is left alone and not reported.
    """
    done = jobs.withColumn(
        "job_url", U.absolute_job_url(F.col("job_url"), F.col(source_url), F.col(domain)),
    )
    return done, done.filter(~F.col("job_url").startswith("http"))


def normalize_with_fallback(
    jobs: DataFrame, page: str | Sequence[str] = "page", pos: str = "pos", failed: str | None = None,
) -> DataFrame:
    """Like :func:`normalize_and_dedupe`, but a page holding a posting that cannot be normalised
    keeps its raw postings, marked with a ``warning``.

    The page's fate is read from ``page_failed``; where only postings carry a flag (``failed``) it
    is worked out first. Both kinds of pages go through one pass: a raw posting's signature is its
    position, which must be unique within the page, so that none is merged.
    """
    keys = [page] if isinstance(page, str) else list(page)
    if failed is not None:
        bad = jobs.groupBy(*keys).agg(F.bool_or(failed).alias("page_failed")).filter("page_failed")
        jobs = jobs.drop(failed).join(bad, keys, "left")
    fields = _job_fields(jobs, None)
    # The location is one string from here on, also on raw postings.
    kept = jobs.withColumn("_raw", F.struct(*[c for c in fields if c != "location"]))
    clean = clean_jobs(kept)
    is_raw = F.coalesce("page_failed", F.lit(False))
    restored = clean.withColumns({
        **{c: F.when(is_raw, F.col("_raw")[c]).otherwise(F.col(c)) for c in fields if c != "location"},
        "sig": F.when(is_raw, F.concat(F.lit("raw::"), F.col(pos).cast("string"))).otherwise(F.col("sig")),
        "warning": F.when(is_raw, F.lit("normalize_error")),
    })
    return dedupe_jobs(restored.drop("_raw", "page_failed"), page, pos)
