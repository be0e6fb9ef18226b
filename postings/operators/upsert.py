"""Validation of postings and the first-seen / last-seen upsert into the jobs table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.functions.text import has_ink, strip
from postings.functions.urls import company_name
from postings.operators.logs import rejects, split_rejects
from postings.schemas import JOBS, POSTING_FIELDS, POSTING_OPTIONAL, SENIORITY_BUCKETS


def error_rows(
    df: DataFrame, *, component: str, stage: str, error_type: str, severity: str, domain: Column, url: Column,
    message: Column, metadata: Column, created_at: Column | None = None,
) -> DataFrame:
    """Project rows into the shape of the error log."""
    none = F.lit(None).cast("string")
    return df.select(
        F.lit(component).alias("component"), F.lit(stage).alias("stage"), F.lit(error_type).alias("error_type"),
        F.lit(severity).alias("severity"), domain.alias("domain"), message.alias("message"), url.alias("url"),
        none.alias("exception_type"), none.alias("stack_trace"), metadata.alias("metadata"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def validate_pages(pages: DataFrame, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages whose ``jobs`` (ARRAY<VARIANT>, or a VARIANT) is a list of objects, and error rows
    for the others. URL and title must be present, as text; they are stripped. ``store``: a new folder for one pass
    over the input (:func:`postings.operators.logs.split_rejects`)."""
    jobs = F.col("jobs")
    if isinstance(pages.schema["jobs"].dataType, T.VariantType):
        jobs = F.try_variant_get(jobs, "$", "array<variant>")
    shape = rejects(
        ("source_url", F.col("source_url").isNotNull()),
        ("page_title", F.col("page_title").isNotNull()),
        ("jobs", jobs.isNotNull() & F.forall(jobs, lambda j: F.coalesce(F.schema_of_variant(j).startswith("OBJECT"), F.lit(False)))),
    )
    checked = pages.withColumns({
        "reasons": shape, "source_url": strip(F.col("source_url")), "page_title": strip(F.col("page_title")),
    })
    valid, bad = split_rejects(checked, store=store)
    errors = error_rows(
        bad, component="db", stage="validate_page", error_type="validation_error", severity="error",
        domain=F.col("domain"), url=F.coalesce("source_url", F.lit("")),
        message=F.concat(F.lit("invalid page: "), F.array_join("reasons", ", ")),
        metadata=_json(page_title=F.col("page_title"), jobs_count=F.coalesce(F.array_size(
            F.try_variant_get("jobs", "$", "array<variant>") if isinstance(pages.schema["jobs"].dataType, T.VariantType)
            else F.col("jobs")), F.lit(0))),
    )
    return valid, errors


def _with_reasons(jobs: DataFrame) -> DataFrame:
    checks = [
        ("job_url", has_ink(F.col("job_url"))),
        ("title", has_ink(F.col("title"))),
    ]
    out = jobs.withColumn("reasons", rejects(*checks))
    if "type_errors" in jobs.columns:
        # Fields that held a number, list or object where text belongs.
        out = out.withColumn("reasons", F.array_union("reasons", F.coalesce("type_errors", F.array().cast("array<string>"))))
    return out


def validate_jobs(jobs: DataFrame, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid postings with stripped text, and rejected ones with their ``reasons``. ``store``: a new folder for one pass
    over the input (:func:`postings.operators.logs.split_rejects`)."""
    valid, bad = split_rejects(_with_reasons(jobs), store=store)
    text = [c for c in POSTING_FIELDS if c in jobs.columns]
    return valid.withColumns({c: strip(F.col(c)) for c in text}), bad


def rejected_to_errors(rejected: DataFrame) -> DataFrame:
    """Error-log rows of rejected postings."""
    return error_rows(
        rejected, component="db", stage="validate_job", error_type="validation_error", severity="warning",
        domain=F.col("domain"), url=F.col("source_url"),
        message=F.concat(F.lit("invalid job: "), F.array_join("reasons", ", ")),
        metadata=_json(job_title=F.col("title"), job_url=F.col("job_url"), page_title=F.col("page_title")),
    )


def validate_page_strict(jobs: DataFrame, page: str = "page", pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """All-or-nothing validation: postings of pages without a fault, and per failing page the
    position of its first bad posting."""
    bad = F.when(F.size("reasons") > 0, F.col(pos))
    verdict = _with_reasons(jobs).groupBy(page).agg(F.min(bad).alias(pos))
    failed = verdict.filter(F.col(pos).isNotNull())
    return jobs.join(failed.select(page), page, "left_anti"), failed


def apply_job_defaults(jobs: DataFrame) -> DataFrame:
    bucket = F.col("seniority_bucket")
    return jobs.withColumns({
        "country": F.coalesce("country", F.lit("Unknown")),
        "seniority_level": F.coalesce("seniority_level", F.lit("Unknown")),
        "seniority_bucket": F.when(bucket.isin(SENIORITY_BUCKETS), bucket).otherwise(F.lit("unknown")),
    })


def promote_extra_fields(jobs: DataFrame, enabled: bool = True) -> DataFrame:
    """Fill empty columns from the key of the same name in the open map ``extra``."""
    if not enabled:
        return jobs
    # Keys of the open map that have a column of their own.
    keys = ["job_description", "weekly_hours", "apply_url", "job_id", "role_number", "job_family", "job_function"]
    return jobs.withColumns({
        k: F.coalesce(F.col(k), F.col("extra")[k]) if k in jobs.columns else F.col("extra")[k] for k in keys
    })


def build_job_records(jobs: DataFrame, now: dt.datetime, keep_posted_date: bool = False) -> DataFrame:
    """Rows of the jobs table (``first_seen_at`` still unset) from validated postings.

    ``date_posted`` is no field of a posting and is lost unless ``keep_posted_date`` moves it to
    ``date_posted_raw``.
    """
    present = set(jobs.columns)
    columns = {c: F.col(c) if c in present else F.lit(None).cast("string") for c in POSTING_FIELDS}
    if keep_posted_date and "date_posted" in present:
        columns["date_posted_raw"] = F.coalesce(columns["date_posted_raw"], F.col("date_posted"))
    extra = F.col("extra") if "extra" in present else F.lit(None).cast("map<string,string>")
    extra = F.coalesce(extra, F.create_map().cast("map<string,string>"))
    order = ["job_url", "title", "company", "location", "country", "team_or_category", "employment_type",
             "office_or_remote", "seniority_level", "seniority_bucket",
             *[c for c in POSTING_OPTIONAL if c not in {"company", "location", "team_or_category", "employment_type", "office_or_remote"}]]
    raw = F.to_json(F.struct(*[columns[c].alias(c) for c in order], extra.alias("extra")), {"ignoreNullFields": "true"})
    carried = [c for c in ("pos", "score") if c in present]
    return jobs.select(
        *[columns[c].alias(c) for c in POSTING_FIELDS],
        F.lit(None).cast("timestamp").alias("first_seen_at"),
        F.lit(now).cast("timestamp").alias("last_seen_at"),
        F.col("domain").alias("source_domain"),
        F.coalesce("source_url", F.lit("")).alias("source_page_url"),
        F.coalesce("page_title", F.lit("")).alias("source_page_title"),
        F.to_json(extra).alias("raw_extra"),
        raw.alias("raw_job"),
        *carried,
    )


def match_existing(batch: DataFrame, current: DataFrame) -> DataFrame:
    """Batch rows with ``is_new`` and the stored ``first_seen_at`` (as ``existing_first_seen``)."""
    known = current.select("job_url", F.col("first_seen_at").alias("existing_first_seen"), F.lit(True).alias("_known"))
    return (
        batch.join(known, "job_url", "left")
        .withColumn("is_new", F.col("_known").isNull())
        .drop("_known")
    )


def dedupe_batch(batch: DataFrame) -> DataFrame:
    """One row per ``job_url``: the richest, the earliest of equals.

    URLs only become comparable once absolute, so two postings kept per page may meet here.
    """
    names = [f.name for f in JOBS.fields]
    filled = sum((F.col(c).isNotNull().cast("int") for c in POSTING_FIELDS), F.lit(0))
    score = F.col("score") if "score" in batch.columns else filled
    pos = -F.col("pos") if "pos" in batch.columns else F.lit(0)
    order = [F.desc_nulls_last(c) for c in ("_score", "source_page_url", "_pos", "raw_job")]
    # Counted as well, so that rows are sorted after the shuffle only: before it, a task's part is as large as its file split.
    group = Window.partitionBy("job_url")
    return (
        batch.withColumns({"_score": score, "_pos": pos})
        .withColumns({"_rank": F.row_number().over(group.orderBy(*order)), "_copies": F.count(F.lit(1)).over(
            group.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
        .filter("_rank = 1 AND _copies > 0")
        .select(*names)
    )


def _merged(now: dt.datetime, old: str, new: str) -> list[Column]:
    stamp = F.lit(now).cast("timestamp")
    incoming, known = F.col(f"{new}.job_url").isNotNull(), F.col(f"{old}.job_url").isNotNull()
    out = []
    for field in JOBS.fieldNames():
        if field == "first_seen_at":
            # A stored NULL stays NULL: only a posting never seen before gets the stamp.
            value = F.when(known, F.col(f"{old}.first_seen_at").cast("timestamp")).otherwise(stamp)
        elif field == "last_seen_at":
            value = F.when(incoming, stamp).otherwise(F.col(f"{old}.last_seen_at").cast("timestamp"))
        else:
            value = F.coalesce(F.col(f"{new}.{field}"), F.col(f"{old}.{field}"))
        out.append(value.alias(field))
    return out


def upsert_jobs(current: DataFrame, batch: DataFrame, now: dt.datetime) -> DataFrame:
    """Next state of the jobs table.

    Both sides hold each ``job_url`` once (see :func:`dedupe_batch`), so no join key is hot. The
    full outer join shuffles the stored table once.
    """
    joined = current.alias("o").join(batch.alias("n"), F.col("o.job_url") == F.col("n.job_url"), "full_outer")
    return joined.select(*_merged(now, "o", "n"))


def upsert_summary(saved: DataFrame, rejected: DataFrame, non_objects: DataFrame | None = None) -> DataFrame:
    """Per domain: postings saved, skipped (rejected or no object) and validation errors."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = saved.select(F.col("source_domain").alias("domain"), one.alias("saved"), zero.alias("bad"), zero.alias("other"))
    rows = rows.unionByName(rejected.select("domain", zero.alias("saved"), one.alias("bad"), zero.alias("other")))
    if non_objects is not None:
        rows = rows.unionByName(non_objects.select("domain", zero.alias("saved"), zero.alias("bad"), F.col("skipped").alias("other")))
    return rows.groupBy("domain").agg(
        F.sum("saved").alias("jobs_saved"),
        F.sum(F.col("bad") + F.col("other")).alias("skipped"),
        F.sum("bad").alias("validation_errors"),
    )


def summary_steps(summary: DataFrame, run_id: str, now: dt.datetime) -> DataFrame:
    """The db_complete row of the process log per domain that saved something."""
    stamp = F.lit(now).cast("timestamp")
    return summary.filter("jobs_saved > 0").select(
        F.lit(run_id).alias("run_id"), F.lit("db_complete").alias("step"),
        company_name(F.col("domain")).alias("company"), "domain",
        stamp.alias("started_at"), F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit(None).cast("double").alias("duration_seconds"), F.lit("success").alias("status"),
        F.to_json(F.struct("jobs_saved", "skipped", "validation_errors")).alias("metadata"),
        stamp.alias("created_at"),
    )
