"""Progress of a capture sequence: what changed between captures, when a crawl had to stop.

A seed may hold a third of all captures, so no window runs over a whole seed. Sequences are split
into blocks of consecutive numbers; windows stay inside (seed, block), each block hands one summary
row to a second, tiny window over blocks, and the carried values are joined back. The block rows
come from data already partitioned by (seed, block), so the captures are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postings.operators.urls import capture_files

BLOCK = 100_000


def _blocked(df: DataFrame, seq: str, block: int) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col(seq) / F.lit(block)).cast("bigint"))


def capture_progress(
    fingerprints: DataFrame, keys: Sequence[str] = ("seed",), seq: str = "seq", scroll_min: int = 500, block: int = BLOCK,
) -> DataFrame:
    """Compare each capture to the one before it: ``changed`` and the ``reasons``.

    The first capture of a sequence has nothing to compare with: ``changed`` is NULL.
    """
    keys = list(keys)
    state = F.struct("url", "text_fp", "job_count", "scroll_h")
    inner = Window.partitionBy(*keys, "_block").orderBy(seq)
    rows = _blocked(fingerprints, seq, block).withColumn("_prev", F.lag(state).over(inner))
    across = Window.partitionBy(*keys).orderBy("_block")
    carried = (
        rows.groupBy(*keys, "_block").agg(F.max_by(state, seq).alias("_last"))
        .select(*keys, "_block", F.lag("_last").over(across).alias("_carry"))
    )
    before = F.coalesce("_prev", "_carry")
    joined = rows.join(carried, [*keys, "_block"]).withColumn("_before", before)
    old = F.col("_before")
    tests = [
        ("url_changed", ~F.col("url").eqNullSafe(old["url"])),
        ("text_changed", ~F.col("text_fp").eqNullSafe(old["text_fp"])),
        ("more_jobs", F.coalesce("job_count", F.lit(0)) > F.coalesce(old["job_count"], F.lit(0))),
        ("scroll_grew", F.coalesce("scroll_h", F.lit(0)) > F.coalesce(old["scroll_h"], F.lit(0)) + scroll_min),
    ]
    reasons = F.filter(F.array(*[F.when(t, F.lit(n)) for n, t in tests]), lambda r: r.isNotNull())
    return joined.withColumn("reasons", F.when(old.isNotNull(), reasons)).withColumn(
        "changed", F.size("reasons") > 0).withColumn("changed", F.when(old.isNotNull(), F.col("changed"))).drop(
        "_prev", "_carry", "_block", "_before")


def replay_stop_reason(
    checks: DataFrame, jobs_max: int = 200, time_budget: float = 75, pages_max: int = 3, no_change_cap: int = 2,
    mode: str = "expansion", keys: Sequence[str] = ("seed",), seq: str = "seq", block: int = BLOCK,
) -> DataFrame:
    """First check at which a crawl stops, and why; "none" when it never does.

    ``expansion`` reads ``changed, job_count, elapsed`` (reasons jobs_cap, time, stable);
    ``pagination`` reads ``changed, has_next`` (no_next, pagination_stable, pages_cap).
    """
    keys = list(keys)
    upto = Window.partitionBy(*keys, "_block").orderBy(seq)
    changed = F.coalesce("changed", F.lit(False))
    rows = (
        _blocked(checks, seq, block)
        .withColumn("_rn", F.row_number().over(upto).cast("bigint"))
        .withColumn("_pages", F.sum(changed.cast("bigint")).over(upto))
        .withColumn("_hit", F.max(F.when(changed, F.col("_rn"))).over(upto))
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy(*keys, "_block")
        .agg(F.max("_rn").alias("n"), F.max("_pages").alias("pages"), F.max("_hit").alias("hit"))
        .withColumn("_rn0", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("_hit0", F.coalesce(F.max(F.col("_rn0") + F.col("hit")).over(before), F.lit(0)))
        .withColumn("_pages0", F.coalesce(F.sum("pages").over(before), F.lit(0)))
        .select(*keys, "_block", "_rn0", "_hit0", "_pages0")
    )
    rows = rows.join(totals, [*keys, "_block"])
    number = F.col("_rn0") + F.col("_rn")
    streak = number - F.coalesce(F.col("_rn0") + F.col("_hit"), F.col("_hit0"))
    if mode == "expansion":
        reason = (
            F.when(~changed & (streak >= no_change_cap), "stable")
            .when(F.col("job_count") >= jobs_max, "jobs_cap")
            .when(F.col("elapsed") >= time_budget, "time")
        )
    else:
        pages_seen = 1 + F.col("_pages0") + F.col("_pages")
        reason = (
            F.when(~F.coalesce("has_next", F.lit(False)), "no_next")
            .when(changed & (pages_seen >= pages_max), "pages_cap")
            .when(~changed & (streak >= no_change_cap), "pagination_stable")
        )
    hit = rows.withColumn("_reason", reason).withColumn("_number", number)
    first = F.min(F.when(F.col("_reason").isNotNull(), F.struct(F.col(seq), F.col("_reason"), F.col("_number"))))
    return (
        hit.groupBy(*keys).agg(first.alias("stop"), F.count(F.lit(1)).alias("recorded"))
        .select(
            *keys, F.coalesce("stop._reason", F.lit("none")).alias("stop_reason"), F.col(f"stop.{seq}").alias("stop_seq"),
            F.coalesce("stop._number", "recorded").alias("checks"),
        )
    )


def crawl_manifest(
    captures: DataFrame, counts: DataFrame, stops: DataFrame, keys: Sequence[str] = ("domain", "seed_base"), page: str = "page_id",
    config: dict[str, object] | None = None,
) -> DataFrame:
    """One row per crawled seed with its pages.

    ``captures`` has the keys, ``page`` and ``ts``; ``counts`` has ``page, unique_jobs, list_len``;
    ``stops`` has the keys, ``mode`` and ``stop_reason``. Where captures have ``domain`` and ``base``, an entry lists the
    capture's ``files``; ``config`` is what the crawl ran with, kept as a map of text. A seed keeps as many pages per crawl as
    the crawl's page limit allows, so the list is short; add ``run_id`` to the keys for a history.
    """
    keys = list(keys)
    fields = [F.col(page).alias("page_id"), F.struct("unique_jobs", "list_len").alias("counts"), F.col("ts").alias("ts")]
    if {"domain", "base"} <= set(captures.columns):
        captures = captures.withColumn("_files", F.struct(*[path.alias(kind) for kind, path in capture_files().items()]))
        fields.insert(1, F.col("_files").alias("files"))
    listed = captures.join(counts, page, "left").groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("pages"), F.max("ts").alias("ts"))
    settings = [F.lit(x) for k, v in sorted((config or {}).items()) for x in (k, str(v))]
    return listed.join(stops, keys, "left").select(
        *keys, F.coalesce("mode", F.lit("expansion")).alias("mode"), F.coalesce("stop_reason", F.lit("none")).alias("stop_reason"),
        "pages", F.create_map(*settings).cast("map<string,string>").alias("config"), "ts",
    )
