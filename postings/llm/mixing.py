"""Mixing sources to target weights by nested hash thresholds.

Every document gets a hash; a source takes the documents below a threshold of that hash. Tokens are summed
by source and hash bucket, the bucket in which the running sum passes the budget is found,
and only that bucket is opened by further bits. The last step sees single hash values. Selection is
a filter, never a sort of documents, and depends on content only, so reruns agree.

A target of up to the source's size takes whole documents once; beyond it all are taken once and the rest
comes from a second, partial pass below the threshold. The threshold ends on the side of the last
hash value that is nearer to the target. Rows equal in id and text share a hash and go together. Null
texts count 0 words, a null source is a source of its own, a null id is hashed as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.llm.common import count_words, stored

WEIGHTS = (3, 1, 2)
#: Bits of the hash opened per level, 60 in all.
BITS = (12, 16, 32)
_KEY, _H = "mix_source_key", "mix_hash"


def row_hash(row_id: Column, text: Column) -> Column:
    """60 bits of MD5 over id and text, as a non-negative BIGINT."""
    whole = F.concat(F.coalesce(row_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """A non-null key that keeps a null source apart from an empty one."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``target`` to a table of one row per ``source`` with its ``source_size``.

    Water-filling: with sources ordered by size over weight, those before the first one that stays below its
    cap are capped and the others share what is left by weight. This table has a row per source, so its
    windows hold as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(w).cast("bigint") for w in weights])
    ranked = sources.withColumn("weight", F.element_at(choices, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = share * F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    leveled = ranked.withColumns({
        "place": F.row_number().over(fill), "own_level": budget / F.sum("weight").over(after), "cap": most * F.col("source_size"),
    })
    fits = F.col("own_level") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(fits, F.struct("place", "own_level"))).over(everything)["own_level"]
    filled = F.least("cap", F.coalesce(level * F.col("weight"), "cap")).cast("double")
    return leveled.withColumn("target", filled).select("source", "source_size", "target")


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the hash up to which its documents are taken in the partial pass.

    ``rows``: key, size, hash; ``budgets``: key and ``rest``, the words the partial pass may take.
    """
    state = budgets.select(_KEY, "rest", F.lit(0).cast("bigint").alias("below"), F.lit(0).cast("bigint").alias("prefix"))
    left = sum(BITS)
    running = Window.partitionBy(_KEY).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for bits in BITS:
        inside = rows.join(state, _KEY).filter(F.shiftright(_H, left) == F.col("prefix"))
        left -= bits
        summed = inside.groupBy(_KEY, F.shiftright(_H, left).alias("bucket")).agg(
            F.sum("size").alias("n"), F.first("rest").alias("rest"), F.first("below").alias("below"))
        reached = summed.withColumn("upto", F.col("below") + F.sum("n").over(running)).filter("upto >= rest")
        found = reached.groupBy(_KEY).agg(F.min(F.struct("bucket", "n", "upto", "rest")).alias("b"))
        state = stored(found.select(
            _KEY, F.col("b.rest").alias("rest"), (F.col("b.upto") - F.col("b.n")).alias("below"),
            F.col("b.bucket").alias("prefix"), F.col("b.n").alias("n"),
        ), "mix-level")
    # The last bucket is one hash value: in, if that ends nearer to the budget.
    nearer = F.col("below") + F.col("n") - F.col("rest") < F.col("rest") - F.col("below")
    return state.select(_KEY, F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("last_hash"))


def plan_mix(
    rows: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """Per source: key, ``source_size``, ``target``, whole passes ``full`` and ``last_hash`` of the partial one."""
    sizes = rows.groupBy(_KEY).agg(F.sum("size").alias("source_size"), F.first("source").alias("source"))
    goal = targets(sizes.select("source", "source_size"), share, most, weights)
    budgets = stored(goal.select(
        source_key(F.col("source")).alias(_KEY), "source_size", "target",
        F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0).cast("bigint").alias("full"),
        F.when(F.col("target") >= F.col("source_size"), F.col("target") - F.col("source_size")).otherwise(F.col("target")).alias("rest"),
    ), "mix-budget")
    return stored(budgets.join(thresholds(rows, budgets), _KEY, "left"), "mix-plan")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), source_key(F.col(source_col)).alias(_KEY),
        count_words(F.col(text_col)).alias("size"), row_hash(F.col(id_col), F.col(text_col)).alias(_H),
    )


def _passes() -> Column:
    return F.col("full") + F.when(F.col(_H) <= F.col("last_hash"), 1).otherwise(0)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """Per row: doc_id, size, source_size, target and ``taken``, the words the mix takes, repeats counted."""
    rows = stored(_sized(docs, id_col, text_col, source_col), "mix-sizes")
    plan = plan_mix(rows, share, most, weights)
    return rows.join(plan, _KEY).select("doc_id", "size", "source_size", "target", (F.col("size") * _passes()).alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows the mix takes, with their own columns and ``copies``, the times each is used (in place of a column of that name)."""
    rows = stored(_sized(docs, id_col, text_col, source_col), "mix-sizes")
    plan = plan_mix(rows, **how).select(_KEY, "full", "last_hash")
    # The rows travel as one struct, so that no column of theirs meets one of the plan.
    keyed = docs.select(F.struct(*docs.columns).alias("row"), source_key(F.col(source_col)).alias(_KEY), row_hash(F.col(id_col), F.col(text_col)).alias(_H))
    taken = keyed.join(plan, _KEY).withColumn("copies", _passes()).filter("copies > 0")
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "copies"], "copies")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM {docs}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM s),
f AS (SELECT *, row_number() OVER w AS place, 2.0::DOUBLE * source_size AS cap,
    (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
  FROM r WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)),
t AS (SELECT *, least(cap, coalesce((SELECT own_level FROM f WHERE own_level * weight <= cap ORDER BY place LIMIT 1) * weight, cap)) AS target FROM f),
b AS (SELECT source, source_size, target, CASE WHEN target >= source_size THEN 1 ELSE 0 END AS whole,
    CASE WHEN target >= source_size THEN target - source_size ELSE target END AS rest FROM t),
g AS (SELECT source, h, sum(size) AS n, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY source, h),
e AS (SELECT g.source, min(struct_pack(h := h, n := n, upto := upto, rest := rest)) AS x
  FROM g JOIN b ON g.source IS NOT DISTINCT FROM b.source WHERE upto >= rest GROUP BY g.source),
l AS (SELECT source, CASE WHEN x.upto - x.rest < x.rest - (x.upto - x.n) THEN x.h ELSE x.h - 1 END AS last_hash FROM e),
m AS (SELECT d.*, source_size, target, whole + CASE WHEN h <= last_hash THEN 1 ELSE 0 END AS copies
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN l ON d.source IS NOT DISTINCT FROM l.source)
"""
