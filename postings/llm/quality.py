"""Quality rules: one table of thresholds compiled into one projection.

Every measure is a column expression over the text of a row, so the rules neither shuffle nor leave
the JVM. Shared values (words, window hashes) are bound once per row. Nulls and empty texts have no
words and fail the base rule. A row is judged by itself: repeated rows get equal answers, and other
columns are passed through by ``filter_quality``.

Windows of words are compared by a 64-bit hash of their words' hashes; two different windows of one
text share a hash with a chance of about n² / 2⁶⁵, n being the windows of that text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.common import let, words_of

WINDOW = 8

# Common function words of English, French, German and Spanish.
STOP_WORDS = (
    "the be to of and that have with in a is it for on was as are this by an from at or "
    "de la le les et des en un une du que est dans pour "
    "der die das und ist von den zu mit sich auf ein im "
    "el los las y se por con para del no"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails when ``measure`` leaves [low, high]; an absent measure passes."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Ratios per text. Wide on purpose: each marks text that no prose comes near to.
RULES = (
    Rule("length", "n_words", low=20),
    Rule("repetition", "repeat_ratio", high=0.30),
    Rule("word_length_low", "mean_word_chars", low=3.0),
    Rule("word_length_high", "mean_word_chars", high=12.0),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("stop_words", "stop_word_ratio", low=0.01),
    Rule("duplicate_lines", "dup_line_ratio", high=0.60),
)


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """How many words lie in a window of ``size`` words (a power of two) that occurs twice or more."""
    def covered(hashes: Column) -> Column:
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(m: Column) -> Column:
            same = lambda k, h: F.coalesce(F.get(m, k)["h"] == h, F.lit(False))
            twins = F.filter(m, lambda x, k: same(k - 1, x["h"]) | same(k + 1, x["h"]))
            return F.sort_array(F.transform(twins, lambda x: x["i"]))

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size))))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

        return let(let(order, starts), total)

    def pairs(hashes: Column, step: int) -> Column:
        # Hash of twice as many words: each entry is joined with the one ``step`` further.
        n = F.size(hashes) - step
        return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(step + 1), n), lambda x, y: F.xxhash64(x, y))

    def grow(hashes: Column, step: int) -> Column:
        if step == size:
            return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered(hashes)).otherwise(none)
        return let(pairs(hashes, step), lambda h: grow(h, 2 * step))

    none = F.lit(0).cast("bigint")
    return F.when(F.size(words) > size, let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: grow(h, 1))).otherwise(none)


def measures(text: Column) -> Column:
    """Struct of counts of a text."""
    full = F.coalesce(text, F.lit(""))
    filled = F.filter(F.split(full, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    symbols = F.length(F.regexp_replace(full, r"[^#*$%&|<>]+", ""))
    n = lambda c: c.cast("bigint")
    return let(words_of(text), lambda w: let(filled, lambda lines: F.struct(
        n(F.size(w)).alias("n_words"), n(F.length(F.array_join(w, ""))).alias("word_chars"), n(symbols).alias("n_symbols"),
        n(F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS)))).alias("n_stop_words"), repeated_words(w).alias("n_repeat_words"),
        n(F.size(lines)).alias("n_lines"), n(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
    )))


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where no rule of the table fails; ``m``: the struct of ``measures``."""
    over = lambda a, b: a / F.nullif(b, F.lit(0))
    value = {
        "n_words": m["n_words"],
        "repeat_ratio": over(m["n_repeat_words"], m["n_words"]),
        "mean_word_chars": over(m["word_chars"], m["n_words"]),
        "symbols_per_word": over(m["n_symbols"], m["n_words"]),
        "stop_word_ratio": over(m["n_stop_words"], m["n_words"]),
        "dup_line_ratio": over(m["n_dup_lines"], m["n_lines"]),
    }
    kept = F.lit(True)
    for rule in rules:
        v = value[rule.measure]
        if rule.low is not None:
            kept = kept & F.coalesce(v >= rule.low, F.lit(True))
        if rule.high is not None:
            kept = kept & F.coalesce(v <= rule.high, F.lit(True))
    return kept


def base_failed(m: Column) -> Column:
    """Too short, or mostly repetition."""
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: id, counts, ``base_failed`` (too short, or mostly repetition) and ``kept``."""
    m = F.col("m")
    rows = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    counts = [m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select("doc_id", *counts, base_failed(m).alias("base_failed"), (~base_failed(m) & verdict(m, rules)).alias("kept"))


def filter_quality(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes the base rules and every rule of the table, with their own columns."""
    return docs.filter(let(measures(F.col(text_col)), lambda m: ~base_failed(m) & verdict(m, rules)))


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
_RULE_SQL = " AND ".join(
    f"coalesce({rule.measure} {op} {bound}, true)"
    for rule in RULES for op, bound in ((">=", rule.low), ("<=", rule.high)) if bound is not None
)

#: DuckDB: windows are compared as lists of words, not by hash.
ORACLE = rf"""
WITH a AS (SELECT *, row_number() OVER () AS rid, coalesce(text, '') AS full_text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {{docs}}),
g AS (SELECT rid, i, w[i:i+7] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM a)),
s AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1),
c AS (SELECT rid, CAST(sum(least(8, coalesce(nxt - i, 8))) AS BIGINT) AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM s) GROUP BY rid),
k AS (SELECT a.*, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(full_text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    list_filter(string_split(full_text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS filled,
    CAST(len(list_filter(w, lambda x: lower(x) IN ({_STOP_SQL}))) AS BIGINT) AS n_stop_words, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM a LEFT JOIN c USING (rid)),
q AS (SELECT *, CAST(len(filled) - len(list_distinct(filled)) AS BIGINT) AS n_dup_lines, n_repeat_words / nullif(n_words, 0) AS repeat_ratio,
    word_chars / nullif(n_words, 0) AS mean_word_chars, n_symbols / nullif(n_words, 0) AS symbols_per_word,
    n_stop_words / nullif(n_words, 0) AS stop_word_ratio FROM k),
p AS (SELECT *, n_dup_lines / nullif(len(filled), 0) AS dup_line_ratio FROM q),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {_RULE_SQL} AS passed FROM p)
"""
