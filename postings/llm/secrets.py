"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by its SHA-256. A ledger holds, per blob and rule version, the spans
found; a scan takes from the versions at hand the distinct blobs, drops the (blob, rule version) pairs the
ledger has, runs the remaining rules once per blob and appends to the ledger. Findings are then joined back to all paths
that carry the blob. Copies are scanned once and a new rule version rescans with that rule alone.

Null texts are empty texts. Offsets are code points, ends exclusive. The regular expressions work in time
linear in the text. Repeated rows give repeated rows; null ids are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.llm.common import stored
from postings.session import scratch_dir
from postings.sources.tables import path_exists


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (leftmost, not overlapping) for which ``least`` characters of ``group`` are there."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base patterns.
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.ASCII | re.IGNORECASE),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
# Published shapes of credentials.
ADDED = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("web_token", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),  # not from within a run: linear
    Rule("chat_token", 1, r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("code_token", 1, r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("url_password", 1, r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s:/@]{1,100}@"),
)
RULES = BASE + ADDED

_SPANS = "array<struct<kind:string,start:bigint,stop:bigint>>"


def scanner(rules: Sequence[Rule]) -> Callable[[str, set[str]], dict[str, list]]:
    """Function of a text and the keys of rules already applied to it: spans by key of the rules that remain."""
    ready = [(r, re.compile(r.pattern, r.flags)) for r in rules]

    def scan(text: str, seen: set[str]) -> dict[str, list]:
        return {
            r.key: [(r.kind, *m.span()) for m in p.finditer(text) if len(m[r.group]) >= r.least]
            for r, p in ready if r.key not in seen
        }

    return scan


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """blob, rule (``kind@version``), spans; empty before the first scan."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], f"blob string, rule string, spans {_SPANS}")
    return spark.read.parquet(root)


def update_ledger(versions: DataFrame, root: str, rules: Sequence[Rule] = RULES) -> None:
    """Scan what the ledger under ``root`` lacks. ``versions``: blob, text.

    Blobs are reduced to one text each on the map side; the shuffle that brings copies together
    also meets the ledger. A rerun after a failure scans only what was not yet recorded.
    """
    spark = versions.sparkSession
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    if path_exists(spark, root):
        keys = [r.key for r in rules]
        seen = read_ledger(spark, root).filter(F.col("rule").isin(keys)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        blobs = blobs.join(seen, "blob", "left").filter(F.coalesce(F.size("seen"), F.lit(0)) < len(keys))
    else:
        blobs = blobs.withColumn("seen", F.lit(None).cast("array<string>"))
    scan = scanner(rules)

    def run(batches):
        for batch in batches:
            out = []
            for blob, text, seen in zip(*(batch.column(i) for i in range(3))):
                for rule, spans in scan(text.as_py() or "", set(seen.as_py() or ())).items():
                    out.append((blob.as_py(), rule, [{"kind": k, "start": a, "stop": b} for k, a, b in spans]))
            if out:
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out]), pa.array([r[1] for r in out]), pa.array([r[2] for r in out], kind)], ["blob", "rule", "spans"])

    found = blobs.select("blob", "text", "seen").mapInArrow(run, f"blob string, rule string, spans {_SPANS}")
    found.write.mode("append").parquet(root)


def findings(paths: DataFrame, root: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds ``spans`` of the given rules, by start, then in the order of the rules, to every row with a ``blob``."""
    place = {r.key: i for i, r in enumerate(rules)}
    rank = F.create_map(*[x for k, i in place.items() for x in (F.lit(k), F.lit(i))])
    rows = read_ledger(paths.sparkSession, root).filter(F.col("rule").isin(list(place)) & (F.size("spans") > 0))
    listed = rows.dropDuplicates(["blob", "rule"]).withColumn("rank", rank[F.col("rule")]).select(
        "blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank").alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))).alias("s"))
    merged = listed.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("s"))).alias("s"))  # one list per rule at most
    spans = F.transform("s", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))
    joined = paths.join(merged.select("blob", spans.alias("spans")), "blob", "left")
    return joined.withColumn("spans", F.coalesce("spans", F.array().cast(_SPANS)))


def scan_secrets(
    docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Per row: doc_id, blob and ``spans`` (kind, start, stop). ``ledger``: its folder; a new one if None."""
    root = ledger or scratch_dir(docs.sparkSession, "ledger")
    versions = docs.select(blob_id(F.col(text_col)).alias("blob"), F.col(text_col).alias("text"))
    update_ledger(versions, root, rules)
    paths = docs.select(F.col(id_col).alias("doc_id"), blob_id(F.col(text_col)).alias("blob"))
    return findings(paths, root, rules)


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts and digests per row of ``scan_secrets``."""
    kinds = [r.kind for r in BASE]
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in kinds], F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, ledger: str | None = None, text_col: str = "text", mask: str = "[secret]", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows with every found span replaced by ``mask``; a span that overlaps the one before adds to it.

    Other columns stay, whatever their names: the rows travel as one struct beside the key.
    """
    root = ledger or scratch_dir(docs.sparkSession, "ledger")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), blob_id(F.col(text_col)).alias("blob"))
    update_ledger(docs.select(blob_id(F.col(text_col)).alias("blob"), F.col(text_col).alias("text")), root, rules)
    spans = findings(keyed.select("blob").distinct(), root, rules).filter(F.size("spans") > 0)
    text = F.col("row")[text_col]
    cut = F.aggregate(
        F.col("spans"),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["stop"]).alias("at"),
            F.when((s["start"] >= a["at"]), F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask))).otherwise(a["out"]).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))),
    )
    joined = keyed.join(spans, "blob", "left")
    clean = F.when(F.col("spans").isNull(), text).otherwise(cut)
    return joined.select(*[clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
