"""The jobs table in hash buckets of ``job_url``: a batch is appended, large piles of batches are merged bucket by bucket.

    root/data/seq=<n>/commit=<id>/bucket=<b>/   rows of one commit
    root/manifest/v=<n>~<tag>/                  bucket, seq, commit, base: what a version of the table consists of

An upsert writes the rows of its batch, and nothing else, whatever the table holds. Readers merge by ``job_url`` only in
buckets that hold more than one commit; the others are read as they are. A bucket with more than ``max_deltas`` commits is
merged into a new one; all other buckets keep their files. A version becomes visible with its manifest, whose name holds
the tag of its batch: a batch that runs again finds its tag and does nothing, and what a failed attempt wrote is
referenced by no manifest. The manifest has at most ``buckets * (max_deltas + 2)`` rows, and is all the driver reads.

One writer at a time; readers may go on reading while it writes. ``vacuum_jobs`` removes files that no kept version names.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.operators.upsert import dedupe_batch
from postings.schemas import JOBS
from postings.session import exchanges_leave
from postings.sources.tables import _hadoop, _snapshots, path_exists, snapshot_versions, write_snapshot

#: Buckets of a new table: a few thousand for a large one, since the driver lists them; a bucket may hold many files.
BUCKETS, MAX_DELTAS = 64, 8
_ENTRY = "bucket int, seq int, commit string, base boolean, buckets int"
_PLACE = T.StructType([T.StructField("seq", T.IntegerType()), T.StructField("commit", T.StringType()), T.StructField("bucket", T.IntegerType())])


def _entries(spark: SparkSession, root: str, version: int | None = None) -> list[tuple]:
    """What the newest version (or the given one) consists of: (bucket, seq, commit, base, buckets)."""
    folders = {v: path for v, _, path in _snapshots(spark, f"{root}/manifest")}
    if not folders or (version is not None and version not in folders):
        if version is not None:
            raise ValueError(f"no version {version} of {root}")
        return []
    rows = spark.read.schema(_ENTRY).parquet(folders[max(folders) if version is None else version]).collect()
    return sorted(map(tuple, rows))


def _folder(root: str, bucket: int, seq: int, commit: str) -> str:
    return f"{root}/data/seq={seq}/commit={commit}/bucket={bucket}"


def _rows(spark: SparkSession, root: str, entries: list[tuple]) -> DataFrame:
    """Rows of some entries with their ``seq`` and ``bucket``."""
    schema = T.StructType([*JOBS.fields, *_PLACE.fields])
    folders = [_folder(root, *e[:3]) for e in entries if e[2]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*folders)


def merge_versions(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per ``job_url`` from rows of several commits (``seq``): per column the last value that is there, and
    the ``first_seen_at`` of the first row, also if that is NULL."""
    def last(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)

    columns = [c for c in JOBS.fieldNames() if c not in ("job_url", "first_seen_at")]
    first = F.min_by(F.struct("first_seen_at"), "seq")["first_seen_at"].alias("first_seen_at")
    # Brought together first, so that commits are sorted once, after the shuffle.
    rows = rows.repartition("job_url", *keep)
    return rows.groupBy("job_url", *keep).agg(first, *map(last, columns)).select(*JOBS.fieldNames(), *keep)


def _piled(entries: list[tuple]) -> dict[int, list[tuple]]:
    found: dict[int, list[tuple]] = {}
    for e in entries:
        found.setdefault(e[0], []).append(e)
    return found


def read_jobs(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table in its newest version, or in an older one that is still kept; empty when there is none."""
    piles = _piled(_entries(spark, root, version)).values()
    whole = _rows(spark, root, [p[0] for p in piles if len(p) == 1]).select(*JOBS.fieldNames())
    mixed = [e for p in piles if len(p) > 1 for e in p]
    return whole.unionAll(merge_versions(_rows(spark, root, mixed))) if mixed else whole


def _write(rows: DataFrame, root: str, seq: int) -> tuple[str, list[int]]:
    """Write rows with a ``bucket``; the commit's id and the buckets it has rows in."""
    spark, commit = rows.sparkSession, uuid.uuid4().hex
    placed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in JOBS.fields], "bucket")
    path = f"{root}/data/seq={seq}/commit={commit}"
    with exchanges_leave(spark):  # else those of all commits lie there at once
        placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    target, fs = _hadoop(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return commit, sorted(int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket="))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("job_url"), F.lit(buckets)).cast("int")


def _publish(spark: SparkSession, root: str, entries: list[tuple], tag: str, keep: int | None) -> bool:
    return write_snapshot(spark.createDataFrame(entries, _ENTRY).coalesce(1), f"{root}/manifest", tag=tag, keep=keep)


def _done(spark: SparkSession, root: str, tag: str) -> bool:
    return bool(tag) and tag in [t for _, t, _ in _snapshots(spark, f"{root}/manifest")]


def _next(entries: list[tuple]) -> int:
    return max((e[1] for e in entries), default=0) + 1


def replace_jobs(jobs: DataFrame, root: str, tag: str = "", buckets: int = BUCKETS, keep: int | None = None) -> bool:
    """Make ``jobs`` (each ``job_url`` once) the whole content of the table, in so many buckets."""
    spark = jobs.sparkSession
    if _done(spark, root, tag):
        return False
    seq = _next(_entries(spark, root))
    commit, filled = _write(jobs.withColumn("bucket", _bucket(buckets)), root, seq)
    entries = [(b, seq, commit, True, buckets) for b in filled]
    return _publish(spark, root, entries or [(0, seq, "", True, buckets)], tag, keep)


def append_jobs(
    batch: DataFrame, root: str, now: dt.datetime, tag: str = "", buckets: int = BUCKETS, max_deltas: int = MAX_DELTAS, keep: int | None = None,
) -> bool:
    """Upsert a batch of job records as the next version; False when a batch of the same ``tag`` is in already.

    New postings get ``now`` as first and last seen, known ones keep their first time, absent values erase nothing
    (as :func:`postings.operators.upsert.upsert_jobs`). ``buckets`` counts for a new table only.
    """
    spark = batch.sparkSession
    if _done(spark, root, tag):
        return False
    entries = _entries(spark, root)
    buckets, seq = entries[0][4] if entries else buckets, _next(entries)
    stamp = F.lit(now).cast("timestamp")
    rows = dedupe_batch(batch).withColumns({"first_seen_at": stamp, "last_seen_at": stamp, "bucket": _bucket(buckets)})
    commit, filled = _write(rows, root, seq)
    fresh = {e[0] for e in entries}
    entries = entries + [(b, seq, commit, b not in fresh, buckets) for b in filled]
    return _publish(spark, root, _compacted(spark, root, entries, max_deltas) or [(0, seq, "", True, buckets)], tag, keep)


def _compacted(spark: SparkSession, root: str, entries: list[tuple], max_deltas: int) -> list[tuple]:
    """The entries once buckets with more than ``max_deltas`` commits beside the first are merged; the rest as they are."""
    entries = [e for e in entries if e[2]]
    piles = {b: p for b, p in _piled(entries).items() if len(p) - 1 > max_deltas}
    if not piles:
        return entries
    mixed = [e for p in piles.values() for e in p]
    seq = _next(entries)
    commit, filled = _write(merge_versions(_rows(spark, root, mixed), "bucket"), root, seq)
    return [e for e in entries if e[0] not in piles] + [(b, seq, commit, True, mixed[0][4]) for b in filled]


def compact_jobs(spark: SparkSession, root: str, max_deltas: int = 0, keep: int | None = None) -> bool:
    """Merge the buckets with more than ``max_deltas`` commits beside the first; False if there is none."""
    entries = _entries(spark, root)
    merged = _compacted(spark, root, entries, max_deltas)
    return merged != [e for e in entries if e[2]] and _publish(spark, root, merged, "", keep)


def job_files(spark: SparkSession, root: str, version: int | None = None) -> dict[int, list[str]]:
    """Folders of each bucket, oldest commit first."""
    return {b: [_folder(root, *e[:3]) for e in pile if e[2]] for b, pile in _piled(_entries(spark, root, version)).items()}


def vacuum_jobs(spark: SparkSession, root: str) -> int:
    """Delete bucket folders that no kept version names; how many. Not while a writer is at work."""
    named = {path for v in snapshot_versions(spark, f"{root}/manifest") for paths in job_files(spark, root, v).values() for path in paths}
    gone = 0
    if not path_exists(spark, f"{root}/data"):
        return gone
    for seq in _children(spark, f"{root}/data", "seq="):
        for commit in _children(spark, seq, "commit="):
            folders = _children(spark, commit, "bucket=")
            stale = [f for f in folders if f not in named]
            for folder in [commit] if len(stale) == len(folders) else stale:
                target, fs = _hadoop(spark, folder)
                fs.delete(target, True)
            gone += len(stale)
    return gone


def _children(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    target, fs = _hadoop(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return [f"{folder}/{n}" for n in names if n.startswith(prefix)]
