"""The bucketed jobs table against the plain upsert, and which files a batch touches."""

from __future__ import annotations

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from postings.operators.upsert import dedupe_batch, upsert_jobs
from postings.schemas import JOBS
from postings.session import scratch_dir
from postings.sources import job_table as J

DAY = dt.datetime(2024, 1, 1)


def records(spark, rows):
    """Job records from (url, title, company, first_seen_at)."""
    base = spark.createDataFrame(rows, "job_url string, title string, company string, first_seen_at timestamp")
    given = {f.name: F.lit(None).cast(f.dataType) for f in JOBS.fields}
    given |= {c: F.col(c) for c in base.columns} | {"source_domain": F.lit("d"), "raw_job": F.concat(F.lit("{}"), F.coalesce("title", F.lit("")))}
    return base.select(*[c.alias(n) for n, c in given.items()])


def content(df):
    return sorted(map(tuple, df.select(*JOBS.fieldNames()).collect()), key=repr)


def files(folders):
    return {f: os.path.getmtime(f"{d}/{f}") for d in folders for f in os.listdir(d) if f.endswith(".parquet")}


@pytest.mark.parametrize("max_deltas", [0, 1, 8])
def test_many_batches_give_the_plain_upsert(spark, max_deltas):
    root, rnd = scratch_dir(spark, "job-table"), random.Random(max_deltas)
    plain = spark.createDataFrame([], JOBS)
    for k in range(4):
        rows = [(f"https://d/{rnd.randrange(40)}", rnd.choice([None, f"t{k}", f"T{rnd.randrange(9)}"]), rnd.choice([None, "c", f"c{k}"]), None) for _ in range(30)]
        batch, now = records(spark, rows).repartition(2), DAY + dt.timedelta(days=k)
        assert J.append_jobs(batch, root, now, tag=f"s-{k}", buckets=8, max_deltas=max_deltas)
        plain = spark.createDataFrame(upsert_jobs(plain, dedupe_batch(batch), now).collect(), JOBS)
        assert content(J.read_jobs(spark, root)) == content(plain)
    piles = [len(p) for p in J.job_files(spark, root).values()]
    assert max(piles) <= max_deltas + 1
    before = content(J.read_jobs(spark, root, 1))
    J.compact_jobs(spark, root)
    assert {len(p) for p in J.job_files(spark, root).values()} == {1} and not J.compact_jobs(spark, root)
    assert content(J.read_jobs(spark, root)) == content(plain) and content(J.read_jobs(spark, root, 1)) == before


def test_untouched_buckets_keep_their_files(spark):
    root = scratch_dir(spark, "job-table")
    old = records(spark, [(f"https://d/{i}", "t", None, None if i % 3 else DAY) for i in range(200)])
    assert J.replace_jobs(old, root, buckets=16)
    before = J.job_files(spark, root)
    stamps = {b: files(p) for b, p in before.items()}
    assert len(before) == 16 and all(len(p) == 1 for p in before.values())
    batch = records(spark, [("https://d/7", "new", "c", None), ("https://d/3", None, "c", None), ("https://d/new", "n", None, None)])
    assert J.append_jobs(batch, root, DAY + dt.timedelta(days=1), tag="s-0", max_deltas=0)
    after = J.job_files(spark, root)
    touched = {b for b in after if after[b] != before[b]}
    assert 1 <= len(touched) <= 3
    assert {b: files(after[b]) for b in after if b not in touched} == {b: s for b, s in stamps.items() if b not in touched}
    assert all(files(before[b]) == stamps[b] for b in touched)  # a reader of the version before goes on
    rows = {r.job_url: r for r in J.read_jobs(spark, root).collect()}
    assert len(rows) == 201 and rows["https://d/7"].first_seen_at is None  # unknown first time stays unknown
    assert (rows["https://d/3"].title, rows["https://d/3"].first_seen_at) == ("t", DAY)
    assert rows["https://d/new"].first_seen_at == DAY + dt.timedelta(days=1)


def test_a_batch_counts_once(spark):
    root = scratch_dir(spark, "job-table")
    batch = records(spark, [("https://d/1", "t", "c", None)])
    assert J.append_jobs(batch, root, DAY, tag="s-0")
    before, seen = J.job_files(spark, root), content(J.read_jobs(spark, root))
    folders = sorted(os.listdir(f"{root}/data"))
    assert not J.append_jobs(batch, root, DAY + dt.timedelta(days=9), tag="s-0")
    assert not J.replace_jobs(batch, root, tag="s-0")
    assert J.job_files(spark, root) == before and content(J.read_jobs(spark, root)) == seen
    assert sorted(os.listdir(f"{root}/data")) == folders


def test_failed_attempts_and_old_versions_are_swept(spark):
    root = scratch_dir(spark, "job-table")
    for k in range(4):
        J.append_jobs(records(spark, [(f"https://d/{i}", f"t{k}", None, None) for i in range(20)]), root, DAY, buckets=4, max_deltas=1, keep=2)
    J._write(records(spark, [("https://d/lost", "x", None, None)]).withColumn("bucket", F.lit(0)), root, 99)  # no manifest names it
    seen = content(J.read_jobs(spark, root))
    assert J.vacuum_jobs(spark, root) > 4 and J.vacuum_jobs(spark, root) == 0
    assert content(J.read_jobs(spark, root)) == seen and len(seen) == 20


def test_empty_tables_and_batches(spark):
    root = scratch_dir(spark, "job-table")
    none = records(spark, [("https://d/1", "t", None, None)]).limit(0)
    assert J.read_jobs(spark, root).count() == 0 and not J.compact_jobs(spark, root) and J.vacuum_jobs(spark, root) == 0
    assert J.append_jobs(none, root, DAY, tag="s-0", buckets=5) and J.read_jobs(spark, root).count() == 0
    assert not J.append_jobs(none, root, DAY, tag="s-0")
    assert J.append_jobs(records(spark, [(None, "t", None, None), ("https://d/2", "t", None, None)]), root, DAY, tag="s-1")
    assert sorted((r.job_url or "", r.title) for r in J.read_jobs(spark, root).collect()) == [("", "t"), ("https://d/2", "t")]
    with pytest.raises(ValueError, match="no version 9"):
        J.read_jobs(spark, root, 9)


def test_exchanges_of_a_commit_leave_the_disk(spark):
    """Neither a batch nor a merge of buckets leaves shuffle files behind."""
    root, folders = scratch_dir(spark, "job-table"), spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffled = lambda: {f for top in folders for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    before = shuffled()
    for k in range(3):
        J.append_jobs(records(spark, [(f"https://d/{i}", f"t{k}", None, None) for i in range(20)]), root, DAY, buckets=4, max_deltas=1)
    for _ in range(5):  # they go in the background
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert not left and J.read_jobs(spark, root).count() == 20
