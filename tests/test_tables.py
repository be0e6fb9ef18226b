from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES
from postings.functions import text as X
from postings.operators.extraction import results_of, with_decoded_json
from postings.operators import logs as H
from postings.operators import normalize as N
from postings.operators import pages as P
from postings.operators import upsert as G
from postings.plans import dashboard as D
from postings.plans import monitoring as M
from postings.plans.load import jobs_from_responses, records_from_jobs
from postings.schemas import ERROR_LOGS, JOBS
from postings.session import scratch_dir
from postings.sources import captures as C
from postings.sources import seeds as S
from postings.sources import tables as T
from postings.sources.job_table import read_jobs
from postings.streaming import jobs as SJ
from postings.streaming import logs as SL

NOW = dt.datetime(2026, 1, 8, 12)
SMALL = "/root/testdata/sf0.001"


def postings(spark, *rows):
    schema = "page int, pos int, job_url string, title string, company string, seniority_bucket string, extra map<string,string>, score int"
    df = spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], schema)
    return df.withColumns({
        "domain": F.lit("e.com"), "source_url": F.lit("https://e.com/l"), "page_title": F.lit("Jobs"),
        "country": F.lit(None).cast("string"), "seniority_level": F.lit(None).cast("string"),
    })


def records(spark, *rows):
    return G.dedupe_batch(records_from_jobs(postings(spark, *rows), NOW)[0])


def test_validation(spark):
    jobs = postings(spark, (" https://e.com/1 ", " A ", None, "bogus", None, 1), ("", "B", None, None, None, 1), (None, None, None, None, None, 1), ("u", "  ", None, None, None, 1))
    valid, bad = G.validate_jobs(jobs)
    assert [(r.job_url, r.title) for r in valid.collect()] == [("https://e.com/1", "A")]
    assert [r.reasons for r in bad.orderBy("pos").collect()] == [["job_url"], ["job_url", "title"], ["title"]]
    row = G.rejected_to_errors(bad).orderBy("message").first()
    assert (row.stage, row.severity, json.loads(row.metadata)["page_title"]) == ("validate_job", "warning", "Jobs")
    typed = jobs.withColumn("type_errors", F.array(F.lit("company")))
    assert G.validate_jobs(typed)[0].count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_deduplication_sorts_after_the_shuffle_only(spark):
    """No aggregation of whole rows in the task that reads the input, and only the columns that are asked for travel."""
    jobs = postings(spark, ("u", "A", None, None, None, 1), ("u", "B", "C", None, None, 2), ("u", "D", "E", None, None, 2), ("v", "F", None, None, None, 1))
    kept = N.dedupe_jobs(jobs.withColumnRenamed("job_url", "sig"))
    assert sorted((r.sig, r.title, r.pos, r.copies) for r in kept.collect()) == [("u", "B", 0, 3), ("v", "F", 3, 1)]
    assert "SortAggregate" not in plan_of(kept) and plan_of(kept).count("Sort [") == 1
    assert "page_title" not in plan_of(kept.select("sig", "pos"))
    batch = records_from_jobs(jobs, NOW)[0]
    assert "SortAggregate" not in plan_of(G.dedupe_batch(batch)) and plan_of(G.dedupe_batch(batch)).count("Sort [") == 1
    assert sorted((r.job_url, r.title) for r in G.dedupe_batch(batch).collect()) == [("u", "B"), ("v", "F")]


def test_large_days_of_a_log_are_written_in_slices(spark, monkeypatch):
    monkeypatch.setattr(T, "LOG_BYTES", 100_000)
    rows = spark.range(200).select(*[(F.lit(NOW).cast("timestamp") if f.name == "created_at" else F.repeat(F.lit("frame "), 1000) if f.name == "stack_trace"
                                      else F.concat(F.lit("m"), F.col("id").cast("string")) if f.name == "message" else F.lit(None)).cast(f.dataType).alias(f.name) for f in ERROR_LOGS.fields])
    path = scratch_dir(spark, "sliced-log")
    T.write_log(rows, path, ERROR_LOGS, "b")
    stored = T.read_error_logs(spark, path)
    assert (stored.count(), stored.select("message").distinct().count()) == (200, 200)
    assert stored.select(F.input_file_name()).distinct().count() >= 4


def test_strict_pages(spark):
    jobs = postings(spark, ("u1", "A", None, None, None, 1), ("", "B", None, None, None, 1), ("", "C", None, None, None, 1)).unionByName(
        postings(spark, ("u1", "A", None, None, None, 1)).withColumn("page", F.lit(2)))
    ok, failed = G.validate_page_strict(jobs)
    assert [r.page for r in ok.collect()] == [2]
    assert [tuple(r) for r in failed.collect()] == [(1, 1)]


def test_pages(spark):
    rows = [("https://e.com ", "T", '[{"a":1}]'), ("u", "T", "[]"), ("u", "T", '[{"a":1}, 5]'), ("u", None, "[]"), ("u", "T", "{}")]
    df = spark.createDataFrame(rows, "source_url string, page_title string, j string").select("source_url", "page_title", F.lit("e.com").alias("domain"), F.parse_json("j").alias("jobs"))
    valid, errors = G.validate_pages(df)
    assert [r.source_url for r in valid.select("source_url").collect()] == ["https://e.com", "u"]
    assert sorted(r.message for r in errors.collect()) == ["invalid page: jobs", "invalid page: jobs", "invalid page: page_title"]


def test_records(spark):
    row = records(spark, ("https://e.com/1", "A", "Acme", "bogus", {"apply_url": "/a", "x": "y"}, 1)).first()
    assert (row.country, row.seniority_level, row.seniority_bucket, row.apply_url) == ("Unknown", "Unknown", "unknown", "/a")
    assert (row.source_domain, row.source_page_url, row.source_page_title, row.last_seen_at, row.first_seen_at) == ("e.com", "https://e.com/l", "Jobs", NOW, None)
    raw = json.loads(row.raw_job)
    assert raw["title"] == "A" and "location" not in raw and raw["extra"] == {"apply_url": "/a", "x": "y"}
    assert json.loads(row.raw_extra) == {"apply_url": "/a", "x": "y"}


def test_batch_keeps_the_richest_per_url(spark):
    batch = records(spark, ("u", "poor", None, None, None, 1), ("u", "rich", "Acme", None, None, 5), ("u", "later", "Acme", None, None, 5))
    assert [r.title for r in batch.collect()] == ["rich"]


def test_upsert(spark):
    day1, day2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 5)
    empty = spark.createDataFrame([], JOBS)
    first = G.upsert_jobs(empty, records(spark, ("a", "A", "Acme", None, None, 1), ("b", "B", None, None, None, 1)), day1)
    stored = first.withColumn("first_seen_at", F.when(F.col("job_url") == "b", None).otherwise(F.col("first_seen_at")))
    stored = spark.createDataFrame(stored.collect(), JOBS)
    batch = records(spark, ("a", "A2", None, None, None, 1), ("b", "B", None, None, None, 1), ("c", "C", None, None, None, 1))
    got = {r.job_url: r for r in G.upsert_jobs(stored, batch, day2).collect()}
    assert (got["a"].title, got["a"].company, got["a"].first_seen_at, got["a"].last_seen_at) == ("A2", "Acme", day1, day2)
    assert (got["b"].first_seen_at, got["b"].last_seen_at) == (None, day2)
    assert got["c"].first_seen_at == day2
    # again: nothing moves
    again = G.upsert_jobs(spark.createDataFrame(list(got.values()), JOBS), batch, day2)
    assert sorted(again.collect()) == sorted(got.values())
    untouched = G.upsert_jobs(stored, records(spark, ("c", "C", None, None, None, 1)), day2).filter("job_url = 'a'").first()
    assert (untouched.title, untouched.last_seen_at) == ("A", day1)


def test_summary_steps(spark):
    saved, rejected = records_from_jobs(postings(spark, ("a", "A", None, None, None, 1), ("", "B", None, None, None, 1)), NOW)
    summary = G.upsert_summary(saved, rejected, spark.createDataFrame([("e.com", 2)], "domain string, skipped bigint"))
    assert tuple(summary.first()) == ("e.com", 1, 3, 1)
    step = G.summary_steps(summary, "run", NOW).first()
    assert (step.step, step.company, json.loads(step.metadata)["jobs_saved"]) == ("db_complete", "E", 1)


def test_error_classes(spark):
    cases = {("ValidationError", "x"): "validation_error", ("X", "read TIMEOUT"): "timeout", ("ConnectionError", ""): "connection_error",
             ("X", "status 429"): "http_error", ("X", "429"): "rate_limit", ("JSONDecodeError", ""): "json_error", ("ParseError", ""): "parse_error",
             ("SQLError", ""): "db_query_error", ("BrowserClosed", ""): "browser_error", ("X", "bad selector"): "element_not_found",
             ("MyException", ""): "file_error", ("KeyError", ""): "unknown", (None, None): "unknown"}
    df = H.classify_errors(spark.createDataFrame(list(cases), "n string, m string"), "n", "m")
    assert {(r.n, r.m): r.error_type for r in df.collect()} == cases


def test_stack_traces(spark):
    rows = [("critical", "a.ValueError", "t"), ("warning", "X", "t"), ("error", "a.KeyError", "t"), ("error", "a.Odd", "x" * 10001), ("error", None, "t")]
    out = H.trim_stack_traces(spark.createDataFrame(rows, "severity string, exception_type string, stack_trace string")).collect()
    assert [r.stack_trace for r in out] == ["t", None, None, "x" * 10000 + "\n... (truncated)", "t"]


def test_process_records(spark):
    rows = [(" r ", "llm_start", None, "E.COM", NOW, NOW + dt.timedelta(seconds=1, microseconds=500), None, None, {"a": "b"}),
            ("r", "odd", "", "", NOW, None, None, "success", None), ("r", "llm_start", "c", "d", NOW, NOW - dt.timedelta(seconds=1), None, None, None)]
    df = spark.createDataFrame(rows, "run_id string, step string, company string, domain string, started_at timestamp, completed_at timestamp, "
                               "duration_seconds double, status string, metadata map<string,string>").withColumn("created_at", F.col("started_at"))
    valid, bad = H.conform_process_records(df)
    row = valid.first()
    assert (row.run_id, row.company, row.domain, row.duration_seconds, row.status, row.metadata) == ("r", "Unknown", "e.com", 1.001, "success", '{"a":"b"}')
    assert [r.reasons for r in bad.collect()] == [["step"], ["duration_seconds"]]


def test_seed_files(spark):
    root = scratch_dir(spark, "seeds")
    lines = [f"https://e{i % 700}.com/{i % 900}" for i in range(5000)]
    text = "# comment\n\n" + "\n".join(f"  {u} " for u in lines) + "\n  # end\n"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(root)
    # Splits of a few kilobytes, so that the file is read by many tasks.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        seeds = S.read_seeds(spark, root)
        assert dict(seeds.dtypes)["pos"] == "bigint" and S.group_seeds_by_domain(seeds).count() >= 1
        got = [r.url for r in seeds.orderBy("pos").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == list(dict.fromkeys(lines))


def test_captures_and_sidecars(spark):
    root = scratch_dir(spark, "out")
    fs_path, fs = T._hadoop(spark, root)

    def put(path, text):
        stream = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{path}"))
        stream.write(bytearray(text, "utf-8"))
        stream.close()

    put("e.com/reduced_focus/a__1.p001.html", "<p>a\nb</p>")
    assert [(r.url, r.title) for r in C.scan_captures(spark, root).collect()] == [("", "")]
    put("e.com/reduced_focus/b__2.p001.html", "<p>b</p>")
    put("f.com/reduced_focus/a__1.p001.html", "<p>f</p>")
    put("e.com/meta/a__1.p001.json", '{"url": "", "source_url": "https://e.com/a",\n "title": "", "reduce_meta": {"title": "T"}}')
    put("e.com/meta/b__2.p001.json", '{"url": "https://e.com/b", "title": "B"}')
    rows = sorted((r.domain, r.stem, r.html, r.url, r.title) for r in C.scan_captures(spark, root).collect())
    assert rows == [("e.com", "a__1.p001", "<p>a\nb</p>", "https://e.com/a", "T"), ("e.com", "b__2.p001", "<p>b</p>", "https://e.com/b", "B"),
                    ("f.com", "a__1.p001", "<p>f</p>", "", "")]


def test_page_documents(spark):
    root = scratch_dir(spark, "docs")
    pages = spark.createDataFrame([(1, "e.com", "T"), (2, "e.com", "U")], "page int, domain string, page_title string")
    jobs = spark.createDataFrame([(1, 1, "B"), (1, 0, "A")], "page int, pos int, title string")
    C.write_page_json(C.page_documents(jobs, pages), root)
    docs = spark.read.schema("page int, jobs array<struct<title:string>>").json(root).orderBy("page").collect()
    assert [[j.title for j in d.jobs] for d in docs] == [["A", "B"], []]


def test_skip_processed(spark):
    pages = spark.createDataFrame([("d", "a"), ("d", "b")], "domain string, base string")
    done = pages.filter("base = 'a'")
    assert C.skip_processed(pages, done).count() == 1
    assert C.skip_processed(pages, done, overwrite=True).count() == 2


def test_check_schema(spark):
    rows = T.check_schema(spark.createDataFrame([], JOBS), ["job_url", "last_seen_at", "salary"]).collect()
    assert [(r.column, r.data_type, r.missing) for r in rows] == [("job_url", "string", False), ("last_seen_at", "timestamp", False), ("salary", None, True)]


def test_snapshots(spark):
    root = scratch_dir(spark, "snap")
    rows = lambda n: spark.range(n).toDF("n")
    assert T.read_snapshot(spark, root, rows(1).schema).count() == 0
    assert T.write_snapshot(rows(3), root, 0) and not T.write_snapshot(rows(9), root, 0)
    # a version without its marker was never finished
    rows(5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v=1")
    assert T.read_snapshot(spark, root, rows(1).schema).count() == 3
    assert T.write_snapshot(rows(4), root, 1)
    assert (T.read_snapshot(spark, root, rows(1).schema).count(), T.read_snapshot(spark, root, rows(1).schema, before=1).count()) == (4, 3)


def test_snapshot_tags_and_retention(spark):
    root = scratch_dir(spark, "snap")
    rows = lambda n: spark.range(n).toDF("n")
    assert T.write_snapshot(rows(1), root, tag="a-0") and not T.write_snapshot(rows(9), root, tag="a-0")
    assert T.write_snapshot(rows(2), root, tag="b-0") and T.write_snapshot(rows(3), root)
    assert T.snapshot_versions(spark, root) == [0, 1, 2]
    assert T.write_snapshot(rows(4), root, tag="b-1", keep=2)
    assert T.snapshot_versions(spark, root) == [2, 3] and T.read_snapshot(spark, root, rows(1).schema).count() == 4


def _stream_of(spark, rows, folder):
    rows.coalesce(1).write.mode("append").json(folder)
    return spark.readStream.schema(rows.schema).json(folder)


def test_upsert_streams_lose_nothing(spark):
    root, now = scratch_dir(spark, "upsert"), [dt.datetime(2024, 1, 1)]
    blank = {f.name: F.lit(None).cast(f.dataType) for f in JOBS.fields}

    def record(url):
        given = blank | {"job_url": F.lit(url), "title": F.lit("t"), "country": F.lit("Unknown"), "source_domain": F.lit("d"), "raw_job": F.lit("{}")}
        return spark.range(1).select(*[c.alias(n) for n, c in given.items()])

    for k, url in enumerate(["https://d/1", "https://d/2"]):  # two streams, each with a checkpoint of its own
        source = _stream_of(spark, record(url), f"{root}/in{k}")
        SJ.stream_upsert(source, f"{root}/jobs", f"{root}/cp{k}", lambda: now[0]).awaitTermination()
        now[0] += dt.timedelta(days=1)
    rows = {r.job_url: r.last_seen_at for r in read_jobs(spark, f"{root}/jobs").collect()}
    assert rows == {"https://d/1": dt.datetime(2024, 1, 1), "https://d/2": dt.datetime(2024, 1, 2)}


def test_error_stream_shares_the_layout_and_prunes(spark):
    root = scratch_dir(spark, "ingest")
    base = {f.name: F.lit("x").cast(f.dataType) for f in ERROR_LOGS.fields}
    base |= {"component": F.lit("llm"), "stage": F.lit("parse"), "error_type": F.lit("timeout"), "severity": F.lit("error"), "url": F.lit("https://d/"), "metadata": F.lit("{}")}
    rows = spark.range(4).select(*[c.alias(n) for n, c in base.items() if n != "created_at"], F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, CAST(id AS INT))").alias("created_at"))
    T.append_error_logs(rows, f"{root}/log")
    lines = rows.withColumns({"metadata": F.parse_json("metadata"), "created_at": F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss")})
    for k in range(2):
        lines.coalesce(1).write.mode("append").json(f"{root}/in{k}")
        SL.stream_error_logs(SL.read_error_stream(spark, f"{root}/in{k}"), f"{root}/log", f"{root}/cp{k}").awaitTermination()
    logs = T.read_error_logs(spark, f"{root}/log")
    assert logs.count() == 12
    late = M.since(logs, dt.datetime(2024, 1, 5), days=2)
    assert late.count() == 3 and "day" in plan(late).split("PartitionFilters: [")[1].split("]")[0]


def test_lines_of_a_batch_are_read_once(spark):
    """Sizes, rows and rejects of a batch begin at one shuffle, whatever few files its lines come from."""
    root, seen = scratch_dir(spark, "dealt"), spark.sparkContext.accumulator(0)
    lines = [dict(component="llm" if k % 5 else "?", stage="parse", error_type="timeout", domain="d", message=f"m{k}", severity="error", metadata={"k": k},
                  stack_trace=f" at {k}\n" + "x " * 100 + "\n", created_at=f"2024-01-0{1 + k % 2}T00:00:00") for k in range(40)]
    spark.createDataFrame([(json.dumps(x),) for x in lines], "value string").coalesce(1).write.option("compression", "gzip").text(f"{root}/in")

    def note(domain):
        seen.add(1)
        return domain

    noted = SL.read_error_stream(spark, f"{root}/in").withColumn("domain", F.udf(note, "string")("domain"))
    SL.stream_error_logs(noted, f"{root}/log", f"{root}/cp").awaitTermination()
    assert seen.value == 40
    kept = {r.message: r.stack_trace for r in spark.read.parquet(f"{root}/log").collect()}
    assert kept == {f"m{k}": f"at {k}\n" + "x " * 99 + "x" for k in range(40) if k % 5}
    assert spark.read.parquet(f"{root}/log_rejected").count() == 8


def test_long_texts_are_trimmed_like_short_ones(spark):
    texts = [a + m * n + a for a in ("", " ", "\n" * 70, "\u3000\u2003" * 25, "\x85 ") for m in ("", "x", "é €", "😀\n", "\u2000\u0080") for n in (1, 7, 21, 64, 500)]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    assert rows.filter(~X.strip(F.col("t")).cast("binary").eqNullSafe(X.strip_long(F.col("t")).cast("binary"))).count() == 0


def test_extraction_asks_once(spark):
    root = scratch_dir(spark, "ask")

    def call(text):
        import uuid

        open(f"{root.removeprefix('file:')}-{uuid.uuid4().hex}", "w").close()
        if "Repair" in text:
            return '{"jobs": [{"title": "T", "job_url": "/j"}]}'
        if "FAIL" in text:
            raise RuntimeError("no quota")
        return "sorry, no" if "ODD" in text else '{"jobs": []}'

    rows = [("1", "d", "https://d/1", "t", "fine"), ("2", "d", "https://d/2", "t", "ODD"), ("2", "d", "https://d/2", "t", "ODD"), ("3", "d", "https://d/3", "t", "FAIL")]
    pages = spark.createDataFrame(rows, "page string, domain string, url string, title string, html string")
    for _ in range(2):  # the second time everything is there
        answers = SJ.ask_model(pages, call, "Extract.", root, max_retries=0).cache()
        assert answers.count() == 4
    import glob

    assert len(glob.glob(f"{root.removeprefix('file:')}-*")) == 6
    jobs, errors = jobs_from_responses(answers)
    assert jobs.count() == 1 and errors.count() == 0  # both rows of page 2 hold the same posting
    page = {r.page: r.error for r in results_of(with_decoded_json(answers)).collect()}
    assert page["3"] == "no quota" and page["1"] is None
    answers.unpersist()


def test_empty_logs(spark):
    logs = spark.createDataFrame([], ERROR_LOGS)
    assert D.error_summary(logs).count() == 0
    assert D.domain_detail(logs, "x").count() == 0
    assert M.severity_share(logs, NOW).count() == 0
    assert T.read_error_logs(spark, "/nowhere/at/all", None).count() == 0


def plan(df):
    return df._jdf.queryExecution().toString()


def test_plans_stay_native(spark):
    python_nodes = {"c", "d0"}
    for name, query in QUERIES.items():
        if name[0] in "ij" or name.startswith(("c0", "c1", "d02", "d05", "a", "g08c")) or name in python_nodes:
            continue
        text = plan(query(spark, SMALL))
        assert "Python" not in text and "CartesianProduct" not in text, name


def test_time_filters_reach_the_scan(spark):
    text = plan(QUERIES["i02_top_failing_domains"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-24T00:00)]" in text
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]


def test_page_operators_do_not_shuffle(spark):
    parsed = P.html_nodes(spark.read.parquet(f"{SMALL}/pages.parquet"))
    for df in (P.ordered_job_links(parsed), P.results_fingerprint(parsed), P.reduce_focus(parsed), P.detect_pagination_controls(parsed)):
        assert "Exchange" not in plan(df)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES and n[0] in "hij"])
def test_reports_match_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == ""
