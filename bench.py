"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import QUERIES  # noqa: E402
from postings.session import build_session  # noqa: E402

HEADLINE = [
    "i01_severity_share", "i02_top_failing_domains", "i09_json_parse_failures", "i10_browser_errors", "i12_new_vs_recurring",
    "i15_healthy_domains", "i17_failing_completely", "i25_error_summary", "h01_conform_error_records",
    "b02_canonicalize_links", "b07_with_base_name", "f01_parse_posted_date", "e07_dedupe_jobs", "e08_dedupe_stats",
    "e10a_finalize_job_urls", "g02a_validate_jobs", "g08a_upsert_jobs", "k02_infer_category", "d04_decode_json_robust",
    "g05b_records_from_responses", "c02_ordered_job_links", "c05_results_fingerprint", "c10a_reduce_focus",
    "c06_capture_progress", "c07a_replay_expansion", "j03_stream_hourly_timeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("postings-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), "spark.log.level": "ERROR",
    })
    chosen = sys.argv[1:] or HEADLINE
    # Start the executors, the code generator and the Python workers before the clock runs.
    QUERIES["i20_table_stats"](spark, sf_dir).collect()
    QUERIES["c03_job_list_len"](spark, sf_dir).limit(1).collect()
    times = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
