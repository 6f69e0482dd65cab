"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
result transfer to the driver). A warm-up pass on the smallest scale factor
absorbs JVM start-up and first code generation, and one untimed pass at the
target scale reads table footers and warms the JIT on real sizes; then every
query runs ``$BENCH_REPEAT`` times (default 3) and its median is reported.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpusmill.plans.roundtrips  # noqa: E402, F401
from corpusmill.plans.catalog import QUERIES  # noqa: E402
from corpusmill.session import build_session  # noqa: E402

HEADLINE = [
    "writeup_flagship",
    "curation_summary",
    "select_preferred",
    "html_to_text",
    "redact_flags",
    "infer_category",
    "url_list",
    "extract_links",
    "fetch_log",
    "cache_upsert",
    "review_ledger",
    "normalize_text",
    "messages_normalize",
    "qa_to_messages",
    "dataset_summary",
    "redact_rules",
    "review_gate",
    "render_chat_text",
    "eval_report",
    "jsonl_lines",
    "writeup_job_rows",
    "read_quarantine",
    "body_store",
]


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app="corpusmill-bench", shuffle_partitions=max(cpus, 2))
    spark.conf.set("spark.corpusmill.inputTasks", str(cpus))  # the tables are single small files
    names = [n for n in HEADLINE if n in QUERIES]
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for n in names:
        run(spark, n, warm if os.path.isdir(warm) else sf_dir)
    for n in names:  # one untimed pass at the target scale (table footers, JIT on real sizes)
        run(spark, n, sf_dir)
    times = {}
    for n in names:
        times[n] = round(statistics.median(run(spark, n, sf_dir) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
