"""Command line for the file-based jobs.

    python -m corpusmill.cli build-dataset --manifest-dir data/raw/manifests --output-dir data/processed \
        [--redaction-rules rules.json] [--strict-anonymize] [--overwrite]
    python -m corpusmill.cli build-writeups --transformed-file t.jsonl [--enumeration-jsonl links.jsonl] --output-dir out
    python -m corpusmill.cli prepare-review --fetch-manifest batch/fetch_manifest.json --output-dir batch/review \
        [--approve-training] [--approve-redistribution] [--review-status S] [--redistribution-status S] [--permission-basis T]
    python -m corpusmill.cli eval --cases cases.jsonl --responses responses.jsonl --report-dir out/eval
    python -m corpusmill.cli links --index-pages pages.parquet [--detail-pages pages.parquet] --output-dir out [--target-source both]
    python -m corpusmill.cli fetch [--url U ...] [--url-file urls.txt] --payloads landed.parquet --output-dir out --batch-name b \
        [--cache-log log] [--cache-mode reuse|refresh|off] [--body-dir store]
    python -m corpusmill.cli transform --ledger out/review_ledger --landed-text text.parquet --output-dir out [--limit N] [--include-unapproved]
    python -m corpusmill.cli render-split --split-file data/processed/samples/split=train --output out/train_text

Each command builds one Spark plan per output on the session it finds (or a
local one) and prints the summary as JSON.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from corpusmill.config import CurationConfig
from corpusmill.plans import jobs


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from corpusmill.session import build_session

    return build_session(app="corpusmill-cli")


def _print(df) -> None:
    rows = [r.asDict(recursive=True) for r in df.collect()]
    print(json.dumps(rows[0] if len(rows) == 1 else rows, indent=2, default=str))


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="corpusmill")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build-dataset")
    b.add_argument("--manifest-dir", required=True)
    b.add_argument("--repo-root", default=".")
    b.add_argument("--output-dir", required=True)
    b.add_argument("--redaction-rules")
    b.add_argument("--strict-anonymize", action="store_true")
    b.add_argument("--allow-missing-paths", action="store_true")
    b.add_argument("--extra-field", action="append", default=[], help="pass-through string key (repeatable)")
    b.add_argument("--overwrite", action="store_true")

    w = sub.add_parser("build-writeups")
    w.add_argument("--transformed-file", required=True)
    w.add_argument("--enumeration-jsonl")
    w.add_argument("--output-dir", required=True)
    w.add_argument("--max-assistant-chars", type=int, default=CurationConfig().max_chars)
    w.add_argument("--min-content-chars", type=int, default=CurationConfig().min_chars)
    w.add_argument("--overwrite", action="store_true")

    r = sub.add_parser("prepare-review")
    r.add_argument("--fetch-manifest", required=True)
    r.add_argument("--output-dir", required=True)
    r.add_argument("--approve-training", action="store_true")
    r.add_argument("--approve-redistribution", action="store_true")
    r.add_argument("--review-status")
    r.add_argument("--redistribution-status")
    r.add_argument("--permission-basis", default="")
    r.add_argument("--overwrite", action="store_true")

    e = sub.add_parser("eval")
    e.add_argument("--cases", required=True)
    e.add_argument("--responses", required=True, help="JSONL with id and response")
    e.add_argument("--report-dir", required=True)
    e.add_argument("--default-system-prompt")
    e.add_argument("--overwrite", action="store_true")

    s = sub.add_parser("render-split")
    s.add_argument("--split-file", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--overwrite", action="store_true")

    li = sub.add_parser("links")
    li.add_argument("--index-pages", required=True, help="Parquet with ord and html")
    li.add_argument("--detail-pages", help="Parquet with url and html")
    li.add_argument("--output-dir", required=True)
    li.add_argument("--target-source", default="ctftime")
    li.add_argument("--overwrite", action="store_true")

    f = sub.add_parser("fetch")
    f.add_argument("--url", action="append", default=[])
    f.add_argument("--url-file")
    f.add_argument("--payloads", required=True, help="Parquet of landed payloads")
    f.add_argument("--output-dir", required=True)
    f.add_argument("--batch-name", help="made of the time if not given")
    f.add_argument("--cache-log")
    f.add_argument("--cache-mode", default="reuse")
    f.add_argument("--body-dir")
    f.add_argument("--overwrite", action="store_true")

    t = sub.add_parser("transform")
    t.add_argument("--ledger", required=True, help="JSONL ledger")
    t.add_argument("--landed-text", required=True, help="Parquet with transform_url and text")
    t.add_argument("--output-dir", required=True)
    t.add_argument("--body-dir", help="store of cached bodies")
    t.add_argument("--limit", type=int)
    t.add_argument("--include-unapproved", action="store_true")
    t.add_argument("--overwrite", action="store_true")

    a = p.parse_args(argv)
    spark = _session()
    if a.cmd == "build-dataset":
        extra = T.StructType([T.StructField(n, T.StringType()) for n in a.extra_field]) if a.extra_field else None
        res = jobs.build_dataset(spark, a.manifest_dir, a.repo_root, policy_path=a.redaction_rules,
                                 strict_anonymize=a.strict_anonymize, allow_missing_paths=a.allow_missing_paths,
                                 extra_fields=extra)
        jobs.write_dataset(res, a.output_dir, overwrite=a.overwrite)
        _print(res.summary)
    elif a.cmd == "build-writeups":
        cfg = CurationConfig(max_chars=a.max_assistant_chars, min_chars=a.min_content_chars)
        _print(jobs.build_writeup_dataset(spark, a.transformed_file, a.output_dir, a.enumeration_jsonl, cfg, a.overwrite))
    elif a.cmd == "prepare-review":
        _print(jobs.prepare_review(spark, a.fetch_manifest, a.output_dir, a.overwrite,
                                   approve_training=a.approve_training, approve_redistribution=a.approve_redistribution,
                                   review_status=a.review_status, redistribution_status=a.redistribution_status,
                                   permission_basis=a.permission_basis))
    elif a.cmd == "eval":
        resp = spark.read.schema("id string, response string").json(a.responses)
        _print(jobs.run_eval(spark, a.cases, resp, a.report_dir, a.default_system_prompt, overwrite=a.overwrite))
    elif a.cmd == "render-split":
        out = jobs.render_training_split(spark, a.split_file, a.output, overwrite=a.overwrite)
        print(json.dumps({"rows": out.count()}))
    elif a.cmd == "links":
        detail = spark.read.parquet(a.detail_pages) if a.detail_pages else None
        _print(jobs.enumerate_links(spark, spark.read.parquet(a.index_pages), detail, a.output_dir, a.target_source, a.overwrite))
    elif a.cmd == "fetch":
        lines = jobs.url_lines(spark, a.url, a.url_file)
        out = jobs.fetch_batch(spark, lines, spark.read.parquet(a.payloads), a.cache_log, a.output_dir, a.batch_name, a.body_dir,
                               a.cache_mode, overwrite=a.overwrite)
        print(json.dumps({r["status"]: r["count"] for r in out.groupBy("status").count().collect()}))
    elif a.cmd == "transform":
        _print(jobs.transform_selected(spark, spark.read.json(a.ledger), spark.read.parquet(a.landed_text), a.output_dir,
                                       a.include_unapproved, a.limit, a.overwrite, a.body_dir))
    return 0


if __name__ == "__main__":
    sys.exit(main())
