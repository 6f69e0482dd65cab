import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.fetch import url_list
from corpusmill.sources import jsonl as J
from corpusmill.sources import manifests as M


def _write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, encoding=None if "b" in mode else "utf-8") as fh:
        fh.write(text)


def test_line_numbers_exact_across_splits(spark, tmp_dir):
    lines_a = ['{"id": "a%d"}' % i if i % 5 else "" for i in range(1, 400)]
    lines_b = ['{"id": "b%d"}' % i for i in range(1, 50)]
    _write(f"{tmp_dir}/in/a.jsonl", "\n".join(lines_a) + "\n")
    _write(f"{tmp_dir}/in/b.jsonl", "\n".join(lines_b) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")  # many splits per file
    try:
        df = J.read_jsonl(spark, f"{tmp_dir}/in", T.StructType([T.StructField("id", T.StringType())]))
        got = {(os.path.basename(r["file"]), r["line"]): r["id"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {("a.jsonl", i + 1): json.loads(s)["id"] for i, s in enumerate(lines_a) if s}
    want.update({("b.jsonl", i + 1): json.loads(s)["id"] for i, s in enumerate(lines_b)})
    assert got == want


def test_json_documents_and_message_payloads(spark, tmp_dir):
    _write(f"{tmp_dir}/d/one.json", '﻿{"prompt": "p", "answer": "a"}')
    _write(f"{tmp_dir}/d/many.json", '[{"prompt": "p1"}, {"prompt": "p2", "answer": "a2"}]')
    schema = T.StructType([T.StructField("prompt", T.StringType()), T.StructField("answer", T.StringType())])
    got = sorted((os.path.basename(r["file"]), r["item_index"], r["prompt"]) for r in J.read_json_documents(spark, f"{tmp_dir}/d", schema).collect())
    assert got == [("many.json", 0, "p1"), ("many.json", 1, "p2"), ("one.json", 0, "p")]
    df = spark.createDataFrame([('[{"role":"user","content":"x"}]',), ('{"id":"k","messages":[{"role":"bot","content":"y"}]}',)], "v string")
    r = df.select(J.messages_payload("v").alias("p")).collect()
    assert r[0]["p"]["is_list"] and r[0]["p"]["id"] is None and r[0]["p"]["messages"][0]["content"] == "x"
    assert r[1]["p"]["id"] == "k" and r[1]["p"]["messages"][0]["role"] == "bot"


def test_manifests_and_records(spark, tmp_dir):
    _write(f"{tmp_dir}/m/b.json", json.dumps({"source_id": "s2", "records": [{"path": "x.jsonl", "format": "jsonl_qa"},
                                                                           {"paths": ["y1.jsonl", "y2.jsonl"]}, {"format": "json_qa"}]}))
    _write(f"{tmp_dir}/m/a.json", json.dumps({"enabled": False, "records": [{"path": "z"}]}))
    _write(f"{tmp_dir}/m/rules.json", json.dumps({"drop_keys": []}))
    man = M.read_manifests(spark, f"{tmp_dir}/m", skip="rules.json")
    recs = M.manifest_records(man).collect()
    got = sorted((r["source_id"] if "source_id" in r else None, r["record_index"], r["path_index"], r["path"], r["format"], r["error_reason"])
                 for r in M.manifest_records(man.select("manifest", "source_id", "enabled", "records"), "manifest")
                 .join(man.select("manifest", "source_id"), "manifest").collect())
    assert len(recs) == 4
    assert got == [("s2", 0, 0, "x.jsonl", "jsonl_qa", None), ("s2", 1, 0, "y1.jsonl", "jsonl_messages", None),
                   ("s2", 1, 1, "y2.jsonl", "jsonl_messages", None), ("s2", 2, None, None, "json_qa", "record_without_path")]


def test_fetch_manifest_url_file_and_bodies(spark, tmp_dir):
    doc = {"batch_name": "", "records": [{"url": "https://a", "status": "ok", "index": 1}, {"url": "https://b", "status": "error"}]}
    _write(f"{tmp_dir}/batch_07/fetch_manifest.json", "﻿" + json.dumps(doc))
    r = M.read_fetch_manifest(spark, f"{tmp_dir}/batch_07/fetch_manifest.json").orderBy("ord").collect()
    assert [(x["batch_name"], x["ord"], x["url"], x["status"]) for x in r] == [("batch_07", 1, "https://a", "ok"), ("batch_07", 2, "https://b", "error")]
    _write(f"{tmp_dir}/urls.txt", "﻿https://x\n# comment\n\n  https://y  \nhttps://x\n﻿  https://z\n")
    got = sorted((r["url"], r["ord"]) for r in url_list(J.read_url_file(spark, f"{tmp_dir}/urls.txt")).collect())
    assert got == [("  https://z", 6), ("https://x", 1), ("https://y", 4)]
    _write(f"{tmp_dir}/bodies/a.html", b"ok \xff\xfe end", "wb")
    assert J.read_bodies(spark, f"{tmp_dir}/bodies").collect()[0]["text"] == b"ok \xff\xfe end".decode("utf-8", "replace")
