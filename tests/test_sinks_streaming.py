import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.review import review_ledger
from corpusmill.sinks import writers as S
from corpusmill.streaming import cache_ingest as CI


def test_split_writer_and_overwrite_guard(spark, tmp_dir):
    df = spark.createDataFrame([("a", "train"), ("b", None), ("c", "eval")], "id string, split string")
    S.write_split_jsonl(df, f"{tmp_dir}/out")
    assert sorted(os.path.basename(p) for p in glob.glob(f"{tmp_dir}/out/split=*")) == ["split=dataset", "split=eval", "split=train"]
    body = [json.loads(line) for p in glob.glob(f"{tmp_dir}/out/split=train/*.json") for line in open(p)]
    assert body == [{"id": "a"}]
    with pytest.raises(Exception):
        S.write_split_jsonl(df, f"{tmp_dir}/out")
    S.write_split_jsonl(df, f"{tmp_dir}/out", overwrite=True, keep_split_in_body=True)
    body = [json.loads(line) for p in glob.glob(f"{tmp_dir}/out/_split=train/*.json") for line in open(p)]
    assert body == [{"id": "a", "split": "train"}]


def test_ledger_csv(spark, tmp_dir):
    rec = spark.createDataFrame([(1, "https://a", "ok"), (2, "https://b", "error")], "index long, url string, status string")
    led = review_ledger(rec, "b 1", approve_training=True)
    S.write_ledger_csv(led, f"{tmp_dir}/csv")
    lines = [line.rstrip("\n") for p in sorted(glob.glob(f"{tmp_dir}/csv/*.csv")) for line in open(p)]
    assert lines[0].startswith("review_id,batch_name,source_url,final_url")
    assert "b_1_0001,b 1,https://a,https://a,,,ok,,,,,,,,pending_review,True,False,review_required,not_started," in lines


def test_streaming_cache_ingest_latest_wins(spark, tmp_dir):
    land, log = f"{tmp_dir}/landing", f"{tmp_dir}/cache_log"
    os.makedirs(land)
    with open(f"{land}/b1.json", "w") as fh:
        fh.write(json.dumps({"url": "https://a", "status": "ok", "sha256": "1", "ord": 1}) + "\n")
        fh.write(json.dumps({"url": "https://b", "status": "error", "sha256": "2", "ord": 2}) + "\n")
    CI.ingest_cache_entries(spark, land, log, name=f"ingest-{os.path.basename(tmp_dir)}")
    with open(f"{land}/b2.json", "w") as fh:
        fh.write(json.dumps({"url": " https://a ", "status": "ok", "sha256": "3", "ord": 3}) + "\n")
    CI.ingest_cache_entries(spark, land, log, name=f"ingest-{os.path.basename(tmp_dir)}")
    idx = {r["cache_key"]: (r["sha256"], r["status"]) for r in CI.cache_index(spark, log).collect()}
    assert idx == {"https://a": ("3", "ok"), "https://b": ("2", "error")}
    assert spark.read.parquet(log).count() == 3


def test_ordered_split_output(spark, tmp_dir):
    df = spark.range(0, 2000).select(F.col("id").alias("_o"), (F.col("id") % 2).cast("string").alias("split"),
                                     F.col("id").alias("v")).repartition(7)
    S.write_split_jsonl(df, f"{tmp_dir}/ord", order_by="_o")
    for sp in ("0", "1"):
        vals = [json.loads(line)["v"] for p in sorted(glob.glob(f"{tmp_dir}/ord/split={sp}/*.json")) for line in open(p)]
        assert vals == sorted(vals) and len(vals) == 1000


def test_content_addressed_body_store(spark, tmp_dir):
    from corpusmill.operators.fetch import new_bodies

    store = f"{tmp_dir}/bodies"
    first = spark.createDataFrame([("aa11", b"x"), ("aa11", b"x"), ("bb22", b"y")], "sha256 string, body binary")
    S.append_bodies(new_bodies(first, spark.createDataFrame([], "sha256 string")), store)
    second = spark.createDataFrame([("bb22", b"y"), ("cc33", b"z")], "sha256 string, body binary")
    S.append_bodies(new_bodies(second, spark.read.parquet(store).select("sha256")), store)
    got = sorted((r["sha256"], bytes(r["body"])) for r in spark.read.parquet(store).collect())
    assert got == [("aa11", b"x"), ("bb22", b"y"), ("cc33", b"z")]


def test_summary_is_one_document(spark, tmp_dir):
    df = spark.createDataFrame([(1, {"a": 2})], "records long, methods map<string,bigint>")
    S.write_summary(df, f"{tmp_dir}/summary")
    files = glob.glob(f"{tmp_dir}/summary/*.json")
    assert len(files) == 1 and json.loads(open(files[0]).read()) == {"records": 1, "methods": {"a": 2}}
