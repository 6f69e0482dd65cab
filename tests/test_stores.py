"""Large JSON documents, body store, cache log, run folders, paths."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import fetch as FE
from corpusmill.plans import jobs as JB
from corpusmill.sinks import body_store as BS
from corpusmill.sinks import cache_log as CL
from corpusmill.sinks import writers as S
from corpusmill.sources import files as SF
from corpusmill.sources import json_items as JI
from corpusmill.sources import manifests as M


@pytest.fixture()
def splits(spark):
    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield of
    spark.conf.unset("spark.sql.files.minPartitionNum")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


TRICKY = [{"a": 'br}ace" \\'}, {"b": [1, {"c": "],["}]}, [{"d": "}{"}, []], "s,}\n", None, 1.5, {}, {"é": "\u2028"}]


def test_array_items_are_the_same_from_one_and_many_splits(spark, tmp_dir, splits):
    items = TRICKY * 40
    with open(f"{tmp_dir}/x.json", "w") as f:
        json.dump(items, f, ensure_ascii=False, indent=1)
    size = os.path.getsize(f"{tmp_dir}/x.json")
    for parts in (1, 13):
        splits(size // parts + 1)
        assert spark.read.option("lineSep", "}").text(f"{tmp_dir}/x.json").rdd.getNumPartitions() == parts
        got = {r["item"]: json.loads(r["value"]) for r in JI.read_json_items(spark, f"{tmp_dir}/x.json").collect()}
        assert [got[i] for i in range(len(got))] == items


@pytest.mark.parametrize("text, want", [
    ("[]", []), ("[ ]\n", []), ("\ufeff[1]", ["1"]), ('{"a": [1]}', ['{"a": [1]}']), ('"x"', ['"x"']), ("", []),
    ('[{"a":1},', ['{"a":1}', ","]), ('[{"a":1}', ['[{"a":1}']), ('{"a":1', ['{"a":1']), ("[1,2] x", ["1", ",2] x"]), ("[1,,2]", ["1", "", "2"]),
])
def test_odd_documents(spark, tmp_dir, text, want):
    with open(f"{tmp_dir}/x.json", "w") as f:
        f.write(text)
    assert [r["value"] for r in JI.read_json_items(spark, f"{tmp_dir}/x.json").orderBy("item").collect()] == want


def test_members_of_objects(spark, tmp_dir, splits):
    doc = {"n": 1, "records": [{"i": i, "t": "},{" * (i % 5)} for i in range(60)], "o": {"x": [1, 2], "y": {"z": "]"}}, "empty": [], "l": [[1, 2], {}]}
    with open(f"{tmp_dir}/x.json", "w") as f:
        json.dump(doc, f)
    for size in (10**6, 300):
        splits(size)
        got = {}
        for r in JI.read_json_members(spark, f"{tmp_dir}/x.json").orderBy("key", "item").collect():
            got.setdefault(r["key"], []).append(json.loads(r["value"])) if r["item"] is not None else got.update({r["key"]: json.loads(r["value"])})
        assert got == {k: v for k, v in doc.items() if k != "empty"}


def test_fetch_manifest_is_read_in_splits(spark, tmp_dir, splits):
    os.makedirs(f"{tmp_dir}/batch_9")
    with open(f"{tmp_dir}/batch_9/fetch_manifest.json", "w") as f:
        json.dump({"batch_name": "", "records": [{"url": f"u{i}", "status": "ok"} for i in range(100)]}, f)
    splits(500)
    rows = M.read_fetch_manifest(spark, f"{tmp_dir}/batch_9/fetch_manifest.json").orderBy("ord").collect()
    assert [(r["ord"], r["url"], r["batch_name"]) for r in rows] == [(i + 1, f"u{i}", "batch_9") for i in range(100)]


def _files(folder):
    return [f for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet") and "_digests" not in d]


def test_body_store_writes_few_files_and_each_body_once(spark, tmp_dir):
    store = f"{tmp_dir}/bodies"
    bodies = spark.range(3000, numPartitions=20).select(F.sha2(F.col("id").cast("string"), 256).alias("sha256"), F.col("id").cast("string").cast("binary").alias("body"))
    BS.append_bodies(bodies.unionByName(bodies), store)
    assert len(_files(store)) <= 256
    BS.append_bodies(bodies.limit(10), store)  # nothing new
    assert spark.read.parquet(store).count() == 3000
    assert BS.stored_digests(spark, store).agg(F.sum("length")).first()[0] == sum(len(str(i)) for i in range(3000))


def test_two_appends_at_once_and_one_that_died(spark, tmp_dir, monkeypatch):
    store = f"{tmp_dir}/bodies"
    rows = spark.createDataFrame([("aa", bytearray(b"x")), ("bb", bytearray(b"y"))], "sha256 string, body binary")
    empty = spark.createDataFrame([], "batch string, sha256 string, length long")
    with monkeypatch.context() as m:  # neither sees the other
        m.setattr(BS, "stored_digests", lambda *_: empty)
        BS.append_bodies(rows, store)
        BS.append_bodies(rows, store)
    rows.withColumn("sha256", F.lit("cc")).write.parquet(f"{store}/batch=99999999999999999999-dead")  # no digests: not a batch
    assert sorted((r["sha256"], bytes(r["body"])) for r in BS.read_body_store(spark, store).collect()) == [("aa", b"x"), ("bb", b"y")]


def test_cache_log_stays_at_one_base_and_few_deltas(spark, tmp_dir, monkeypatch):
    log = f"{tmp_dir}/log"
    monkeypatch.setattr(CL, "MAX_DELTAS", 4)
    for i in range(12):
        rows = [("u", "ok" if i % 2 else "error", f"s{i}", i), (f"u{i}", "ok", f"t{i}", i)]
        CL.append(spark.createDataFrame(rows, "url string, status string, sha256 string, ord long"), log)
        base, deltas, _ = CL._state(spark, log)
        assert len(deltas) < 4
    got = {r["cache_key"]: (r["sha256"], r["ord"]) for r in FE.latest_entries(CL.read(spark, log)).collect()}
    assert got == {"u": ("s11", 11), **{f"u{i}": (f"t{i}", i) for i in range(12)}} and base is not None
    CL.compact(spark, log)
    CL.compact(spark, log)  # nothing to do
    assert CL._state(spark, log)[1] == {} and FE.latest_entries(CL.read(spark, log)).count() == 13


def test_a_failing_last_sink_leaves_nothing(spark, tmp_dir, monkeypatch):
    out = f"{tmp_dir}/out"
    df = spark.range(3)

    def run(overwrite, fail):
        with S.RunOutput(spark, out, ("a", "b"), overwrite) as r:
            S.write_jsonl(df, r["a"])
            if fail:
                raise RuntimeError("disk")
            S.write_jsonl(df, r["b"])

    with pytest.raises(RuntimeError):
        run(False, True)
    assert os.listdir(out) == [] if os.path.exists(out) else True
    run(False, False)
    assert sorted(os.listdir(out)) == ["a", "b"]
    with pytest.raises(FileExistsError):
        run(False, False)
    with pytest.raises(RuntimeError):
        run(True, True)
    assert sorted(os.listdir(out)) == ["a", "b"] and spark.read.json(f"{out}/a").count() == 3
    # renaming fails half way: what was replaced comes back
    real = S.RunOutput._rename
    monkeypatch.setattr(S.RunOutput, "_rename", lambda self, fs, s, t: (_ for _ in ()).throw(OSError("rename")) if t.endswith("/out/b") and "/new/" in s else real(self, fs, s, t))
    before = sorted(os.listdir(f"{out}/a"))
    with pytest.raises(OSError):
        run(True, False)
    assert sorted(os.listdir(f"{out}/a")) == before and sorted(os.listdir(out)) == ["a", "b"]


def _ledger(spark, tmp_dir):
    text = [json.dumps({"url": "u", "status": "ok"})]
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/fetch_manifest.json", "w") as f:
        f.write('{"records": [' + ",".join(text) + "]}")
    return f"{tmp_dir}/in/fetch_manifest.json"


def test_jobs_leave_nothing_when_their_last_sink_fails(spark, tmp_dir, monkeypatch):
    def broken(*a, **k):
        raise RuntimeError("last sink")

    monkeypatch.setattr(S, "write_summary", broken)
    out = f"{tmp_dir}/out"
    pages = spark.createDataFrame([(1, '<a href="/writeup/7">x</a>')], "ord long, html string")
    with open(f"{tmp_dir}/t.jsonl", "w") as f:
        f.write("{}\n")
    with open(f"{tmp_dir}/c.jsonl", "w") as f:
        f.write('{"id": "1", "prompt": "p", "exact": "x"}\n')
    ledger = spark.createDataFrame([("r", "s", None, None, None, 1, "x", True, "ok")], "review_id string, source_url string, final_url string, "
                                   "permission_basis string, body_path string, ord long, review_status string, allowed_for_training boolean, fetch_status string")
    landed = spark.createDataFrame([], "transform_url string, text string")
    answers = spark.createDataFrame([("1", "x")], "id string, response string")
    jobs = [lambda: JB.prepare_review(spark, _ledger(spark, tmp_dir), out), lambda: JB.enumerate_links(spark, pages, None, out),
            lambda: JB.build_writeup_dataset(spark, f"{tmp_dir}/t.jsonl", out), lambda: JB.run_eval(spark, f"{tmp_dir}/c.jsonl", answers, out),
            lambda: JB.transform_selected(spark, ledger, landed, out, include_unapproved=True)]
    for job in jobs:
        with pytest.raises(RuntimeError, match="last sink"):
            job()
        assert not os.path.exists(out) or os.listdir(out) == []


@pytest.mark.parametrize("folder, path, want", [
    ("/m/x", "a.jsonl", "/m/x/a.jsonl"), ("/m/x", "../a b.jsonl", "/m/a b.jsonl"), ("file:/m/x", "./y/../a", "/m/x/a"),
    ("hdfs://nn:8020/m/x", "../r/a.jsonl", "hdfs://nn:8020/m/r/a.jsonl"), ("hdfs://nn/m", "c:d.json", "hdfs://nn/m/c:d.json"),
])
def test_paths_beside_manifests(spark, folder, path, want):
    assert SF.child_path(spark, folder, path) == want


def test_absolute_paths_and_relative_roots(spark):
    assert JB._resolve(spark, ".", "hdfs://nn/m/a.json", "hdfs://other/x") == "hdfs://other/x"
    assert JB._resolve(spark, ".", "/m/a.json", "file:///x/y") == "/x/y"
    assert SF.child_path(spark, ".", "q/../z.json") == os.path.join(os.getcwd(), "z.json")
    assert SF.child_path(spark, "s3a" + "://bucket/m", "../z.json") == "s3a://bucket/z.json"


def test_file_uri_manifest_folder_builds(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/m")
    with open(f"{tmp_dir}/m/a.json", "w") as f:
        json.dump({"records": [{"path": "../q.jsonl", "format": "jsonl_qa"}]}, f)
    with open(f"{tmp_dir}/q.jsonl", "w") as f:
        f.write('{"id": "i", "prompt": "p", "answer": "a"}\n')
    assert JB.build_dataset(spark, f"file://{tmp_dir}/m", tmp_dir).samples.count() == 1


def test_transform_reads_stored_bodies_by_digest(spark, tmp_dir):
    body = "caf\u00e9\r\n".encode("latin-1")  # not UTF-8
    import hashlib

    sha = hashlib.sha256(body).hexdigest()
    BS.append_bodies(spark.createDataFrame([(sha, bytearray(body))], "sha256 string, body binary"), f"{tmp_dir}/store")
    rows = [(i, "https://ctftime.org/writeup/1", p, i) for i, p in enumerate([f"{tmp_dir}/store/{sha}", f"/elsewhere/{'0' * 64}", "/landed/page.html"])]
    ledger = spark.createDataFrame([(str(i), s, None, None, p, o, "x", True, "ok") for i, s, p, o in rows],
                                   "review_id string, source_url string, final_url string, permission_basis string, body_path string, ord long, review_status string, allowed_for_training boolean, fetch_status string")
    landed = spark.createDataFrame([("/landed/page.html", "short"), ("/landed/page.html", "longer"), ("/landed/page.html", "longer"), (None, "x")], "transform_url string, text string")
    JB.transform_selected(spark, ledger, landed, f"{tmp_dir}/out", include_unapproved=True, body_dir=f"{tmp_dir}/store")
    got = {r["review_id"]: (r["transform_status"], r["content"]) for r in spark.read.schema("review_id string, transform_status string, content string").json(f"{tmp_dir}/out/transformed").collect()}
    assert got == {"0": ("ok", body.decode("utf-8", "replace").strip()), "1": ("error", None), "2": ("ok", "longer")}
