import glob
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import config as C
from corpusmill.plans import jobs as JB


def h(s):
    return hashlib.sha1(s.encode()).hexdigest()[:10]


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


@pytest.fixture()
def repo(tmp_dir):
    root = tmp_dir
    _w(f"{root}/data/manifests/self.json", json.dumps({
        "source_id": "self", "source": "self_authored", "license": "internal",
        "defaults": {"category": "rev", "difficulty": "easy", "challenge_family": "warmup", "split": "train",
                     "artifacts": {"language": "python", "has_code": True}},
        "records": [
            {"path": "data/raw/qa.jsonl", "format": "jsonl_qa", "defaults": {"system_prompt": "SYS"}},
            {"paths": ["msgs.jsonl"], "format": "jsonl_messages"},
            {"path": "data/raw/qa.json", "format": "json_qa", "defaults": {"artifacts": {"has_code": False}}},
            {"path": "data/raw/m.json", "format": "json_messages"},
        ]}))
    _w(f"{root}/data/manifests/disabled.json", json.dumps({"enabled": False, "records": [{"path": "nowhere.jsonl"}]}))
    _w(f"{root}/data/manifests/rules.json", json.dumps({
        "drop_keys": ["title"], "rules": [{"pattern": "(?i)harbor[ -]?games", "replacement": "<EVENT>"},
                                          {"pattern": "(?i)tide[_ -]?pool", "replacement": "<TASK>"}]}))
    _w(f"{root}/data/raw/qa.jsonl", "\n".join([
        json.dumps({"id": "tide_pool_17", "prompt": "Explain the Harbor Games gate?", "answer": " Turn it. ", "title": "T"}),
        "",
        json.dumps({"question": "Q2", "completion": "A2", "split": "eval"}),
        json.dumps({"id": "own", "prompt": "P", "response": "R", "system_prompt": "OWN"}),
    ]) + "\n")
    _w(f"{root}/data/manifests/msgs.jsonl", "\n".join([
        json.dumps({"messages": [{"role": "Human", "content": "hi"}, {"role": "bot", "content": "yo"}]}),
        json.dumps([{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]),
    ]) + "\n")
    _w(f"{root}/data/raw/qa.json", json.dumps([{"id": "x1", "user": "u", "response": "r"}]))
    _w(f"{root}/data/raw/m.json", json.dumps({"id": "m1", "messages": [
        {"role": "system", "content": "S"}, {"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]}))
    return root


EXTRA = T.StructType([T.StructField("title", T.StringType())])


def test_build_dataset_plain(spark, repo):
    res = JB.build_dataset(spark, f"{repo}/data/manifests", repo, extra_fields=EXTRA,
                           policy_path=None)
    rows = {r["id"]: r for r in res.samples.collect()}
    assert set(rows) == {"tide_pool_17", "self_qa_0_3", "own", "self_msgs_1_1", "self_msgs_1_2", "x1", "m1"}
    assert [(m["role"], m["content"]) for m in rows["own"]["messages"]] == [("system", "OWN"), ("user", "P"), ("assistant", "R")]
    r = rows["tide_pool_17"]
    assert [(m["role"], m["content"]) for m in r["messages"]] == [
        ("system", "SYS"), ("user", "Explain the Harbor Games gate?"), ("assistant", "Turn it.")]
    assert r["title"] == "T" and r["category"] == "rev" and r["split"] == "train"
    assert r["provenance"]["source_id"] == "self" and r["provenance"]["source_path"].endswith("data/raw/qa.jsonl")
    assert rows["self_qa_0_3"]["split"] == "eval"
    assert [m["role"] for m in rows["self_msgs_1_1"]["messages"]] == ["system", "user", "assistant"]
    assert rows["self_msgs_1_1"]["messages"][0]["content"] == C.DEFAULT_SYSTEM_PROMPT
    assert rows["x1"]["artifacts"].asDict() == {"language": "python", "has_code": False}
    assert [m["content"] for m in rows["m1"]["messages"]] == ["S", "u", "a"]
    s = res.summary.collect()[0]
    assert s["total_samples"] == 7 and s["splits"] == {"eval": 1, "train": 6} and s["manifests"] == {"self.json": 7}


def test_build_dataset_policy_and_strict(spark, repo, tmp_dir):
    res = JB.build_dataset(spark, f"{repo}/data/manifests", repo, extra_fields=EXTRA,
                           policy_path=f"{repo}/data/manifests/rules.json")
    rows = {r["id"]: r for r in res.samples.collect()}
    rid = "TASK__17_" + h("tide_pool_17")  # '>' + '_' -> '__'
    assert rid in rows and "title" not in res.samples.columns
    assert rows[rid]["messages"][1]["content"] == "Explain the <EVENT> gate?"
    strict = JB.build_dataset(spark, f"{repo}/data/manifests", repo, extra_fields=EXTRA, strict_anonymize=True,
                              policy_path=f"{repo}/data/manifests/rules.json")
    ids = sorted(r["id"] for r in strict.samples.collect())
    assert ids == sorted("rev_" + h(x) for x in ["tide_pool_17", "self_qa_0_3", "own", "self_msgs_1_1", "self_msgs_1_2", "x1", "m1"])
    assert "provenance" not in strict.samples.columns
    out = f"{tmp_dir}/out"
    JB.write_dataset(strict, out)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{out}/samples/split=*")) == ["split=eval", "split=train"]
    with pytest.raises(Exception):
        JB.write_dataset(strict, out)


def test_gate_blocks_unreviewed_scraped_manifest(spark, repo):
    _w(f"{repo}/data/manifests/scraped.json", json.dumps({
        "source_id": "scr", "source": "transformed_scraped",
        "records": [{"path": "data/raw/qa.json", "format": "json_qa",
                     "defaults": {"source_bucket": "scraped_derivative", "source_ledger_path": "data/raw/qa.json",
                                  "review_status": "pending", "allowed_for_training": True,
                                  "allowed_for_redistribution": False, "redistribution_status": "x"}}]}))
    with pytest.raises(JB.BuildError, match="blocked_review_status"):
        JB.build_dataset(spark, f"{repo}/data/manifests", repo)


def test_bad_record_is_quarantined_and_fails_strict_write(spark, repo, tmp_dir):
    _w(f"{repo}/data/manifests/msgs.jsonl", json.dumps({"messages": [{"role": "user", "content": "only"}]}) + "\n")
    res = JB.build_dataset(spark, f"{repo}/data/manifests", repo)
    q = res.quarantine.select("error_reason").collect()
    assert [r[0] for r in q] == ["no_assistant"]
    with pytest.raises(JB.BuildError, match="no_assistant"):
        JB.write_dataset(res, f"{tmp_dir}/o2")


def test_writeup_review_and_eval_jobs(spark, tmp_dir):
    body = "rsa aes lattice " + "word " * 120
    _w(f"{tmp_dir}/t.jsonl", "\n".join(json.dumps(r) for r in [
        {"final_url": "https://blog.example/w/1", "transform_status": "ok", "transform_method": "jina", "content": body},
        {"final_url": "https://ctftime.org/writeup/1", "transform_status": "ok", "transform_method": "jina", "content": body + "x"},
        {"final_url": "https://x.example/2", "transform_status": "error", "content": None},
    ]) + "\n")
    _w(f"{tmp_dir}/links.jsonl", json.dumps({"index": 1, "ctftime_writeup_url": "https://ctftime.org/writeup/1",
                                             "original_url": "https://blog.example/w/1"}) + "\n")
    summ = JB.build_writeup_dataset(spark, f"{tmp_dir}/t.jsonl", f"{tmp_dir}/w", f"{tmp_dir}/links.jsonl").collect()[0]
    assert (summ["input_ok_rows"], summ["selected_rows"], summ["train_rows"] + summ["eval_rows"]) == (2, 1, 1)
    files = glob.glob(f"{tmp_dir}/w/samples/_split=*/*.json")
    sample = json.loads(open(files[0]).readline())
    assert sample["artifacts"]["source_url"] == "https://blog.example/w/1" and sample["category"] == "crypto"

    _w(f"{tmp_dir}/batch_1/fetch_manifest.json", json.dumps({"batch_name": "batch 1", "records": [
        {"url": "https://a", "status": "ok"}, {"url": "https://b", "status": "cached"}, {"url": "https://c", "status": "error"}]}))
    rs = JB.prepare_review(spark, f"{tmp_dir}/batch_1/fetch_manifest.json", f"{tmp_dir}/rev", approve_training=True).collect()[0]
    assert (rs["records"], rs["pending_reviews"], rs["approved_for_training"]) == (3, 2, 2)
    led = [json.loads(line) for p in glob.glob(f"{tmp_dir}/rev/review_ledger/*.json") for line in open(p)]
    assert sorted(r["review_id"] for r in led) == ["batch_1_0001", "batch_1_0002", "batch_1_0003"]

    _w(f"{tmp_dir}/cases.jsonl", "\n".join([
        json.dumps({"id": "c1", "category": "rev", "prompt": "p", "checks": [{"type": "contains", "value": "turn the key"}]}),
        "",
        json.dumps({"prompt": "p2", "exact": "yes"}),
    ]) + "\n")
    resp = spark.createDataFrame([("c1", "use the turn the key"), ("case_0003", " no ")], "id string, response string")
    rep = {r["category"]: (r["total"], r["passed"]) for r in JB.run_eval(spark, f"{tmp_dir}/cases.jsonl", resp, f"{tmp_dir}/ev").collect()}
    assert rep == {"rev": (1, 1), "uncategorized": (1, 0), "__total__": (2, 1)}


def test_enumerate_fetch_transform_jobs(spark, tmp_dir):
    index = spark.createDataFrame([(1, '<a href="/writeup/2">x</a><a href="/writeup/1">y</a>'),
                                   (2, '<a href="/writeup/1">again</a><a href="/writeup/3">z</a>')], "ord long, html string")
    detail = spark.createDataFrame([
        ("https://ctftime.org/writeup/1", 'Original writeup (https://blog.example/w/1)'),
        ("https://ctftime.org/writeup/3", '<link rel="canonical" href="https://x/3">Original writeup (https://x/3)')],
        "url string, html string")
    s = JB.enumerate_links(spark, index, detail, f"{tmp_dir}/enum", target_source="both").collect()[0]
    assert (s["writeup_pages"], s["target_urls"], s["original_errors"]) == (3, 4, 0)
    targets = [line.strip() for p in sorted(glob.glob(f"{tmp_dir}/enum/targets/*.txt")) for line in open(p)]
    assert targets == ["https://ctftime.org/writeup/2", "https://ctftime.org/writeup/1", "https://blog.example/w/1",
                       "https://ctftime.org/writeup/3"]

    lines = spark.createDataFrame([(1, "https://a.example/p"), (2, "# skip"), (3, "https://b.example/q.md"),
                                   (4, "https://a.example/p"), (5, "https://c.example/")], "ord long, line string")
    payloads = spark.createDataFrame([
        ("https://a.example/p", "https://a.example/p", "<html>A</html>", "ok", "text/html; charset=x"),
        ("https://b.example/q.md", "https://b.example/q.md", "# B", "ok", "text/markdown"),
        ("https://b.example/q.md", "https://b.example/q.md", None, "error", None)],
        "url string, final_url string, body string, status string, content_type_raw string")
    log = f"{tmp_dir}/cache_log"
    recs1 = JB.fetch_batch(spark, lines, payloads, log, f"{tmp_dir}/f1", "b1", batch_seq=1).collect()
    assert len(recs1) == 3  # a URL landed twice still gives one record
    r1 = {r["url"]: r for r in recs1}
    assert r1["https://a.example/p"]["status"] == "ok" and r1["https://a.example/p"]["filename"] == "001_p.html"
    assert r1["https://c.example/"]["status"] == "error"
    assert r1["https://b.example/q.md"]["status"] == "ok" and r1["https://b.example/q.md"]["error"] is None
    assert r1["https://c.example/"]["error"].startswith("MissingPayload")
    r2 = {r["url"]: r["status"] for r in JB.fetch_batch(spark, lines, payloads, log, f"{tmp_dir}/f2", "b2", batch_seq=2).collect()}
    assert r2 == {"https://a.example/p": "cached", "https://b.example/q.md": "cached", "https://c.example/": "error"}

    from corpusmill.operators.review import review_ledger
    rec = spark.createDataFrame([(1, "https://github.com/o/r/blob/main/a.md", "ok"), (2, "https://blog.example/x", "ok"),
                                 (3, "https://gone.example/", "error")], "index long, url string, status string")
    led = review_ledger(rec, "b", approve_training=True)
    landed = spark.createDataFrame([("https://raw.githubusercontent.com/o/r/main/a.md", "line1\r\nline2  "),
                                    ("https://raw.githubusercontent.com/o/r/main/a.md", "short")],
                                   "transform_url string, text string")
    ts = JB.transform_selected(spark, led, landed, f"{tmp_dir}/t").collect()[0]
    assert (ts["input_rows"], ts["selected_rows"], ts["successes"], ts["errors"]) == (3, 2, 1, 1)
    assert ts["methods"] == {"github_raw": 1, "jina": 1}
    rows = [json.loads(line) for p in glob.glob(f"{tmp_dir}/t/transformed/*.json") for line in open(p)]
    ok = [r for r in rows if r["transform_status"] == "ok"][0]
    assert ok["content"] == "line1\nline2" and ok["content_sha256"] == hashlib.sha256(b"line1\nline2").hexdigest()


def test_cli_build_dataset_and_eval(spark, repo, tmp_dir, capsys):
    from corpusmill import cli

    assert cli.main(["build-dataset", "--manifest-dir", f"{repo}/data/manifests", "--repo-root", repo,
                     "--output-dir", f"{tmp_dir}/cli_out", "--redaction-rules", f"{repo}/data/manifests/rules.json",
                     "--strict-anonymize", "--extra-field", "title"]) == 0
    summary = json.loads(capsys.readouterr().out)
    assert summary["total_samples"] == 7 and summary["categories"] == {"rev": 7}
    rows = [json.loads(line) for p in glob.glob(f"{tmp_dir}/cli_out/samples/split=*/*.json") for line in open(p)]
    assert len(rows) == 7 and all("provenance" not in r and "title" not in r for r in rows)
    _w(f"{tmp_dir}/cases.jsonl", json.dumps({"id": "c1", "category": "pwn", "prompt": "p", "contains": "rop"}) + "\n")
    _w(f"{tmp_dir}/resp.jsonl", json.dumps({"id": "c1", "response": "use rop"}) + "\n")
    assert cli.main(["eval", "--cases", f"{tmp_dir}/cases.jsonl", "--responses", f"{tmp_dir}/resp.jsonl",
                     "--report-dir", f"{tmp_dir}/ev"]) == 0
    rep = {r["category"]: r["pass_rate"] for r in json.loads(capsys.readouterr().out)}
    assert rep == {"pwn": 1.0, "__total__": 1.0}


def test_written_records_are_clean_and_ordered(spark, repo, tmp_dir):
    res = JB.build_dataset(spark, f"{repo}/data/manifests", repo, extra_fields=EXTRA)
    JB.write_dataset(res, f"{tmp_dir}/o")
    train = [json.loads(line) for p in sorted(glob.glob(f"{tmp_dir}/o/samples/split=train/*.json")) for line in open(p)]
    assert all(not k.startswith("_") and k not in ("split", "manifest") for r in train for k in r)
    # input order: record 0 lines 1 and 4, then record 1 lines 1-2, record 2, record 3
    assert [r["id"] for r in train] == ["tide_pool_17", "own", "self_msgs_1_1", "self_msgs_1_2", "x1", "m1"]
    assert set(train[0]) == {"id", "category", "difficulty", "challenge_family", "source", "license", "artifacts",
                             "messages", "title", "provenance", "prompt", "question", "answer", "user", "response", "completion", "assistant"}


# --- inputs that once gave wrong answers -------------------------------------


def _transformed_rows(n):
    return [{"final_url": f"https://h.example/{i}", "transform_status": "ok", "transform_method": "jina",
             "content": f"topic{i} " + f"word{i} " * 150} for i in range(n)]


@pytest.mark.parametrize("parts", [1, 2, 13])
def test_part_files_do_not_mix_rows(spark, tmp_dir, parts):
    rows = _transformed_rows(26)
    for k in range(parts):
        _w(f"{tmp_dir}/t/part-{k:03d}.json", "".join(json.dumps(r) + "\n" for r in rows[k::parts]))
    s = JB.build_writeup_dataset(spark, f"{tmp_dir}/t", f"{tmp_dir}/w").collect()[0]
    assert (s["input_ok_rows"], s["selected_rows"]) == (26, 26)
    out = [json.loads(x) for p in glob.glob(f"{tmp_dir}/w/samples/_split=*/*.json") for x in open(p)]
    assert len(out) == 26
    for r in out:
        i = r["artifacts"]["source_url"].rsplit("/", 1)[1]
        assert r["messages"][2]["content"].startswith(f"topic{i} ")


def test_changed_splits_lose_no_lines(spark, tmp_dir):
    from corpusmill.sources import jsonl as J

    _w(f"{tmp_dir}/in/a.txt", "".join(f"line {i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    df = J.read_lines(spark, f"{tmp_dir}/in")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = df.selectExpr("count(*)", "count(distinct ord)", "count_if(value <> concat('line ', line - 1))").first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(got) == (20_000, 20_000, 0)


def test_truncated_line_is_not_lost(spark, tmp_dir):
    _w(f"{tmp_dir}/t.jsonl", json.dumps(_transformed_rows(1)[0]) + '\n{"final_url": "https://x", "content": "cut')
    with pytest.raises(JB.BuildError, match="t.jsonl:2"):
        JB.build_writeup_dataset(spark, f"{tmp_dir}/t.jsonl", f"{tmp_dir}/a")
    JB.build_writeup_dataset(spark, f"{tmp_dir}/t.jsonl", f"{tmp_dir}/b", strict=False)
    bad = [json.loads(x) for p in glob.glob(f"{tmp_dir}/b/quarantine/*.json") for x in open(p)]
    assert [b["line"] for b in bad] == [2]


def test_row_without_content_is_dropped_and_counted(spark, tmp_dir):
    rows = [*_transformed_rows(1), {"final_url": "https://none.example/", "transform_status": "ok", "transform_method": "jina", "content": None}]
    _w(f"{tmp_dir}/t.jsonl", "".join(json.dumps(r) + "\n" for r in rows))
    s = JB.build_writeup_dataset(spark, f"{tmp_dir}/t.jsonl", f"{tmp_dir}/w").collect()[0]
    assert (s["input_ok_rows"], s["dropped_short"], s["train_rows"] + s["eval_rows"]) == (2, 1, 1)


def test_odd_file_names_types_and_empty_ids(spark, tmp_dir):
    chat = [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]
    _w(f"{tmp_dir}/m/one.json", json.dumps({"source_id": "s", "records": [
        {"path": "../x y+%.jsonl", "format": "jsonl_messages"}, {"path": "../qa.jsonl", "format": "jsonl_qa"}]}))
    _w(f"{tmp_dir}/x y+%.jsonl", "".join(json.dumps(r) + "\n" for r in [
        {"id": "", "messages": chat}, {"id": "", "messages": chat},
        {"messages": [{"role": "user", "content": [{"type": "text"}]}, chat[1]]}, {"messages": [{"role": "user", "content": 7}, chat[1]]}]))
    _w(f"{tmp_dir}/qa.jsonl", "".join(json.dumps(r) + "\n" for r in [{"id": "ok", "prompt": "p", "answer": "a"}, {"prompt": {"x": 1}, "answer": "a"}]) + "[1]\n{cut\n")
    res = JB.build_dataset(spark, f"{tmp_dir}/m", tmp_dir)
    assert sorted(r["id"] for r in res.samples.collect()) == ["ok", "s_x_y__0", "s_x_y__1"]
    assert sorted(r["error_reason"] for r in res.quarantine.collect()) == [
        "content_not_text", "content_not_text", "malformed_json", "not_an_object", "prompt_or_answer_not_text"]


def test_gate_sees_the_source_of_defaults_and_any_record(spark, repo):
    _w(f"{repo}/data/manifests/z.json", json.dumps({"source_id": "z", "defaults": {"source": "transformed_scraped"},
                                                   "records": [{"path": "data/raw/qa.json", "format": "json_qa"}]}))
    with pytest.raises(JB.BuildError, match="missing:"):
        JB.build_dataset(spark, f"{repo}/data/manifests", repo)
    _w(f"{repo}/data/manifests/z.json", json.dumps({"source_id": "z", "records": [
        {"path": "data/raw/qa.json", "format": "json_qa"},
        {"path": "data/raw/m.json", "format": "json_messages", "defaults": {"source_bucket": "scraped_derivative"}}]}))
    with pytest.raises(JB.BuildError, match="z.json record #0"):
        JB.build_dataset(spark, f"{repo}/data/manifests", repo)


def test_default_source_and_license(spark, tmp_dir):
    _w(f"{tmp_dir}/m/a.json", json.dumps({"source": "top", "license": "top", "defaults": {"license": "mid"}, "records": [
        {"path": "../q.json", "format": "json_qa", "defaults": {"source": "rec"}}]}))
    _w(f"{tmp_dir}/q.json", json.dumps({"id": "i", "prompt": "p", "answer": "a"}))
    r = JB.build_dataset(spark, f"{tmp_dir}/m", tmp_dir).samples.collect()[0]
    assert (r["source"], r["license"]) == ("rec", "mid")


def test_malformed_manifest_stops_the_build(spark, repo):
    _w(f"{repo}/data/manifests/broken.json", '{"records": [')
    with pytest.raises(JB.BuildError, match="broken.json"):
        JB.build_dataset(spark, f"{repo}/data/manifests", repo)


def test_case_without_response_fails(spark, tmp_dir):
    _w(f"{tmp_dir}/c.jsonl", "".join(json.dumps({"id": i, "prompt": "p", "contains": "x"}) + "\n" for i in "ab"))
    rep = JB.run_eval(spark, f"{tmp_dir}/c.jsonl", spark.createDataFrame([("a", "x")], "id string, response string"), f"{tmp_dir}/e").collect()
    total = {r["category"]: r for r in rep}["__total__"]
    assert (total["total"], total["passed"], total["pass_rate"]) == (2, 1, 0.5)


def test_fetch_review_transform_writeups_with_defaults(spark, tmp_dir):
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(["# head", "", "https://a.example/1", "https://b.example/2"], 1)], "ord long, line string")
    payloads = spark.createDataFrame(
        [(u, u, "<p>x</p>", "ok", "text/html", 200) for u in ("https://a.example/1", "https://b.example/2")],
        "url string, final_url string, body string, status string, content_type_raw string, status_code int")
    log, store = f"file://{tmp_dir}/log", f"{tmp_dir}/bodies"
    first = JB.fetch_batch(spark, lines, payloads, log, f"{tmp_dir}/f1", "one", body_dir=store).collect()
    assert sorted((r["index"], r["status"], r["status_code"]) for r in first) == [(1, "ok", 200), (2, "ok", 200)]
    assert spark.read.parquet(store).count() == 1 and all(r["fetched_at"] and r["body_path"] for r in first)
    again = JB.fetch_batch(spark, lines, payloads, log, f"{tmp_dir}/f2", "two", body_dir=store).collect()
    assert all(r["status"] == "cached" and r["cache_hit"] and r["content_length"] == 8 and r["cached_from"] for r in again)
    JB.prepare_review(spark, f"{tmp_dir}/f1/fetch_manifest", f"{tmp_dir}/r", approve_training=True)
    ledger = spark.read.json(f"{tmp_dir}/r/review_ledger")
    assert sorted(r["review_id"] for r in ledger.collect()) == ["one_0001", "one_0002"]
    from corpusmill.operators.transform import route_targets

    urls = [r["transform_url"] for r in route_targets(ledger).collect()]
    texts = spark.createDataFrame([(u, f"{u} " * 60) for u in urls], "transform_url string, text string")
    s = JB.transform_selected(spark, ledger, texts, f"{tmp_dir}/t").collect()[0]
    assert (s["selected_rows"], s["successes"]) == (2, 2)
    w = JB.build_writeup_dataset(spark, f"{tmp_dir}/t/transformed", f"{tmp_dir}/w").collect()[0]
    assert w["input_ok_rows"] == 2


def test_undeclared_keys_pass_and_defaults_merge_deeply(spark, tmp_dir):
    _w(f"{tmp_dir}/m/a.json", json.dumps({"defaults": {"tags": ["d"], "meta": {"a": 1, "deep": {"x": "d"}}, "artifacts": {"has_code": True, "tool": "d"}},
                                         "records": [{"path": "../q.jsonl", "format": "jsonl_qa", "defaults": {"meta": {"deep": {"y": "r"}}}}]}))
    rows = [{"id": "i", "prompt": "p", "answer": "a", "writeup_year": 2021, "meta": {"a": 2}, "artifacts": {"source_url": "u"}},
            {"id": "j", "prompt": "p", "answer": "a", "odd": [1]}, {"id": "k", "prompt": "p", "answer": "a", "odd": {"z": 1}}]
    _w(f"{tmp_dir}/q.jsonl", "".join(json.dumps(r) + "\n" for r in rows))
    out = {r["id"]: r.asDict(recursive=True) for r in JB.build_dataset(spark, f"{tmp_dir}/m", tmp_dir).samples.collect()}
    i, j, k = out["i"], out["j"], out["k"]
    assert i["writeup_year"] == 2021 and i["tags"] == ["d"] and i["meta"] == {"a": 2, "deep": {"x": "d", "y": "r"}}
    assert i["artifacts"] == {"language": None, "has_code": True, "source_url": "u", "tool": "d"} and i["prompt"] == "p"
    assert j["meta"] == {"a": 1, "deep": {"x": "d", "y": "r"}} and (j["odd"].toJson(), k["odd"].toJson()) == ("[1]", '{"z":1}')
    only = JB.build_dataset(spark, f"{tmp_dir}/m", tmp_dir, infer_extra=False).samples
    assert "tags" not in only.columns and "prompt" not in only.columns


def test_outputs_are_checked_before_the_first_write(spark, tmp_dir):
    _w(f"{tmp_dir}/c.jsonl", json.dumps({"id": "a", "prompt": "p", "contains": "x"}) + "\n")
    os.makedirs(f"{tmp_dir}/e/report")
    with pytest.raises(FileExistsError):
        JB.run_eval(spark, f"{tmp_dir}/c.jsonl", spark.createDataFrame([("a", "x")], "id string, response string"), f"{tmp_dir}/e")
    assert not os.path.exists(f"{tmp_dir}/e/results")


def test_url_lines_of_list_and_file(spark, tmp_dir):
    _w(f"{tmp_dir}/u.txt", "https://b\n# c\nhttps://a\n")
    got = JB.url_lines(spark, ["https://a", "https://x"], f"{tmp_dir}/u.txt").collect()
    assert sorted((r["ord"], r["line"]) for r in got) == [(1, "https://a"), (2, "https://x"), (3, "https://b"), (4, "# c"), (5, "https://a")]
