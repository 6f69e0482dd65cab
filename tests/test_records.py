import hashlib

from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill.operators import gate as GT
from corpusmill.operators import records as RC

CONV = [
    # (sample, turn, role, content)
    ("ok", 0, " Human ", " hi "), ("ok", 1, "BOT", "hello"),
    ("sys", 0, "system", "be brief"), ("sys", 1, "user", "q"), ("sys", 2, "assistant", "a"),
    ("two_sys", 0, "system", "s1"), ("two_sys", 1, "system", "s2"), ("two_sys", 2, "answer", "a"),
    ("no_asst", 0, "user", "q"), ("no_asst", 1, "user", "q2"),
    ("blank", 0, "user", "q"), ("blank", 1, "assistant", "   "),
    ("role", 0, "narrator", ""), ("role", 1, "assistant", "a"),
    ("late_sys", 0, "user", "q"), ("late_sys", 1, "system", "s"), ("late_sys", 2, "assistant", "a"),
]


def test_exploded_message_normalisation(spark):
    df = spark.createDataFrame(CONV, "sid string, turn long, role string, content string")
    msgs, samples = RC.normalize_message_rows(df, "sid", "turn")
    errs = {r["sid"]: r["error_reason"] for r in samples.collect()}
    assert errs == {"ok": None, "sys": None, "two_sys": None, "no_asst": "no_assistant", "blank": "blank_content",
                    "role": "unsupported_role", "late_sys": None}
    by = {}
    for r in msgs.collect():
        by.setdefault(r["sid"], []).append((r["pos"], r["role"], r["content"]))
    assert sorted(by["ok"]) == [(0, "system", C.DEFAULT_SYSTEM_PROMPT), (1, "user", "hi"), (2, "assistant", "hello")]
    assert sorted(by["sys"])[0] == (0, "system", "be brief")
    assert [x[1] for x in sorted(by["late_sys"])] == ["system", "user", "system", "assistant"]
    assert len(by["two_sys"]) == 3


def test_nested_matches_exploded(spark):
    df = spark.createDataFrame(CONV, "sid string, turn long, role string, content string")
    nested = df.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "content"))).alias("m")) \
        .select("sid", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
    out = nested.select("sid", RC.normalize_messages_nested(F.col("messages")).alias("n"))
    got = {r["sid"]: (r["n"]["error_reason"], [m["role"] for m in (r["n"]["messages"] or [])]) for r in out.collect()}
    assert got["ok"] == (None, ["system", "user", "assistant"])
    assert got["blank"][0] == "blank_content" and got["role"][0] == "unsupported_role"
    assert got["no_asst"][0] == "no_assistant"
    empty = spark.createDataFrame([([],)], "messages array<struct<role:string,content:string>>")
    assert empty.select(RC.normalize_messages_nested(F.col("messages"))["error_reason"]).collect()[0][0] == "empty_messages"


def test_qa_to_messages_aliases_and_system(spark):
    df = spark.createDataFrame([
        ("a", None, None, " p ", None, "ans ", "sys"),
        (None, "q", None, None, "asst", None, ""),
        ("c", None, None, None, None, "x", None),
    ], "id string, prompt string, question string, user string, assistant string, answer string, system_prompt string")
    out = RC.qa_to_messages(df, default_system_prompt="DEF").withColumn(
        "id2", RC.default_id("id", "src", "file", F.lit(0), F.lit(7))).collect()
    m0 = [(m["role"], m["content"]) for m in out[0]["messages"]]
    assert m0 == [("system", "sys"), ("user", "p"), ("assistant", "ans")]
    m1 = [(m["role"], m["content"]) for m in out[1]["messages"]]
    assert m1 == [("system", "DEF"), ("user", "q"), ("assistant", "asst")]
    assert out[2]["error_reason"] == "missing_prompt_or_answer" and out[2]["messages"] is None
    assert out[1]["id2"] == "src_file_0_7"


def test_sample_ids(spark):
    df = spark.createDataFrame([("My Task #1", "Web "), ("x", None)], "id string, category string")
    h = lambda s: hashlib.sha1(s.encode()).hexdigest()[:10]
    r = df.select(RC.sample_id("id").alias("a"), RC.sample_id("id", "category", "strict").alias("b"),
                  RC.sample_id("id", mode="policy", redacted_id=F.lit("<X> 1")).alias("c")).collect()
    assert r[0]["a"] == "My_Task_1" and r[0]["b"] == "web_" + h("My Task #1") and r[0]["c"] == "X_1_" + h("My Task #1")
    assert r[1]["b"] == "sample_" + h("x")


def test_duplicate_ids_and_summary(spark):
    df = spark.createDataFrame([("a", "train", "rev", "s", "m1.json"), ("a", None, "rev", "s", "m1.json"),
                                ("b", "eval", "pwn", "s", "m2.json")],
                               "id string, split string, category string, source string, manifest string")
    assert [(r["id"], r["n"]) for r in RC.duplicate_ids(df).collect()] == [("a", 2)]
    s = RC.dataset_summary(df).collect()[0]
    assert s["total_samples"] == 3
    assert s["splits"] == {"dataset": 1, "eval": 1, "train": 1}
    assert s["categories"] == {"pwn": 1, "rev": 2} and s["manifests"] == {"m1.json": 2, "m2.json": 1}
    assert sorted(s["files_written"]) == ["dataset.jsonl", "eval.jsonl", "train.jsonl"]


def test_merge_defaults_layers(spark):
    samples = spark.createDataFrame([(0, "rev", None), (1, None, None)],
                                    "rec int, category string, artifacts struct<language:string,has_code:boolean>")
    ctl = spark.createDataFrame([(0, "pwn", "easy", "python", True), (1, "web", None, None, False)],
                                "rec int, d_category string, d_difficulty string, lang string, hc boolean")
    ctl = ctl.select("rec", "d_category", "d_difficulty",
                     F.struct(F.col("lang").alias("language"), F.col("hc").alias("has_code")).alias("d_artifacts"))
    out = {r["rec"]: r for r in RC.merge_defaults(samples, ctl, ["rec"]).collect()}
    assert out[0]["category"] == "rev" and out[0]["difficulty"] == "easy" and out[0]["artifacts"]["language"] == "python"
    assert out[1]["category"] == "web" and out[1]["difficulty"] == "unknown" and out[1]["license"] == "unknown"


GATE_ROWS = [
    # id, source, bucket, train, redis, status, redis_status, ledger
    (1, "self_authored", None, None, None, None, None, None),                       # no review needed
    (2, "transformed_scraped", None, None, True, "ok", "x", "l.jsonl"),              # missing one field
    (3, "transformed_scraped", None, True, True, "approved", "x", "gone.jsonl"),      # ledger missing
    (4, "transformed_scraped", None, False, True, "approved", "x", "l.jsonl"),        # not allowed
    (5, "transformed_scraped", None, True, True, " Review_Required ", "x", "l.jsonl"),  # blocked, mixed case
    (6, "transformed_scraped", None, True, True, "pending_review", "x", "l.jsonl"),   # passes (non-strict)
    (7, "self_authored", "scraped_derivative", True, True, "  ", "x", "l.jsonl"),     # bucket triggers; blank status
    (8, "self_authored", None, None, None, None, None, None),
]


def test_review_gate_rules(spark):
    df = spark.createDataFrame(GATE_ROWS, "m int, source string, source_bucket string, allowed_for_training boolean, "
                               "allowed_for_redistribution boolean, review_status string, redistribution_status string, "
                               "source_ledger_path string")
    listing = spark.createDataFrame([("l.jsonl",)], "source_ledger_path string")
    got = {r["m"]: r["gate_error"] for r in GT.review_gate(df, "m", listing).collect()}
    assert got == {1: None, 2: "missing:allowed_for_training", 3: "ledger_missing", 4: "not_allowed_for_training",
                   5: "blocked_review_status", 6: None, 7: "review_status_blank", 8: None}
    strict = {r["m"]: r["gate_error"] for r in GT.review_gate(df, "m", listing, strict=True).collect()}
    assert strict[6] == "blocked_review_status"


def test_gate_reports_all_missing_fields(spark):
    df = spark.createDataFrame([(1, "transformed_scraped", None, None, None, None, None, None)],
                               "m int, source string, source_bucket string, allowed_for_training boolean, "
                               "allowed_for_redistribution boolean, review_status string, redistribution_status string, "
                               "source_ledger_path string")
    got = GT.review_gate(df, "m").collect()[0]["gate_error"]
    assert got == "missing:" + ",".join(C.REVIEW_REQUIRED_FIELDS)


def test_hot_conversation_spreads_over_salted_join(spark):
    # one conversation holds a third of all messages
    rows = [("hot", i, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(600)]
    rows += [(f"c{j}", t, "user" if t == 0 else "assistant", "x") for j in range(600) for t in range(2)]
    df = spark.createDataFrame(rows, "sid string, turn long, role string, content string").repartition(8)
    msgs, samples = RC.normalize_message_rows(df, "sid", "turn")
    hot = msgs.filter("sid = 'hot'")
    assert hot.count() == 601 and [r["pos"] for r in hot.orderBy("pos").limit(2).collect()] == [0, 1]
    per_task = hot.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_task) < 601  # not gathered into one task
