import pytest
from pyspark.sql import functions as F

from corpusmill.operators import evaluation as EV
from corpusmill.operators import render as RN


def test_checks_and_scores(spark):
    cases = spark.createDataFrame([
        (1, None, "web", None, " Answer ", "Ans", "(?i)^ANS"),
        (2, "c2", None, [("regex", "line$", ["MULTILINE"])], None, None, None),
        (3, "c3", "", [("contains", "zz", None)], None, None, None),
    ], "k int, id string, category string, checks array<struct<type:string,value:string,flags:array<string>>>, "
       "exact string, contains string, regex string")
    cases = cases.withColumn("id", EV.default_case_id("id", F.col("k")))
    resp = spark.createDataFrame([(1, "Answer\n"), (2, "a line\nnext"), (3, "no")], "k int, response string")
    s = {r["id"]: r for r in EV.score_cases(cases, resp, "k").collect()}
    assert [c["type"] for c in s["case_0001"]["checks_result"]] == ["exact", "contains", "regex"]
    assert s["case_0001"]["passed"] and s["c2"]["passed"] and not s["c3"]["passed"]
    rep = {r["category"]: (r["total"], r["passed"], r["failed"], r["pass_rate"])
           for r in EV.eval_report(EV.score_cases(cases, resp, "k")).collect()}
    assert rep == {"web": (1, 1, 0, 1.0), "uncategorized": (2, 1, 1, 0.5), "__total__": (3, 2, 1, 0.6667)}


def test_pass_rate_half_even(spark):
    df = spark.createDataFrame([("x", i == 0) for i in range(32)], "category string, passed boolean")
    rate = [r["pass_rate"] for r in EV.eval_report(df).collect() if r["category"] == "x"][0]
    assert rate == round(1 / 32, 4) == 0.0312


def test_unsupported_check_type_fails(spark):
    cases = spark.createDataFrame([(1, [("fuzzy", "x", None)])], "k int, checks array<struct<type:string,value:string,flags:array<string>>>")
    resp = spark.createDataFrame([(1, "x")], "k int, response string")
    with pytest.raises(Exception, match="Unsupported check type"):
        EV.score_cases(cases, resp, "k").collect()


def test_render(spark):
    df = spark.createDataFrame([([("user", "hi"), ("assistant", "yo")], "p"), (None, "raw"), ([], "raw2")],
                               "messages array<struct<role:string,content:string>>, prompt string")
    out = df.select(RN.render_messages(F.col("messages")).alias("t"),
                    RN.render_prompt(F.col("messages"), F.col("prompt"), "SYS").alias("p1"),
                    RN.render_prompt(F.col("messages"), F.col("prompt"), None).alias("p2")).collect()
    assert out[0]["t"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert out[0]["p1"] == out[0]["t"] + "<|im_start|>assistant\n"
    assert out[1]["p1"] == "<|im_start|>system\nSYS<|im_end|>\n<|im_start|>user\nraw<|im_end|>\n<|im_start|>assistant\n"
    assert out[1]["p2"] == "raw" and out[2]["p2"] == "raw2"
    errs = [r["error_reason"] for r in RN.render_split(df).collect()]
    assert errs == [None, "missing_messages", "missing_messages"]


def test_regex_checks_follow_python_re(spark):
    import re

    cases = [(1, r"(?P<w>ab)(?P=w)", "xxabab"), (2, r"end\Z", "the end"), (3, r"^b", "a\nb"), (4, r"\bword\b", "a word."),
             (5, r"caf\w", "café"), (6, r"a.c", "a\rc"), (7, r"(?P<x>\d+)-(?P=x)$", "12-12\n")]
    df = spark.createDataFrame([(k, [("regex", p, None)]) for k, p, _ in cases],
                               "k int, checks array<struct<type:string,value:string,flags:array<string>>>")
    resp = spark.createDataFrame([(k, t) for k, _, t in cases], "k int, response string")
    got = {r["k"]: r["passed"] for r in EV.score_cases(df, resp, "k").collect()}
    assert got == {k: re.search(p, t) is not None for k, p, t in cases}
