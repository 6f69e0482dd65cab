"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra
columns with clashing names: no operator and no stage fails on them."""

import hashlib

import pytest
from pyspark.sql import types as T

import corpus_pipeline as P
from corpusmill.llm import (decontaminate, linkgraph, mixing, ngram_join, quality, secrets, sharding, topk, warc, windows)

LONG = " ".join(f"w{i}" for i in range(30_000))
WORDS = " ".join(f"a{i}" for i in range(60))
DOC = "doc_id long, text string, lang string, source string, n_chars long, n long, t string, k long, size long, h long, __mix int"


def docs(spark, rows):
    return spark.createDataFrame([(i, x, None, s, None, 1, "t", 2, 3, 4, 5) for i, x, s in rows], DOC)


ODD = [
    (1, None, "s"), (2, "", "s"), (3, " \n\t ", None), (4, LONG, "s"), (5, LONG, "s"), (6, WORDS, "u"), (6, WORDS, "u"),
    (7, WORDS + " tail", "u"), (None, WORDS, None), (None, None, None), (8, "x" * 2_100_000, "s"), (9, "one two", "v"), (10, "one two", "v"),
]


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, text string, score double")


def bench(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string, k long, doc_id long")


def test_join(spark):
    out = {}
    for r in ngram_join.jaccard_components(docs(spark, ODD)).collect():
        out.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert (out[1], out[2], out[3]) == ([(0, 1)], [(0, 2)], [(0, 3)])
    assert out[5] == [(29_996, 4)] and out[6] == [(56, 6)] * 2 and out[7] == [(57, 6)]
    assert out[8] == [(1, 8)] and out[10] == [(1, 9)] and sorted(out[None], key=str) == [(0, None), (56, None)]
    assert ngram_join.jaccard_components(docs(spark, [])).count() == 0


def test_join_keeps_one(spark):
    kept = ngram_join.keep_one_per_group(docs(spark, ODD))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 6, 8, 9]
    assert kept.columns == [f.split()[0] for f in DOC.split(", ")]


def test_decontaminate(spark):
    b = bench(spark, [(1, WORDS, 0, 0), (1, "one two", 0, 0), (2, None, 0, 0), (None, WORDS, 0, 0), (3, "", 0, 0), (10, "ONE, two!", 0, 0)])
    out = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in decontaminate.contamination(docs(spark, ODD), b).collect()]
    none, one = hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"1").hexdigest()
    assert out.count((6, 60, 60, 1, one)) == 2 and (7, 61, 60, 1, one) in out and (None, 60, 60, 1, one) in out
    assert (9, 2, 2, 2, hashlib.sha256(b"1,10").hexdigest()) in out and (4, 30_000, 0, 0, none) in out and (1, 0, 0, 0, none) in out
    assert sorted(r["doc_id"] or 0 for r in decontaminate.drop_contaminated(docs(spark, ODD), b).collect()) == [0, 1, 2, 3, 4, 5, 8]
    assert decontaminate.contamination(docs(spark, ODD), bench(spark)).filter("contaminated").count() == 0
    assert decontaminate.contamination(docs(spark, []), b).count() == 0


def test_quality(spark):
    out = quality.score_documents(docs(spark, ODD), labels(spark)).collect()
    assert len(out) == len(ODD) and {r["score"] for r in out} == {0.5}
    one = labels(spark, [(i, 0, None, None, None) for i in range(1, 11)] + [(None, 1, 0, "", 0.0), (6, None, 0, "", 0.0)])
    assert {r["predicted"] for r in quality.score_documents(docs(spark, ODD), one).collect()} == {0}
    both = labels(spark, [(i, i % 2, None, None, None) for i in range(1, 11)])
    scores = quality.score_documents(docs(spark, ODD), both).collect()
    assert len(scores) == len(ODD) and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.score_documents(docs(spark, []), both).count() == 0
    assert quality.keep_good(docs(spark, ODD), one).count() == 2  # rows without an id stay


def test_mixing(spark):
    out = mixing.mix(docs(spark, ODD)).collect()
    assert len(out) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in out)
    assert all(r["taken"] == 0 for r in out if r["size"] == 0)
    assert mixing.mix(docs(spark, [])).count() == 0
    kept = mixing.apply_mix(docs(spark, ODD))
    assert kept.columns == [f.split()[0] for f in DOC.split(", ")]
    assert kept.count() == sum(r["copies"] for r in out)


def test_sharding(spark):
    out = sharding.shard_documents(docs(spark, ODD)).collect()
    assert len(out) == len(ODD)
    for s in range(16):
        at = sorted(r["slot"] for r in out if r["shard"] == s)
        assert at == list(range(len(at)))
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def test_top_k(spark):
    schema = "vec_id long, embedding array<float>, label int, v double, id long, score long"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, []), (6, [1.0, 0.5]), (7, [1.0, 0.5]),
            (50, [1.0, 0.5]), (50, [1.0, 0.5]), (None, [1.0, 1.0]), (8, [1.0]), (9, [3e38, 3e38]), (100, [1.0])]
    df = spark.createDataFrame([(i, v, None, 0.0, 1, 2) for i, v in rows], schema)
    out = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, 3, 50).collect()}
    same = 256 * 256 + 128 * 128
    assert [out[0, k] for k in (1, 2, 3)] == [(9, (1 << 63) - 1), (6, same), (7, same)]
    assert [out[50, k] for k in (1, 2, 3)] == [(9, (1 << 63) - 1), (0, same), (6, same)]
    assert out[100, 1] == (8, 65536) and (100, 2) not in out and len(out) == 7
    assert topk.top_k(df.limit(0), 3, 50).count() == 0


def test_secrets(spark):
    out = {(r["doc_id"], r["spans"]) for r in secrets.scan_secrets(docs(spark, ODD)).collect()}
    assert (1, "") in out and (None, "") in out
    assert secrets.scan_secrets(docs(spark, [])).count() == 0


def test_link_graph(spark):
    schema = "page_id long, url string, html string, host string, t double, n long, src string"
    rows = [(1, None, None), (2, "nothing", ""), (3, "http://X.Net/a", None), (3, "http://X.Net/a", None), (None, "http://a.org?q", "<a href='//x.net'>"), (4, "http://", "")]
    df = spark.createDataFrame([(i, u, h, "h", 0.0, 1, "s") for i, u, h in rows], schema)
    out = [tuple(r) for r in linkgraph.judge_urls(df, [("net", "/", "block")]).collect()]
    assert out.count((3, "x.net", "/a", "net/", "block")) == 2 and (1, "", "", None, "allow") in out and (2, "", "", None, "allow") in out
    assert (None, "a.org", "", None, "block") in out  # it only links to a blocked host
    assert linkgraph.judge_urls(df.limit(0), [("net", "/", "block")]).count() == 0


def test_warc(spark):
    schema = "page_id long, url string, html string, digest string, body string, last long, of int"
    big = "é" * 700
    rows = [(1, None, None), (2, "http://a b\r\nX: y", ""), (3, "u", big), (4, "u", big), (4, "u", big), (None, "u", big), (5, "u", "short"), (6, "u", "short")]
    df = spark.createDataFrame([(i, u, h, "d", "b", 1, 2) for i, u, h in rows], schema)
    out = sorted(((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(df).collect()), key=str)
    assert out == sorted([(1, 0, "response", None), (2, 0, "response", None), (3, 1400, "revisit", 4), (4, 1400, "response", None), (4, 1400, "response", None),
                          (0, 1400, "revisit", 4), (5, 5, "response", None), (6, 5, "response", None)], key=str)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_windows(spark):
    out = {(r["doc_id"], r["passage_start"], r["passage_end"]) for r in windows.repeated_passages(docs(spark, ODD)).collect()}
    assert out == {(4, 0, 30_000), (5, 0, 30_000), (6, 0, 60), (7, 0, 60)}
    assert windows.repeated_passages(docs(spark, [])).count() == 0


@pytest.mark.parametrize("rows", [[], ODD])
def test_stages(spark, tmp_dir, rows):
    labels(spark, [(i, int(i != 9), None, None, None) for i in range(1, 11)]).write.parquet(f"{tmp_dir}/labels.parquet")
    bench(spark, [(1, "one two", 0, 0)]).write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    for name, step in P.STAGES[:-1]:
        assert step(spark, docs(spark, rows), tmp_dir).columns == [f.split()[0] for f in DOC.split(", ")], name
    assert isinstance(P.run(spark, tmp_dir).schema, T.StructType)
