"""Very many equal rows, and one text with very many secrets."""

import time

from pyspark.sql import functions as F

from corpusmill.llm import mixing, secrets, sharding


def test_equal_rows_are_written_out_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 100)
    docs = spark.range(25_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(1, "a"), (2, "b"), (None, None), (None, None)], "doc_id long, text string"))
    out = sharding.shard_documents(docs)
    by = out.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.min("slot").alias("a"), F.max("slot").alias("b")).collect()
    assert sum(r["n"] for r in by) == 25_004 and all((r["a"], r["b"] + 1) == (0, r["n"]) and r["d"] == r["n"] for r in by)


def test_equal_rows_round_as_one_entry(spark):
    docs = spark.range(6000).select(
        F.when(F.col("id") < 4000, F.lit(None)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") < 4000, F.lit("one two three")).otherwise(F.concat_ws(" ", F.sequence(F.lit(0), F.col("id") % 9))).alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("source"))
    out = mixing.mix(docs)
    rows = out.groupBy("target").agg(F.sum("taken").alias("taken"), F.max("copies").alias("most")).collect()
    assert len(rows) == 2 and all(abs(r["taken"] - r["target"]) <= 10 and r["most"] <= 3 for r in rows)
    again = mixing.apply_mix(docs)
    assert again.count() == out.agg(F.sum("copies")).first()[0]
    first = sorted(map(tuple, out.select("doc_id", "size", "copies").collect()), key=str)
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(7)).select("doc_id", "size", "copies").collect()), key=str)


def test_taken_words_come_near_the_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    out = mixing.mix(docs).join(docs.select(F.col("doc_id").alias("i"), "source"), F.col("doc_id") == F.col("i"))
    for r in out.groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) <= 0.03 * r["target"]


def test_many_secrets_in_one_text():
    scanner = secrets.Scanner(len)
    took = []
    for n in (2000, 16000):
        text = " ".join(f"token=abcdef{i} zz{i}" for i in range(n))
        start = time.process_time()
        base = scanner.base(text)
        assert len(base) == n and all(not any(a <= i and j <= b for a, _, b in base[:50]) for i, _, j in scanner.random(text, base)[:50])
        took.append(time.process_time() - start)
    assert took[1] < 40 * max(took[0], 0.01)
