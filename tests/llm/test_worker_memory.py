"""What a Python worker holds at once, and how many of them a task needs."""

import contextlib
import io
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.llm import bytewords, common, ngram_join


def test_staged_batches_are_small(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "m"])

    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit, None)
    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))
    spark.conf.set(limit, "10000")  # Spark's own
    try:
        big = common.stage(texts.mapInArrow(sizes, "n long, m long"), "test").agg(F.sum("n"), F.max("m")).first()
        many = common.stage(spark.range(0, 9000, 1, 1).mapInArrow(sizes, "n long, m long"), "test").agg(F.sum("n"), F.max("n")).first()
        assert spark.conf.get(limit) == "10000"
        spark.conf.set(limit, "300")  # smaller ones stay
        few = common.stage(spark.range(0, 900, 1, 1).mapInArrow(sizes, "n long, m long"), "test").agg(F.max("n")).first()
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
    assert big[0] == 3000 and big[1] < 5_000_000
    assert tuple(many) == (9000, 2000) and few[0] == 300


def test_words_of_a_large_batch():
    column = pa.array(["some words of a text " * 100] * 2000)  # 4 MB
    tracemalloc.start()
    words, offs = bytewords.WordHasher(bytewords.SPACED).words(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words.size == offs[-1] == 1_000_000
    assert peak < 60_000_000  # the words and their starts take 32 MB


def test_one_worker_for_a_task(spark):
    docs = spark.createDataFrame([(k, f"some {k} words of a text that has many") for k in range(20)], "doc_id long, text string")
    rows = ngram_join._signatures(docs, 5, 80, np.zeros(0, np.uint64))
    plans = [ngram_join._signatures(docs, 5, 80, np.zeros(0, np.uint64), common.member_bitmap(docs.filter("doc_id < 7"), "doc_id"))]
    assert {r["doc_id"] for r in plans[0].collect()} == set(range(7))  # 7 of 20 ids in 2^23 bits
    keyed = common.stage(rows, "test").withColumn("h", F.xxhash64("doc_id"))
    wanted = common.member_bitmap(docs.filter("doc_id < 7"), "doc_id")
    plans.append(ngram_join._postings(keyed, ngram_join._shared_bins(keyed, wanted), wanted))
    assert {r["g"] for r in plans[1].collect()} <= set(range(7))
    for x in plans:
        with contextlib.redirect_stdout(text := io.StringIO()):
            x.explain()
        assert text.getvalue().count("MapInArrow") == 1 and "ArrowEvalPython" not in text.getvalue()
