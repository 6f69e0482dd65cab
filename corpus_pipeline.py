"""A corpus pipeline over ``documents``: quality, near duplicates, benchmark
passages, mixing, sharding. Each stage takes (spark, docs, sf_dir) and returns
the documents that go on; the last returns where each document lies.

1. quality: documents that the classifier rejects go.
2. near_duplicates: of each group of near copies the smallest doc_id stays.
3. decontaminate: documents that hold a benchmark window go.
4. mix: each document stays as often as the mixture takes it.
5. shard: shard, position, size and slot of every copy.

Defined results: an empty table gives an empty result. A null or empty text has no
words: the classifier scores it like any other, it is near no other text, holds no
benchmark window, and the mixture takes it 0 times. Rows without doc_id belong to no
group of copies and stay; rows that repeat a doc_id are one document in stage 2 and
rows of their own elsewhere. Ties go to the smaller doc_id. Extra columns stay up to
stage 4, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.common import stage, table
from corpusmill.llm.decontaminate import drop_contaminated
from corpusmill.llm.mixing import apply_mix
from corpusmill.llm.ngram_join import keep_one_per_group
from corpusmill.llm.quality import keep_good
from corpusmill.llm.sharding import shard_documents

#: The mixing is a random rounding and the classifier a numeric fit: no SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_per_group(docs, 5, 80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return apply_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
