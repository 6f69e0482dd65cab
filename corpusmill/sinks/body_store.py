"""Content-addressed body store (SNK8, SRC13): put-if-absent by digest.

Layout: ``batch=<n>-<id>/`` holds one append's bodies (sha256, body), ``_digests/
batch=<n>-<id>/`` the digests it brought (sha256, length). An append deals its new
bodies by digest prefix, so one task writes one file for a range of prefixes, sorted
by digest, in one exchange. Its digests are written last: a batch without them is no
batch, so an append that dies half way leaves nothing a reader sees. Two appends at
the same time may both bring a body; readers take the one of the first batch by
name, and only such digests cost a join.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.files import path_exists

_DIGESTS = "batch string, sha256 string, length long"


def stored_digests(spark: SparkSession, store: str) -> DataFrame:
    """(batch, sha256, length) of every append that ended; empty without a store."""
    folder = f"{store.rstrip('/')}/_digests"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], _DIGESTS)
    return spark.read.schema("sha256 string, length long, batch string").parquet(folder).select("batch", "sha256", "length")


def append_bodies(bodies: DataFrame, store: str) -> None:
    """Append (sha256, body) rows whose digest the store has not got yet, one body
    a digest."""
    spark, root = bodies.sparkSession, store.rstrip("/")
    batch = f"batch={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    prefix = F.substring("sha256", 1, 2).alias("prefix")
    have = stored_digests(spark, store).select(prefix, "sha256", F.lit(None).cast(bodies.schema["body"].dataType).alias("body"), F.lit(True).alias("have"))
    offered = bodies.select(prefix, "sha256", "body", F.lit(False).alias("have")).unionByName(have)
    # dealt by prefix: grouping by (prefix, digest) and the write need no other exchange
    new = (
        offered.repartition("prefix").groupBy("prefix", "sha256")
        .agg(F.max("have").alias("have"), F.first("body", ignorenulls=True).alias("body"))
        .filter(~F.col("have")).select("sha256", "body")
    )
    new.sortWithinPartitions("sha256").write.mode("errorifexists").parquet(f"{root}/{batch}")
    digests = spark.read.schema(new.schema).parquet(f"{root}/{batch}").select("sha256", F.octet_length("body").cast("long").alias("length"))
    digests.write.mode("errorifexists").parquet(f"{root}/_digests/{batch}")


def read_body_store(spark: SparkSession, store: str) -> DataFrame:
    """(sha256, body), one row a digest, of every append that ended."""
    digests = stored_digests(spark, store)
    per = digests.groupBy("sha256").agg(F.min("batch").alias("batch"), F.count("*").alias("n"))
    twice = per.filter("n > 1").select(F.col("sha256").alias("_s"), F.col("batch").alias("_b"))
    ended = digests.select(F.col("batch").alias("_e")).distinct()
    bodies = spark.read.parquet(store) if path_exists(spark, f"{store.rstrip('/')}/_digests") else \
        spark.createDataFrame([], "sha256 string, body binary, batch string")
    bodies = bodies.join(F.broadcast(ended), F.col("batch") == F.col("_e"), "left_semi")  # a row an append
    return bodies.join(twice, F.col("sha256") == F.col("_s"), "left").filter(
        F.col("_b").isNull() | (F.col("_b") == F.col("batch"))).select("sha256", "body")


def body_text(body: Column) -> Column:
    """A stored body as text: UTF-8, other bytes become U+FFFD."""
    return F.make_valid_utf8(body.cast("binary").cast("string"))
