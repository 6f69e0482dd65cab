"""Incremental URL-cache maintenance with Structured Streaming.

Fetch batches land as JSON-lines files of cache entries (url, status,
final_url, content_type, sha256, fetched_at, ord). The cache index is an
append-only log of those entries; readers take the latest entry per key
(``operators.fetch.latest_entries``), so "last write wins" holds without
rewriting the table in place. ``trigger(availableNow=True)`` processes every
landed batch and stops, with progress kept in a checkpoint under the shared
checkpoint folder, so a rerun after a failure resumes where it stopped.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.fetch import latest_entries
from corpusmill.session import checkpoint_dir

CACHE_ENTRY = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("final_url", T.StringType()), T.StructField("content_type", T.StringType()),
    T.StructField("sha256", T.StringType()), T.StructField("fetched_at", T.StringType()),
    T.StructField("ord", T.LongType()),
])


def ingest_cache_entries(spark: SparkSession, landing_dir: str, cache_log: str, name: str | None = None) -> None:
    """Append every newly landed entry file to the cache log (exactly once per
    file, tracked by the stream checkpoint) and return when caught up. Every
    pair of landing folder and log has a checkpoint of its own."""
    name = name or "cache_ingest_" + hashlib.sha1(f"{landing_dir}\n{cache_log}".encode()).hexdigest()[:16]
    ckpt = os.path.join(checkpoint_dir(spark), name)
    stream = spark.readStream.schema(CACHE_ENTRY).json(landing_dir)
    q = (stream.writeStream.format("parquet").option("path", cache_log).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def cache_index(spark: SparkSession, cache_log: str) -> DataFrame:
    """Current cache index: latest entry per trimmed URL."""
    return latest_entries(spark.read.schema(CACHE_ENTRY).parquet(cache_log))


def compact(spark: SparkSession, cache_log: str, snapshot: str) -> DataFrame:
    """Write the latest-per-key view as a new snapshot folder (the log itself is
    left untouched; point readers at the snapshot plus later log entries)."""
    idx = cache_index(spark, cache_log).drop("cache_key")
    idx.write.mode("errorifexists").parquet(snapshot)
    return spark.read.parquet(snapshot).select(F.col("url"), "status", "ord")
