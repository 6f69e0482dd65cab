"""The URL cache as a log of batches with compaction (JOIN2/3, WIN4).

A cache log is a folder of deltas, one per append, and at most one base in force:
the latest entry of every URL up to some delta. A base lies in ``base=<n>-<id>/``,
dealt by URL hash and sorted, with ``_bases/<n>-<id>/`` naming the deltas it
holds, written last: a base without it is no base. Readers take the newest base and
the deltas it does not hold; nothing is changed in place, so a reader at work keeps
its files. ``append`` rewrites the base once the deltas outgrow ``COMPACT_RATIO`` of
it (or ``MAX_DELTAS`` have come), which keeps a lookup at one base and few deltas
however many batches have run, and the cost of compaction proportional to the log.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusmill.operators.fetch import latest_entries

COMPACT_RATIO = 0.5
MAX_DELTAS = 32


def _names(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder with the bytes below each."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    return {s.getPath().getName(): fs.getContentSummary(s.getPath()).getLength() for s in fs.listStatus(path)}


def _state(spark: SparkSession, log: str) -> tuple[str | None, dict[str, int], int]:
    """(base in force, deltas it does not hold with their bytes, bytes of the base)."""
    log = log.rstrip("/")
    names = _names(spark, log)
    bases = sorted(b for b in _names(spark, f"{log}/_bases") if f"base={b}" in names)
    # one delta is a folder of an append, or a file that another writer put in the log
    deltas = {n: size for n, size in names.items() if n.startswith("delta=") or n.endswith(".parquet")}
    if not bases:
        return None, deltas, 0
    held = {r.name for r in spark.read.schema("name string").json(f"{log}/_bases/{bases[-1]}").collect()}
    return f"base={bases[-1]}", {n: s for n, s in deltas.items() if n not in held}, names[f"base={bases[-1]}"]


def read(spark: SparkSession, log: str) -> DataFrame:
    """Entries of the base and of the deltas behind it (the latest per URL wins, see
    ``operators.fetch.latest_entries``). Deltas may have columns of their own."""
    base, deltas, _ = _state(spark, log)
    parts = ([base] if base else []) + sorted(deltas)
    if not parts:
        raise FileNotFoundError(f"no cache entries in {log}")
    return spark.read.option("mergeSchema", True).parquet(*[f"{log.rstrip('/')}/{p}" for p in parts])


def compact(spark: SparkSession, log: str) -> None:
    """Writes a new base from the base in force and all deltas behind it."""
    base, deltas, _ = _state(spark, log)
    if not deltas:
        return
    log, name = log.rstrip("/"), f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    latest = latest_entries(read(spark, log)).drop("cache_key")
    latest.sortWithinPartitions("url").write.mode("errorifexists").parquet(f"{log}/base={name}")
    held = set(deltas)
    if base:
        held |= {r.name for r in spark.read.schema("name string").json(f"{log}/_bases/{base[len('base='):]}").collect()}
    spark.createDataFrame([(n,) for n in sorted(held)], "name string").coalesce(1).write.json(f"{log}/_bases/{name}")


def append(entries: DataFrame, log: str) -> None:
    """One delta; then a new base if the deltas have outgrown the old one."""
    spark = entries.sparkSession
    entries.coalesce(64).write.mode("errorifexists").parquet(
        f"{log.rstrip('/')}/delta={time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    _, deltas, size = _state(spark, log)
    if len(deltas) >= MAX_DELTAS or (size and sum(deltas.values()) > COMPACT_RATIO * size):
        compact(spark, log)
