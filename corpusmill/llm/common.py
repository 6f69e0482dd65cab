"""Small helpers shared by the operators: tables, staged tables, id bitmaps."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import checkpoint_dir

BITMAP_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Shuffle files of a finished query go at once; nothing reads them after a staged write.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows and bytes sent to a Python worker at once. An executor's JVM and each of its
#: workers hold a batch or two outside the heap; 10 000 whole texts would be 20 MB and more.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


@contextmanager
def _settings(spark: SparkSession):
    """The session's settings while a staged table is written; smaller batches than
    these stay as they are."""
    before = {k: spark.conf.get(k, None) for k in (_CLEAN, *_BATCH)}
    spark.conf.set(_CLEAN, "true")
    for k, most in _BATCH.items():
        now = re.fullmatch(r"[1-9]\d*", before[k] or "")
        spark.conf.set(k, str(min(most, int(now[0])) if now else most))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back. Cuts lineage: a lost executor costs no recomputation of what came
    before, and the rows are the same however often they are read."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/corpusmill-{name}-{uuid.uuid4().hex}"
    with _settings(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*staged: DataFrame) -> None:
    """Removes staged tables that nothing reads any more."""
    for df in staged:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def member_bitmap(ids: DataFrame, col: str, bits: int = BITMAP_BITS, hashed: bool = False) -> np.ndarray:
    """Bitmap of hashed values of ``col`` with a fixed size (``bits`` / 8 bytes),
    whatever the number of ids. ``hashed``: the values are hashes already. A clear bit proves absence; a set bit is only a
    maybe, so the caller still joins exactly. It spares the shuffle of rows
    that cannot match; when very many ids fill it, it only filters less."""
    value = F.col(col).cast("long")
    h = F.pmod(value if hashed else F.xxhash64(value), F.lit(bits))
    words = (
        ids.select(h.alias("h"))
        .groupBy(F.floor(F.col("h") / 64).cast("int").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(h % 64 AS INT))")).alias("m"))
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for w, m in words.collect():  # at most bits / 64 rows
        out[w] = m
    return out.view(np.uint64)


def maybe_member(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """``hashes``: Spark's xxhash64 of the ids, as int64."""
    h = np.mod(hashes, np.int64(bitmap.size * 64)).astype(np.uint64)
    return (bitmap[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def split_by_membership(docs: DataFrame, key, ids: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is certainly not in ``ids.col``, the rest). ``key`` is
    a long column; only the rest needs an exact join, so whole texts are not
    shuffled to drop or change a few of them. ``docs`` is scanned for each part."""
    sent = docs.sparkSession.sparkContext.broadcast(member_bitmap(ids, col))

    def look(h: pd.Series) -> pd.Series:
        return pd.Series(maybe_member(sent.value, h.to_numpy()))

    maybe = F.pandas_udf(look, "boolean")(F.xxhash64(key))
    return docs.filter(~maybe), docs.filter(maybe)


def drop_by_id(docs: DataFrame, key, ids: DataFrame, col: str) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``ids.col``; null keys stay."""
    sure, rest = split_by_membership(docs, key, ids, col)
    gone = ids.select(F.col(col).alias("__gone"))
    left = rest.withColumn("__key", key)
    return sure.unionByName(left.join(gone, left["__key"] == gone["__gone"], "left_anti").select(*docs.columns))
