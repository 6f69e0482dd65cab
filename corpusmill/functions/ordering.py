"""Order keys packed into one DECIMAL(38,0) so that "best row" and "first
occurrence" aggregates stay hash aggregates (a struct key forces a sort-based
aggregate). Components must be non-negative longs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import col
from corpusmill.session import staged

DEC = "decimal(38,0)"
E19 = 10**19  # one non-negative long fits in 19 decimal digits
E31 = 10**31


def _d(v) -> Column:
    return F.lit(str(v)).cast(DEC)


def _nonneg(c: Column, what: str) -> Column:
    return F.when(c >= 0, c).otherwise(F.raise_error(F.lit(f"{what} must be a non-negative long")))


def best_key(prio, length, ord_) -> Column:
    """max() of this key = highest prio (0..9), then longest length
    (< 10**12), then smallest ordinal."""
    p, n, o = col(prio).cast("bigint"), col(length).cast("bigint"), col(ord_).cast("bigint")
    return (p.cast(DEC) * _d(E31) + n.cast(DEC) * _d(E19) + (_d(E19 - 1) - _nonneg(o, "ordinal").cast(DEC))).cast(DEC)


def ord_of_best(key) -> Column:
    return (_d(E19 - 1) - F.pmod(col(key), _d(E19))).cast("bigint")


def first_key(a, b=None) -> Column:
    """min() of this key = lexicographic first (a, b)."""
    a = _nonneg(col(a).cast("bigint"), "ordinal").cast(DEC)
    if b is None:
        return a
    return (a * _d(E19) + _nonneg(col(b).cast("bigint"), "ordinal").cast(DEC)).cast(DEC)


def numbered(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Adds ``name``: 1..n in the order of ``cols``. The rows are range-sorted
    and staged; one count a partition gives each partition's first number."""
    part = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    part = staged(part.withColumn("_p", F.spark_partition_id()).withColumn("_r", F.monotonically_increasing_id()), "numbered")
    counts = part.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_r").alias("_f"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_p", "_f", F.coalesce(before, F.lit(0)).alias("_b"))
    out = part.join(counts, "_p").withColumn(name, (F.col("_b") + F.col("_r") - F.col("_f") + 1).cast("bigint"))
    return out.drop("_p", "_r", "_f", "_b")


def split_first_key(key, two: bool):
    if not two:
        return [col(key).cast("bigint")]
    return [F.floor(col(key) / _d(E19)).cast("bigint"), F.pmod(col(key), _d(E19)).cast("bigint")]
