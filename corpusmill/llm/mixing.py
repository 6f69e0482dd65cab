"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its weight's share of all words, at most ``cap`` times its
own size; what is cut off goes to the others by weight until none is above.
Every document of a source then has the same fractional number of copies,
target / size of the source. The whole part is taken as it is; the fractions
are rounded pairwise: two documents move probability mass between them, the
words they expect together unchanged, until one of them is 0 or 1. Long documents
are settled first, then shorter ones: what the last open document of a tier misses
or takes too much (nothing, in expectation) is dealt evenly over the fractions of the
next tier. So each document is rounded up with its fraction's probability, and a
source's taken words differ from its target by less than the longest document of
its last tier, as long as the shorter ones can take up the difference.

The pairing is a reduction tree over hash cells. Documents are dealt to cells
of about ``CELL`` by a hash of their content; a task settles a cell and hands on
at most one unsettled document, and cells of the next level gather those of
``FAN`` cells. Equal rows are one entry with their number: the whole part of what
they expect together is certain, the rest is one fraction. No task holds a source or
a group of equal rows, and the driver holds nothing but the number of rows. Random numbers are hashes of (seed, level, cell, order), so
reruns agree whatever the partitioning.

Defined results: null or blank texts have size 0 and are taken 0 times; null
is a source of its own, ranked last; rows that repeat a doc_id are documents of
their own, told apart by content, and equal rows are interchangeable. Extra
columns are ignored, or kept where documents are returned.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusmill.llm.common import stage

WEIGHTS = (5, 2, 1)  # of the sources in code-point order, repeating
CAP = 3
CELL, FAN = 512, 512
SEED = 20240229
#: A tier holds the documents longer than so many times their source's mean.
TIERS = (1.0, 0.125, 0.0)
#: Equal rows are told apart in so many chunks.
CHUNKS = 64
_EPS = 1e-9


def word_count(text="text"):
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size) rows. The targets are
    min(cap * size, level * weight) for the level at which they add up to all
    words: sources sorted by the level at which they reach their cap give it in
    one pass of running sums. Windows run over one row for each source."""
    s = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int")))
    s = s.withColumn("top", F.lit(float(cap)) * F.col("source_size"))
    order = [(F.col("top") / F.col("w")).asc(), F.col("source").asc_nulls_last()]
    upto = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rest = W.orderBy(*order).rowsBetween(W.currentRow, W.unboundedFollowing)
    every = W.partitionBy(F.lit(1))
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(upto), F.lit(0.0))) / F.sum("w").over(rest))
    s = s.withColumn("fits", F.col("level") * F.col("w") <= F.col("top"))
    s = s.withColumn("level", F.min_by(F.when(F.col("fits"), F.col("level")), F.when(F.col("fits"), F.col("top") / F.col("w"))).over(every))
    return s.select("source", "source_size", F.least("top", F.coalesce(F.col("level") * F.col("w"), F.col("top"))).alias("target"))


def _unit(keys: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys."""
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def _pivot(sizes, p, u):
    """Settle a cell in order. Returns the rounded values (-1 for the one still
    open) and the open document's fraction."""
    out = np.full(len(p), -1, dtype=np.int64)
    open_at, q = -1, 0.0
    for i in range(len(p)):
        a = p[i]
        if a <= _EPS or a >= 1 - _EPS:
            out[i] = round(a)
            continue
        if open_at < 0:
            open_at, q = i, a
            continue
        s, t = sizes[open_at], sizes[i]
        # words one may gain and the other lose before a bound is met
        up = min((1 - q) * s, a * t)
        down = min(q * s, (1 - a) * t)
        if u[i] * (up + down) < down:
            q, a = q + up / s, a - up / t
        else:
            q, a = q - down / s, a + down / t
        q_done, a_done = q <= _EPS or q >= 1 - _EPS, a <= _EPS or a >= 1 - _EPS
        if q_done:
            out[open_at] = round(q)
            open_at, q = (-1, 0.0) if a_done else (i, a)
            if a_done:
                out[i] = round(a)
        elif a_done:
            out[i] = round(a)
    return out, open_at, q


def _settle(rows: DataFrame, last: bool, level: int) -> DataFrame:
    """One level of the tree: (sid, cell, h, id, size, p, up); up is null for
    the document a cell hands on."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "id", "size"], kind="mergesort").reset_index(drop=True)
        keys = pdf["h"].to_numpy(np.int64).astype(np.uint64) + np.uint64(SEED + 7919 * level) + np.arange(len(pdf), dtype=np.uint64)
        u = _unit(keys)
        out, open_at, q = _pivot(pdf["size"].to_numpy(float), pdf["p"].to_numpy(float), u)
        if last and open_at >= 0:
            out[open_at] = int(_unit(keys[open_at : open_at + 1] ^ np.uint64(0x5DEECE66D))[0] < q)
        pdf["up"] = pd.array([None if x < 0 else int(x) for x in out], dtype="Int64")
        if open_at >= 0:
            pdf.loc[open_at, "p"] = q
        return pdf

    return rows.groupBy("sid", "cell").applyInPandas(run, StructType([*rows.schema.fields, StructField("up", LongType())]))


def _round(todo: DataFrame) -> DataFrame:
    """(sid, h, id, up) of the entries (sid, h, id, size, p): the reduction tree."""
    cells = max(1, math.ceil(todo.count() / CELL))
    todo = todo.select("sid", F.pmod("h", F.lit(cells)).alias("cell"), "h", "id", "size", "p")
    done, level = None, 0
    while True:
        out = stage(_settle(todo, cells == 1, level), "settled")
        part = out.filter("up IS NOT NULL").select("sid", "h", "id", "up")
        done = part if done is None else done.unionByName(part)
        if cells == 1:
            return done
        cells, level = math.ceil(cells / FAN), level + 1
        todo = out.filter("up IS NULL").drop("up").withColumn("cell", F.floor(F.col("cell") / FAN).cast("long"))


def _numbered(rows: DataFrame, keys: list[str], chunk: str) -> DataFrame:
    """``rows`` with ``nth``, from 1, among the rows equal in ``keys``; ``chunk`` is a
    stored number below CHUNKS that parts a large group."""
    counts = rows.groupBy(*keys, chunk).agg(F.count("*").alias("n"))
    upto = W.partitionBy(*keys).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*[F.col(c).alias(f"{c}_") for c in (*keys, chunk)], F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy(*keys, chunk).orderBy(F.lit(0)))
    met = rows.withColumn("nth", rank).join(counts, [F.col(c) == F.col(f"{c}_") for c in (*keys, chunk)])
    return met.withColumn("nth", F.col("nth") + F.col("before")).drop("before", *[f"{c}_" for c in (*keys, chunk)])


def _chunk():
    return F.pmod(F.monotonically_increasing_id(), F.lit(CHUNKS)).cast("int")


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken, h), one row for each
    document row; h is a hash of its content."""
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"),
        F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")).alias("h"),
        _chunk().alias("chunk"),
    )
    base = stage(base, "sizes")
    goals = stage(source_targets(base, weights, cap), "targets")
    same = F.col("source").eqNullSafe(F.col("source_"))
    rate = base.join(goals.withColumnRenamed("source", "source_"), same, "left").drop("source_")
    rate = rate.withColumn("f", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rate = rate.withColumn("whole", F.least(F.floor(F.col("f") + _EPS), F.lit(cap))).withColumn(
        "p", F.greatest(F.col("f") - F.col("whole"), F.lit(0.0)))
    rate = stage(rate.withColumn("id", F.coalesce("doc_id", F.lit(-1))), "rates")
    entries = rate.filter((F.col("size") > 0) & (F.col("p") > _EPS)).groupBy(
        F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()).alias("sid"), "h", "id", "size", "p").agg(F.count("*").alias("m"))
    entries = stage(entries, "entries")
    words = F.col("m") * F.col("size")
    means = stage(entries.groupBy("sid").agg((F.sum(words) / F.sum("m")).alias("mean")), "means")
    entries = stage(entries.join(means, "sid"), "tiers")
    ups = owed = None  # words expected so far and not taken, by source
    for tier, least in enumerate(TIERS):
        inside = F.col("size") > F.lit(least) * F.col("mean")
        if tier:
            inside &= F.col("size") <= F.lit(TIERS[tier - 1]) * F.col("mean")
        part = entries.filter(inside).drop("mean")
        if owed is not None:
            share = part.groupBy("sid").agg(F.sum(words).alias("held")).join(owed, "sid").select("sid", (F.col("owed") / F.col("held")).alias("shift"))
            part = part.join(share, "sid", "left").withColumn("q", F.col("p") + F.coalesce("shift", F.lit(0.0))).withColumn(
                "q", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "q"))).drop("shift")
        else:
            part = part.withColumn("q", F.col("p"))
        part = part.withColumn("sure", F.floor(F.col("m") * F.col("q") + _EPS)).withColumn("rest", F.greatest(F.lit(0.0), F.col("m") * F.col("q") - F.col("sure")))
        part = stage(part, "tier")
        done = _round(part.select("sid", "h", "id", "size", F.col("rest").alias("p")))
        got = part.join(done, ["sid", "h", "id"], "left").select(
            "sid", "h", "id", "size", "p", "m", (F.col("sure") + F.coalesce("up", F.lit(0))).cast("long").alias("ups"))
        got = stage(got, "rounded")
        missed = got.groupBy("sid").agg(F.sum((F.col("m") * F.col("p") - F.col("ups")) * F.col("size")).alias("owed"))
        owed = stage((missed if owed is None else missed.unionByName(owed)).groupBy("sid").agg(F.sum("owed").alias("owed")), "owed")
        ups = got if ups is None else ups.unionByName(got)
    ups = stage(ups.select("h", "id", "ups", F.col("m").alias("of")), "ups")
    # equal rows share a key: as many of them go up as their entry says
    merged = rate.join(ups, ["h", "id"], "left")
    alone = merged.filter("of IS NULL OR ups = 0 OR ups = of").withColumn("up", F.when(F.col("ups") > 0, 1).otherwise(0).cast("long"))
    several = merged.filter("ups > 0 AND ups < of")
    several = _numbered(several, ["h", "id"], "chunk").withColumn("up", (F.col("nth") <= F.col("ups")).cast("long")).drop("nth")
    out = alone.unionByName(several)
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.col("up")).otherwise(0).cast("long"))
    return out.select("doc_id", "size", F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"), "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"), "h")


def apply_mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mixed documents: each row as often as its copies, all columns as they
    came. Rows equal in (doc_id, source, text) share out their copies evenly."""
    key = F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    taken = mix(docs, weights, cap).groupBy("h").agg(F.sum("copies").alias("__mix_c"), F.count("*").alias("__mix_n"))
    taken = stage(taken.filter("__mix_c > 0"), "copies").withColumnRenamed("h", "__mix_h")
    rows = docs.withColumn("__mix_h", key).join(taken, "__mix_h")
    one = rows.filter("__mix_n = 1").withColumn("__mix_k", F.col("__mix_c"))
    few = stage(rows.filter("__mix_n > 1").withColumn("__mix_chunk", _chunk()), "equal-rows")
    few = _numbered(few, ["__mix_h"], "__mix_chunk").withColumn(
        "__mix_k", F.floor(F.col("__mix_c") / F.col("__mix_n")) + (F.col("nth") <= F.col("__mix_c") % F.col("__mix_n")).cast("long")).drop("nth", "__mix_chunk")
    every = one.unionByName(few).filter("__mix_k > 0")
    return every.withColumn("__mix_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_k")))).select(*docs.columns)
