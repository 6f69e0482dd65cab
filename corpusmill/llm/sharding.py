"""Sharding through fixed virtual slots, DataFrame functions only.

A record's slot is a hash of its doc_id modulo a fixed number of slots
(thousands), which never changes. Bytes are summed for each slot. A versioned
map (version, slot, shard, bytes) says where slots live: version 1 deals them
out evenly by number; a rebalancing copies the map under the next version and
edits it, so that only the edited slots move. Law ``bytes``: rebalancing moves
slots until the shards' sizes are near equal.

Positions in a shard (gapless from 0) are the running count inside the record's
virtual slot plus the rows of the shard's slots before it, so that no task sorts
a shard. Equal rows are counted before the shuffle and spread out again after.

Defined results: null text has no bytes (size 1) and crc32 0; rows with null
doc_id are hashed by their text instead; rows that repeat a doc_id share its
slot. Extra columns are ignored. An empty table gives an empty result and a map
with zero bytes.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

#: Equal rows written out by one step.
CHUNK = 10_000
SLOTS = 8192
SHARDS = 16


def slot_of(doc_id, text_crc32, slots: int = SLOTS):
    key = F.when(doc_id.isNull(), F.xxhash64(F.lit(23), text_crc32)).otherwise(F.xxhash64(F.lit(17), doc_id))
    return F.pmod(key, F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                      F.crc32(text).alias("text_crc32"))
    return out.withColumn("vslot", slot_of(F.col("doc_id"), F.col("text_crc32"), slots))


def slot_usage(recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(slot, bytes, n) of all slots, empty ones too; ``recs`` count equal rows in m."""
    every = recs.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    seen = recs.groupBy(F.col("vslot").alias("slot")).agg(F.sum(F.col("size") * F.col("m")).alias("bytes"), F.sum("m").alias("n"))
    return every.join(seen, "slot", "left").na.fill(0, ["bytes", "n"])


def _as_frame(spark: SparkSession, version: int, shard: list[int], size: list[int]) -> DataFrame:
    slots = F.posexplode(F.arrays_zip(F.lit(shard).alias("shard"), F.lit(size).alias("bytes"))).alias("slot", "x")
    return spark.range(1).select(F.lit(version).alias("version"), slots).select(
        "version", "slot", F.col("x.shard").cast("int").alias("shard"), F.col("x.bytes").cast("long").alias("bytes"))


def initial_map(usage: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1: slots dealt to shards in turn."""
    return usage.select(F.lit(1).alias("version"), "slot", (F.col("slot") % shards).cast("int").alias("shard"), "bytes")


def rebalance(slot_map: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The map's next version, for ``shards`` shards. Slots stay where they are
    as long as their shard stays within the mean; the rest go, largest first, to
    the shard with the fewest bytes. The map has a fixed number of rows."""
    rows = sorted(slot_map.select("slot", "shard", "bytes", "version").collect())
    mean = sum(r[2] for r in rows) / shards
    load, shard, loose = [0] * shards, [0] * len(rows), []
    for slot, s, size, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
        if s < shards and load[s] + size <= 0.9 * mean:  # the smallest slots stay free to level the shards
            load[s] += size
            shard[slot] = s
        else:
            loose.append((slot, size))
    heap = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(heap)
    for slot, size in loose:
        b, s = heapq.heappop(heap)
        shard[slot] = s
        heapq.heappush(heap, (b + size, s))
    return _as_frame(slot_map.sparkSession, max((r[3] for r in rows), default=0) + 1, shard, [r[2] for r in rows])


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot,
    map_version), one row for each document row."""
    recs = stage(records(docs, slots).groupBy("doc_id", "size", "text_crc32", "vslot").agg(F.count("*").alias("m")), "records")
    usage = stage(slot_usage(recs, slots), "usage")
    stored = stage(rebalance(initial_map(usage, shards), shards), "slot-map")
    before = W.partitionBy("shard").orderBy("vslot").rowsBetween(W.unboundedPreceding, -1)
    places = stored.join(usage.select("slot", "n"), "slot").select(
        F.col("slot").alias("vslot"), "shard", F.col("version").alias("map_version"), "n")
    places = stage(places.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long")), "places")
    inside = W.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size").rowsBetween(W.unboundedPreceding, -1)
    put = recs.withColumn("at", F.coalesce(F.sum("m").over(inside), F.lit(0)).cast("long")).join(places.drop("n"), "vslot")
    first = F.col("base") + F.col("at")
    # equal rows come as a count: runs of CHUNK are dealt out, then written out
    put = put.withColumn("first", first).withColumn("to", first + F.col("m")).drop("m", "at", "base")
    put = stage(put, "runs")
    few, many = put.filter(F.col("to") - F.col("first") <= CHUNK), put.filter(F.col("to") - F.col("first") > CHUNK)
    # (first level of runs, for counts beyond CHUNK * CHUNK)
    wide = F.lit(CHUNK * CHUNK).cast("long")
    for size in (wide, F.lit(CHUNK).cast("long")):
        many = many.withColumn("first", F.explode(F.sequence(F.col("first"), F.col("to") - 1, size)))
        many = many.withColumn("to", F.least(F.col("to"), F.col("first") + size)).repartition(F.col("first"))
    put = few.unionByName(many).withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("to") - 1)))
    return put.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "vslot", "map_version")

