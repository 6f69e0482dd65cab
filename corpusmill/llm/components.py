"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import discard, stage

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool, held: list) -> DataFrame:
    """One star step. ``edges`` (u, v), u > v. The minimum of a node's
    neighbourhood is a map-side-combined aggregate; it is staged, so that the
    join back is between two plain exchanges and a hub's edges can be split."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = stage(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    held.append(least)
    if large:  # every larger neighbour points at the node's minimum
        out = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node and its smaller neighbours point at the minimum
        out = near.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.filter("m <> u").select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest
    node reachable. The graph stays in Spark; the driver sees one count and one
    checksum a round. Stops when a round changes nothing (all stars)."""
    e = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    before = None
    for _ in range(MAX_ROUNDS):
        held = [e]
        e = stage(_star(_star(e, True, held), False, held), "stars")
        discard(*held)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
