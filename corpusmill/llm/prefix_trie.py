"""Prefix trie of conversations, by a splitter skeleton.

Every conversation becomes a path: one 16-byte digest of (role, text) a turn,
joined to one binary, so that binary order is the trie's order and a node is a
prefix of 16 * depth bytes. Rows sorted by (path, conv_id) are cut into shards
by splitter rows. A node whose members lie in two shards is a prefix of the
splitter between them, so:

* the *skeleton*, the trie of all splitter paths, is broadcast (at most
  ``SKELETON_NODES`` nodes, whatever the data);
* every other node lies whole in one shard, where one pass over the sorted rows
  finishes it with a stack as deep as the conversation at hand;
* skeleton nodes get one partial aggregate from each shard that meets them; a
  grouped sum combines these, and the few skeleton nodes pass their subtree sums
  up to the root.

The ends of a skeleton node (a conversation that very many copies hold, say)
come as chunks of joined ids in order, and one pass over the sorted chunks
hashes them without holding them.

Defined results: rows without conv_id belong to no conversation; a null role or
text is empty; turns are ordered by turn (null first), equal turns by digest, and
repeated rows are turns of their own. An empty table has no nodes. Other columns
are ignored. A conversation travels as one row of 20 bytes a turn. Conversations
that agree in more turns than a splitter holds (``SKELETON_NODES`` / shards) are
not cut apart further: they stay right, in one shard.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

#: Bound of the broadcast skeleton: shards times the turns kept of a splitter.
SKELETON_NODES = 1 << 18
SHARD_BYTES = 64 << 20
MAX_SHARDS = 4096
SAMPLES_A_SHARD = 8
#: Ids of a skeleton node travel in chunks of this many characters.
CHUNK_CHARS = 1 << 16
SHARED_FROM = 20

_LEAST = -(1 << 63)
_WORD = r"[^\x20\x09-\x0D]+"

_SHARD_SCHEMA = (
    "kind int, sk int, shard int, seq int, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, words long, ends string"
)
_SHARD_ARROW = pa.schema([
    ("kind", pa.int32()), ("sk", pa.int32()), ("shard", pa.int32()), ("seq", pa.int32()), ("conv_id", pa.int64()),
    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("words", pa.int64()), ("ends", pa.string()),
])
_NODE, _PARTIAL, _ENDS = 0, 1, 2


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array<struct<turn, digest, words>>) in turn order; only
    digests and word counts of the texts are shuffled."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).alias("words"),
    )
    packed = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    return turns.groupBy("conv_id").agg(packed.alias("turns"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Conversation c as the first h turns of conversation c - c % 20, then its
    own turns after the first h; h is crc32(c) % 4."""
    heads = paths.filter(F.col("conv_id") % SHARED_FROM == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, 3).alias("head")
    )
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4)).cast("int")
    own = paths.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % SHARED_FROM)
    met = own.join(heads, F.col("base") == F.col("head_id"), "left")
    none = F.slice("turns", 1, 0)
    return met.select(
        "conv_id",
        F.concat(
            F.coalesce(F.expr("slice(head, 1, h)"), none),
            F.expr("slice(turns, h + 1, size(turns))"),
        ).alias("turns"),
    )


def _splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Up to shards - 1 (path, conv_id) rows from a bounded sample: the rows of
    least hashed id. Longer paths are cut to the turns a splitter may hold."""
    keep = 16 * max(1, SKELETON_NODES // shards)
    rows = (
        paths.select("conv_id", F.substring("path", 1, keep + 1).alias("p"))
        .orderBy(F.xxhash64("conv_id"), "conv_id")
        .limit(SAMPLES_A_SHARD * shards)
        .collect()
    )
    keys = sorted((bytes(r.p), r.conv_id) if len(r.p) <= keep else (bytes(r.p[:keep]), _LEAST) for r in rows)
    picked = [keys[len(keys) * i // shards] for i in range(1, shards)] if keys else []
    return sorted(set(picked))


def _skeleton(splitters) -> dict[tuple[int, bytes], int]:
    """(parent's number, digest) -> number; the root is 0."""
    nodes: dict[tuple[int, bytes], int] = {}
    for path, _ in splitters:
        at = 0
        for i in range(0, len(path), 16):
            at = nodes.setdefault((at, path[i : i + 16]), len(nodes) + 1)
    return nodes


class _Shard:
    """One pass over a shard's rows in (path, conv_id) order."""

    def __init__(self, shard: int, skeleton):
        self.shard, self.skeleton = shard, skeleton
        self.path, self.out = b"", []
        self.stack = [self._frame(0, 0, 0)]

    def _frame(self, depth, words, sk):
        return {"depth": depth, "words": words, "sk": sk, "n": 0, "least": None, "children": 0, "leaves": 0,
                "saved": 0, "ends": hashlib.sha256() if sk is None else [], "any": False, "chars": 0, "seq": 0,
                "waiting": []}

    def add(self, path: bytes, conv_id: int, words) -> None:
        common, limit = 0, min(len(path), len(self.path))
        while common < limit and path[common : common + 16] == self.path[common : common + 16]:
            common += 16
        while len(self.stack) > common // 16 + 1:
            self._close()
        for i in range(common, len(path), 16):
            above = self.stack[-1]["sk"]
            sk = None if above is None else self.skeleton.get((above, path[i : i + 16]))
            self.stack.append(self._frame(i // 16 + 1, int(words[i // 16]), sk))
        self.path = path
        top = self.stack[-1]
        top["n"] += 1
        top["least"] = conv_id if top["least"] is None else min(top["least"], conv_id)
        if top["sk"] is None:
            top["ends"].update((b"," if top["any"] else b"") + str(conv_id).encode())
        else:
            top["ends"].append(str(conv_id))
            top["chars"] += len(top["ends"][-1]) + 1
            if top["chars"] >= CHUNK_CHARS:
                self._chunk(top)
        top["any"] = True

    def _chunk(self, f) -> None:
        if f["ends"]:
            self.out.append((_ENDS, f["sk"], self.shard, f["seq"], *[None] * 8, ",".join(f["ends"])))
            f["ends"], f["chars"], f["seq"] = [], 0, f["seq"] + 1

    def _close(self) -> None:
        f = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above["n"] += f["n"]
            above["least"] = f["least"] if above["least"] is None else min(above["least"], f["least"])
        if f["sk"] is not None:
            self._chunk(f)
            self.out.append((_PARTIAL, f["sk"], self.shard, None, f["least"], f["depth"], None, f["n"],
                             f["children"], f["leaves"], f["saved"], f["words"], None))
            return
        leaves = f["leaves"] or 1
        saved = f["saved"] + (f["n"] - 1) * f["words"]
        self.out.extend((*row[:6], f["least"], *row[7:]) for row in f["waiting"])
        row = (_NODE, None, None, None, f["least"], f["depth"], None, f["n"], f["children"], leaves, saved, None,
               f["ends"].hexdigest())
        if above["sk"] is None:
            above["waiting"].append(row)  # its parent's least member is not known yet
        else:
            self.out.append((_NODE, above["sk"], *row[2:]))
        above["children"] += 1
        above["leaves"] += leaves
        above["saved"] += saved

    def end(self) -> None:
        while self.stack:
            self._close()


def _batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _SHARD_ARROW)], schema=_SHARD_ARROW)


def _finish_shards(skeleton):
    def run(batches):
        now = None
        for b in batches:
            columns = (b.column(n).to_pylist() for n in ("shard", "path", "conv_id", "words"))
            for shard, path, conv_id, words in zip(*columns):
                if now is None or now.shard != shard:
                    if now is not None:
                        now.end()
                        yield _batch(now.out)
                    now = _Shard(shard, skeleton.value)
                now.add(path, conv_id, words)
                if len(now.out) >= 10_000:
                    yield _batch(now.out)
                    now.out = []
        if now is not None:
            now.end()
            yield _batch(now.out)

    return run


def _hash_chunks(batches):
    """(sk, sha256 of its chunks joined by commas) of rows in (sk, shard, seq) order."""
    at, state = None, None
    schema = pa.schema([("sk", pa.int32()), ("ends_sha256", pa.string())])

    def row():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([state.hexdigest()])], schema=schema)

    for b in batches:
        for sk, text in zip(b.column("sk").to_pylist(), b.column("ends").to_pylist()):
            if sk != at:
                if at is not None:
                    yield row()
                at, state = sk, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if at is not None:
        yield row()


def _roll_up(partials, parent_of: dict[int, int]) -> list[tuple]:
    """Skeleton nodes with their subtree sums: (sk, conv_id, depth, parent's
    conv_id, n_convs, n_children, n_leaves, saved). ``partials`` holds one summed
    row for each skeleton node that has members."""
    by = {r.sk: r for r in partials}
    children = dict.fromkeys(by, 0)
    for sk in by:
        if sk:
            children[parent_of[sk]] += 1
    leaves = {sk: r.n_leaves for sk, r in by.items()}
    saved = {sk: r.saved for sk, r in by.items()}
    out = []
    for r in sorted(partials, key=lambda r: -r.depth):
        n_children = r.n_children + children[r.sk]
        leaves[r.sk] += 0 if n_children else 1
        saved[r.sk] += (r.n_convs - 1) * r.words
        above = parent_of.get(r.sk)
        if above is not None:
            leaves[above] += leaves[r.sk]
            saved[above] += saved[r.sk]
        out.append((r.sk, r.conv_id, r.depth, by[above].conv_id if above is not None else None, r.n_convs, n_children,
                    leaves[r.sk], saved[r.sk]))
    return out


def trie_nodes(turn_lists: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of ``turn_lists`` (conv_id, turns): conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    spark = turn_lists.sparkSession
    paths = stage(
        turn_lists.select(
            "conv_id",
            F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("path"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
        ),
        "paths",
    )
    if shards is None:
        size = paths.agg(F.coalesce(F.sum(F.length("path") + 24), F.lit(0))).first()[0]
        asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = min(MAX_SHARDS, max(asked, -(-size // SHARD_BYTES)))
    splitters = _splitters(paths, shards)
    nodes = _skeleton(splitters)
    cuts, skeleton = spark.sparkContext.broadcast(splitters), spark.sparkContext.broadcast(nodes)

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts.value, (bytes(p), c)) for p, c in zip(path, conv_id)], dtype="int32")

    dealt = paths.withColumn("shard", shard_of("path", "conv_id")).repartitionById(shards, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", "path", "conv_id").select("shard", "path", "conv_id", "words")
    parts = stage(dealt.mapInArrow(_finish_shards(skeleton), _SHARD_SCHEMA), "trie")

    partials = (
        parts.filter(F.col("kind") == _PARTIAL)
        .groupBy("sk")
        .agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
             F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"),
             F.max("words").alias("words"))
        .collect()  # at most SKELETON_NODES + 1 rows
    )
    top = spark.createDataFrame(
        _roll_up(partials, {number: above for (above, _), number in nodes.items()}),
        "sk int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long",
    )
    chunks = parts.filter(F.col("kind") == _ENDS).select("sk", "shard", "seq", "ends")
    ends = (
        chunks.repartition("sk").sortWithinPartitions("sk", "shard", "seq")
        .mapInArrow(_hash_chunks, "sk int, ends_sha256 string")
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    top_rows = top.join(F.broadcast(ends), "sk", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    above = top.select(F.col("sk").alias("up"), F.col("conv_id").alias("up_conv_id"))
    local = parts.filter(F.col("kind") == _NODE)
    local_rows = local.join(F.broadcast(above), F.col("sk") == F.col("up"), "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up_conv_id").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
    return local_rows.unionByName(top_rows)


def conversation_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """The trie of all rebuilt conversations (see ``rebuilt``)."""
    return trie_nodes(rebuilt(conversation_paths(conversations)), shards)
