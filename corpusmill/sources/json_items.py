"""Large whole-file JSON documents, read in splits.

Spark's text reader cuts a file behind every ``}`` instead of every line end, so a
document of any size comes in ordinary input splits, from any file system. Whether
a split begins inside a string, and how deep, depends on all text before it. Two
narrow passes settle that without moving text:

1. every split is scanned once for both cases (begins outside / inside a string):
   where it ends up and how the depth changes. One row a split.
2. the rows of a file are chained, so each split knows its true start, and a second
   scan cuts its text at the commas that separate items.

A piece that crosses a split border is put together from its parts afterwards; only
these first and last pieces of splits are shuffled. The result is staged: pieces and
numbers no longer depend on how the file was split.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.session import staged
from corpusmill.sources.files import MAX_BROADCAST_BYTES, file_path

_BLOCK = "file string, block long, n long, bytes long, size long, first string, out_in int, out_depth long, in_in int, in_depth long"
_START = "file string, block long, inside int, depth long, last boolean, closed boolean, sound boolean, first string"
_PIECE = "file string, block long, cuts long, members long, begins boolean, edge boolean, level int, text string"


def _scan_blocks():
    """One row a split: its ends for both starts."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("size", pa.int64()),
                        ("first", pa.string()), ("out_in", pa.int32()), ("out_depth", pa.int64()), ("in_in", pa.int32()),
                        ("in_depth", pa.int64())])
    escape = re.compile(r"\\.", re.S)

    def depth_change(text):
        return text.count("[") + text.count("{") - text.count("]") - text.count("}")

    def run(batches):
        at, state = None, None

        def row():
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, (*at, *state)))], schema=schema)

        for b in batches:
            for file, block, size, value in zip(*(c.to_pylist() for c in b.columns)):
                if at != (file, block):
                    if at is not None:
                        yield row()
                    at, state = (file, block), [0, 0, size, value.lstrip("\ufeff \t\r\n")[:1], 0, 0, 1, 0]
                parts = escape.sub("", value).split('"')
                even, odd = depth_change("".join(parts[0::2])), depth_change("".join(parts[1::2]))
                state[0] += 1
                state[1] += len(value.encode()) + 1
                for k in (4, 6):  # begun outside, begun inside
                    state[k + 1] += odd if state[k] else even
                    state[k] ^= (len(parts) - 1) & 1
                    state[k + 1] -= not state[k]  # the closing brace behind the text
        if at is not None:
            yield row()

    return run


def _chain():
    """The true start of every split of one file, in file order."""

    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        inside, depth, out = 0, 0, []
        for b in blocks.itertuples():
            out.append([b.file, b.block, inside, depth])
            depth += b.in_depth if inside else b.out_depth
            inside = b.in_in if inside else b.out_in
        # the reader says not whether the last piece ended in a brace; the file's size does
        # (a byte order mark is skipped; a compressed file's size says nothing, its balance does)
        missing = int(blocks["bytes"].sum()) - int(blocks["size"].iloc[0])
        closed = missing in (0, -3) or (missing not in (1, -2) and not inside and depth == 0)
        if not closed and not inside:
            depth += 1
        frame = pd.DataFrame(out, columns=["file", "block", "inside", "depth"])
        return frame.assign(last=frame["block"] == frame["block"].max(), closed=closed, sound=not inside and depth == 0,
                            first=blocks["first"].iloc[0])

    return run


def _cut_blocks(level: int):
    """Pieces of every split, cut behind commas at most ``level`` deep. ``cuts`` and
    ``members`` count the split's cuts, and those at depth 1, before the piece;
    ``begins`` says whether the piece follows such a cut or the document's start (null
    for a split's first piece, which goes on); ``edge`` marks the first and last."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("cuts", pa.int64()), ("members", pa.int64()),
                        ("begins", pa.bool_()), ("edge", pa.bool_()), ("level", pa.int32()), ("text", pa.string())])
    mark = re.compile(r'\\.|["\[\]{},]', re.S)

    class Split:
        def __init__(self, row):
            self.file, self.block, self.inside, self.depth, self.last, self.closed = row
            self.held, self.cuts, self.out, self.text = [], 0, [], None
            self.members, self.begins = 0, True if self.block == 0 else None

        def add(self, text):
            start = 0
            for m in mark.finditer(text):
                c = m.group()
                if c == '"':
                    self.inside = not self.inside
                elif self.inside or len(c) > 1:
                    continue
                elif c in "[{":
                    self.depth += 1
                elif c in "]}":
                    self.depth -= 1
                elif self.depth <= level:
                    self.held.append(text[start : m.start()])
                    self.flush(self.depth)
                    start = m.end()
            self.held.append(text[start:])

        def flush(self, depth):
            edge = self.cuts == 0 or depth is None
            self.out.append((self.file, self.block, self.cuts, self.members, self.begins, edge, depth, "".join(self.held)))
            self.held, self.cuts, self.begins = [], self.cuts + 1, depth == 1
            self.members += depth == 1

        def end(self):
            if self.text is not None:
                self.add(self.text + ("}" if not self.last or self.closed else ""))
            self.flush(None)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        now = None
        for b in batches:
            for value, *row in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or (now.file, now.block) != (row[0], row[1]):
                    if now is not None:
                        now.end()
                        yield batch(now.out)
                    now = Split(row)
                if now.text is not None:  # one row late: the last one may lack its brace
                    now.add(now.text + "}")
                now.text = value
                if len(now.out) >= 1000:
                    yield batch(now.out)
                    now.out = []
        if now is not None:
            now.end()
            yield batch(now.out)

    return run


def json_pieces(spark: SparkSession, paths, level: int, opener: str) -> DataFrame:
    """(file, ord, member, begins, level, text, sound): the text of each document that
    begins with ``opener``, cut at commas at most ``level`` deep. ``ord`` counts a
    document's pieces from 0 and ``member`` the commas at depth 1 before; ``begins``
    marks the first piece of each; ``level`` is the depth of the comma behind the piece
    (null for the last). ``sound`` is false where brackets or quotes do not balance.
    Other documents come whole: ord 0, level null."""
    raw = spark.read.option("lineSep", "}").text(paths).select(
        "value", file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("rid"))
    blocks = raw.select("file", "block", "size", "value").mapInArrow(_scan_blocks(), _BLOCK)
    starts = staged(blocks.groupBy("file").applyInPandas(_chain(), _START), "json-splits")
    small = (starts.agg(F.sum(F.octet_length("file") + 64)).first()[0] or 0) <= MAX_BROADCAST_BYTES
    keyed = starts.select(F.col("file").alias("_f"), F.col("block").alias("_b"), "inside", "depth", "last", "closed", "first")
    met = raw.join(F.broadcast(keyed) if small else keyed, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")), "left")
    if not small:
        met = met.repartition("file", "block").sortWithinPartitions("file", "block", "rid")
    # documents of another kind are cut nowhere: no comma is at depth -1
    lost = F.raise_error(F.lit("input splits changed between two scans")).cast("boolean")
    met = met.withColumn("inside", F.when(F.col("inside").isNull(), lost).otherwise(F.col("inside") == 1))
    rows = met.select("value", "file", "block", "inside", "depth", "last", "closed", (F.col("first") == opener).alias("mine"))
    order = ["value", "file", "block", "inside", "depth", "last", "closed"]
    pieces = staged(
        rows.filter("mine").select(*order).mapInArrow(_cut_blocks(level), _PIECE).unionByName(
            rows.filter("not mine").select(*order).mapInArrow(_cut_blocks(-1 << 40), _PIECE)), "json-pieces")
    # cuts of the splits before, from one row a split
    counts = pieces.filter(F.col("edge") & F.col("level").isNull()).select("file", "block", "cuts", "members")
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"{c}_before") for c in ("cuts", "members")]
    counts = counts.select(F.col("file").alias("_f"), F.col("block").alias("_b"), *before)
    placed = pieces.join(F.broadcast(counts) if small else counts, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    placed = placed.select("file", (F.col("cuts_before") + F.col("cuts")).alias("ord"),
                           (F.col("members_before") + F.col("members")).alias("member"), "block", "begins", "edge", "level", "text")
    part = F.sort_array(F.collect_list(F.struct("block", "text", "begins")))
    edges = placed.filter("edge").groupBy("file", "ord").agg(
        F.min("member").alias("member"), F.max("level").alias("level"), part.alias("parts")).select(
        "file", "ord", "member", F.get(F.filter("parts", lambda p: p["begins"].isNotNull()), F.lit(0))["begins"].alias("begins"), "level",
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    edges = staged(edges, "json-edges")  # two rows a split
    sound = starts.groupBy(F.col("file").alias("_f")).agg(F.first("sound").alias("sound"))
    both = placed.filter("not edge").drop("block", "edge").unionByName(edges)
    return both.join(F.broadcast(sound) if small else sound, F.col("file") == F.col("_f")).drop("_f")


#: The beginning of a member: its key, and the bracket if it is an array.
_HEAD = r'^\{?\s*("(?:[^"\\]|\\.)*+")\s*:\s*\[?'


def _trim(c):
    return F.regexp_replace(c, r"^[\ufeff \t\r\n]+|[ \t\r\n]+$", "")


def read_json_items(spark: SparkSession, paths) -> DataFrame:
    """Whole-file JSON, one value or an array of values: (file, item, value) with
    the 0-based item number and the item's JSON text. Where an array does not end,
    or text follows it, its last item keeps the mark before it and so is not JSON."""
    pieces = json_pieces(spark, paths, 1, "[")
    text = _trim("text")
    # the first piece begins with the array's bracket, the last one ends with it
    last = F.col("level").isNull()
    is_array = (F.col("ord") > 0) | text.startswith("[")
    value = F.when(is_array & (F.col("ord") == 0), F.expr("substring(t, 2)")).otherwise(F.col("t"))
    ends = is_array & last & F.col("sound") & F.col("v").endswith("]")
    kept = F.when(F.col("ord") == 0, F.col("t")).otherwise(F.concat(F.lit(","), F.col("t")))
    value2 = _trim(F.when(ends, F.expr("left(v, length(v) - 1)")).when(is_array & last, kept).otherwise(F.col("v")))
    cut = pieces.withColumn("t", text).withColumn("v", value).withColumn("value", value2)
    empty = is_array & (F.col("ord") == 0) & ends & (F.col("value") == "")  # [ ]
    return cut.filter(~empty).select("file", F.col("ord").cast("int").alias("item"), "value")


def read_json_members(spark: SparkSession, paths) -> DataFrame:
    """Whole-file JSON objects: (file, key, item, value), one row for each member,
    or for each item of a member that is an array (``item`` from 0; null for other
    members; no row for an empty array). A document that is no object gives one row
    with a null key and its text."""
    pieces = json_pieces(spark, paths, 2, "{").withColumn("t", _trim("text"))
    head = F.regexp_extract("t", _HEAD, 0)
    firsts = pieces.filter("begins").select(
        F.col("file").alias("_f"), F.col("member").alias("_m"), F.col("ord").alias("first_ord"), head.alias("head"),
        F.try_variant_get(F.try_parse_json(F.regexp_extract("t", _HEAD, 1)), "$", "string").alias("key"), head.endswith("[").alias("list"))
    met = pieces.join(firsts, (F.col("file") == F.col("_f")) & (F.col("member") == F.col("_m")))
    body = F.when(F.col("begins"), F.expr("substring(t, length(head) + 1)")).otherwise(F.col("t"))
    # the document's last piece ends with its brace, an array's last piece with its bracket
    ended = F.when(F.col("level").isNull() & F.col("sound") & (F.col("head") != ""), _trim(F.regexp_replace(_trim(body), r"\}$", ""))).otherwise(_trim(body))
    met = met.withColumn("body", ended).withColumn("closes", F.col("level").isNull() | (F.col("level") == 1))
    listed = F.when(F.col("closes"), _trim(F.regexp_replace("body", r"\]$", ""))).otherwise(F.col("body"))
    items = met.filter("list").select("file", "key", (F.col("ord") - F.col("first_ord")).alias("item"), listed.alias("value"), "closes")
    items = items.filter(~((F.col("item") == 0) & F.col("closes") & (F.col("value") == ""))).drop("closes")
    whole = met.filter("not list").groupBy("file", "member").agg(
        F.first("key").alias("key"), F.sort_array(F.collect_list(F.struct("ord", "body"))).alias("parts"))
    others = whole.select("file", "key", F.lit(None).cast("bigint").alias("item"),
                          F.array_join(F.transform("parts", lambda p: p["body"]), ",").alias("value"))
    empty = F.col("key").isNull() & F.regexp_like("value", F.lit(r"^\{?\s*\}?$"))  # { }
    return items.unionByName(others.filter(~empty))
