"""Line-oriented and whole-document JSON readers (SRC4-9, SRC14, SRC15).

``read_lines`` numbers every physical line. The text is scanned once and staged
with a row id that grows along each input split; the numbers are then derived
from the staged rows alone (one summary row per split, a running sum over the
splits), so no second scan has to agree with the first. Blank lines keep their
number and are dropped afterwards, as line-numbered default ids require.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import text as TX
from corpusmill.session import staged
from corpusmill.sources.files import MAX_BROADCAST_BYTES, file_path
from corpusmill.sources.json_items import read_json_items

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])


def read_lines(spark: SparkSession, paths, keep_blank: bool = False) -> DataFrame:
    """(file, line, ord, value): lines with their 1-based number in the file and
    over all files (files in name order; unique, so it can serve as a key).
    Blank lines are counted and then dropped unless ``keep_blank``."""
    raw = spark.read.text(paths).select(
        "value", file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("rid"))
    raw = raw.withColumn("blank", TX.py_strip(F.col("value")) == "")
    raw = staged(raw, "lines")
    kept = F.lit(True) if keep_blank else ~F.col("blank")
    blocks = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("first"))
    # one row per input split
    upto = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    start = F.min("before").over(Window.partitionBy("file"))
    offsets = staged(blocks.select("file", "block", "first", "before", start.alias("start")), "line-offsets")
    size = offsets.agg(F.sum(F.octet_length("file") + 64)).first()[0] or 0
    side = F.broadcast(offsets) if size <= MAX_BROADCAST_BYTES else offsets  # one row per split; lines stay where they are
    at = F.col("before") + F.col("rid") - F.col("first") + 1
    lines = raw.join(side, ["file", "block"]).select(
        "file", (at - F.col("start")).alias("line"), at.alias("ord"), "value", kept.alias("kept"))
    return lines.filter("kept").drop("kept")


def with_sequence(lines: DataFrame) -> DataFrame:
    """Adds ``seq``: the 0-based number of the row among its file's rows, by
    line. Rows are counted in runs of lines first, so that a long file is not
    sorted by one task."""
    run = F.floor(F.col("line") / 10_000)
    counts = lines.groupBy("file", run.alias("run")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("file", "run", F.coalesce(before, F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("file", "run").orderBy("line"))
    return lines.withColumn("run", run).withColumn("rank", rank).join(counts, ["file", "run"]).withColumn(
        "seq", F.col("base") + F.col("rank") - 1).drop("run", "rank", "base")


def json_type(value: Column, path: str = "$") -> Column:
    """Type name of the JSON value at ``path`` (null if absent, VOID if null)."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(value), path, "variant"))
    return F.regexp_extract(kind, "^[A-Z]+", 0)


def not_text(value: Column, names) -> Column:
    """Name of the first of the keys ``names`` whose value is there and is
    neither a string nor null."""
    kinds = [(n, json_type(value, f"$.{n}")) for n in names]
    return F.coalesce(*[F.when(~k.isin("STRING", "VOID", ""), F.lit(n)) for n, k in kinds])


def read_jsonl(spark: SparkSession, paths, schema: T.StructType, text_keys=()) -> DataFrame:
    """JSONL objects parsed with a fixed schema, plus file, line and ord. Lines
    that are not a JSON object keep their text in ``_corrupt``; ``_not_text``
    names the first of ``text_keys`` that holds something else than a string."""
    lines = read_lines(spark, paths)
    value = F.regexp_replace("value", "^\ufeff", "")
    is_obj = F.coalesce(json_type(value) == "OBJECT", F.lit(False))
    bad = not_text(value, text_keys) if text_keys else F.lit(None).cast("string")
    parsed = F.from_json(value, schema, {"mode": "PERMISSIVE"})
    return lines.select("file", "line", "ord", parsed.alias("r"), F.when(~is_obj, F.col("value")).alias("_corrupt"), bad.alias("_not_text")).select(
        "file", "line", "ord", "r.*", "_corrupt", "_not_text")


def read_json_documents(spark: SparkSession, paths, item_schema: T.StructType) -> DataFrame:
    """``read_json_items`` parsed with a fixed schema: (file, item_index, fields...)."""
    items = read_json_items(spark, paths)
    return items.select("file", F.col("item").alias("item_index"), F.from_json("value", item_schema).alias("r")).select("file", "item_index", "r.*")


def messages_payload(value_col, schema_extra: T.StructType | None = None):
    """A messages record is an object with ``messages`` or a bare list of
    messages: struct(id, messages, is_list) parsed from the JSON text."""
    obj_schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("messages", T.ArrayType(MESSAGE)),
                               T.StructField("system_prompt", T.StringType())] + (schema_extra.fields if schema_extra else []))
    v = F.ltrim(F.col(value_col))
    is_list = v.startswith("[")
    as_list = F.from_json(v, T.ArrayType(MESSAGE))
    as_obj = F.from_json(v, obj_schema)
    return F.struct(
        F.when(~is_list, as_obj["id"]).alias("id"),
        F.when(is_list, as_list).otherwise(as_obj["messages"]).alias("messages"),
        F.when(~is_list, as_obj["system_prompt"]).alias("system_prompt"),
        is_list.alias("is_list"),
    )


def read_url_file(spark: SparkSession, paths) -> DataFrame:
    """URL list file -> (line_ord, line); cleaning and first-wins distinct
    are done by ``operators.fetch.url_list``."""
    return read_lines(spark, paths, keep_blank=True).select("ord", F.col("value").alias("line"))


def read_bodies(spark: SparkSession, paths) -> DataFrame:
    """Landed body files -> (path, text) decoded as UTF-8; invalid bytes become
    U+FFFD. Bodies are read as binary so no line splitting happens."""
    b = spark.read.format("binaryFile").load(paths)
    return b.select(F.col("path"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
