"""Manifest control tables (SRC1-3, SRC11).

A manifest is a small JSON document; many manifests form a control table
with one row per manifest, and ``manifest_records`` expands it to one row per
(record, path). The control table is driver-sized config, never data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.files import file_path
from corpusmill.sources.json_items import read_json_members
from corpusmill.sources.jsonl import json_type, read_jsonl

ARTIFACTS = T.StructType([T.StructField("language", T.StringType()), T.StructField("has_code", T.BooleanType())])
RECORD_DEFAULTS = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("license", T.StringType()),
    T.StructField("system_prompt", T.StringType()), T.StructField("source_bucket", T.StringType()),
    T.StructField("source_ledger_path", T.StringType()), T.StructField("review_status", T.StringType()),
    T.StructField("allowed_for_training", T.BooleanType()), T.StructField("allowed_for_redistribution", T.BooleanType()),
    T.StructField("redistribution_status", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("difficulty", T.StringType()),
    T.StructField("challenge_family", T.StringType()), T.StructField("split", T.StringType()),
    T.StructField("artifacts", ARTIFACTS),
])
# Manifest-level defaults may carry any record-default field; record defaults
# override them field by field.
DEFAULTS = RECORD_DEFAULTS
RECORD = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("paths", T.ArrayType(T.StringType())),
    T.StructField("format", T.StringType()), T.StructField("defaults", RECORD_DEFAULTS),
])
MANIFEST = T.StructType([
    T.StructField("enabled", T.BooleanType()), T.StructField("source_id", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("license", T.StringType()),
    T.StructField("defaults", DEFAULTS), T.StructField("notes", T.ArrayType(T.StringType())),
    T.StructField("records", T.ArrayType(RECORD)),
])
FETCH_RECORD = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("fetched_at", T.StringType()),
    T.StructField("index", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("status_code", T.IntegerType()), T.StructField("final_url", T.StringType()),
    T.StructField("content_type", T.StringType()), T.StructField("content_length", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("headers", T.StructType([T.StructField(n, T.StringType()) for n in
                                           ("content_type", "content_length", "last_modified", "etag")])),
    T.StructField("body_path", T.StringType()), T.StructField("error", T.StringType()),
    T.StructField("cache_hit", T.BooleanType()), T.StructField("cached_from", T.StringType()),
])
FETCH_MANIFEST = T.StructType([
    T.StructField("created_at", T.StringType()), T.StructField("batch_name", T.StringType()),
    T.StructField("output_dir", T.StringType()), T.StructField("write_body", T.BooleanType()),
    T.StructField("max_concurrency", T.IntegerType()), T.StructField("cache_mode", T.StringType()),
    T.StructField("cache_dir", T.StringType()), T.StructField("records", T.ArrayType(FETCH_RECORD)),
])


def read_manifests(spark: SparkSession, folder: str, skip: str | None = None) -> DataFrame:
    """All ``*.json`` manifests of a folder, one row each, with the file name
    (sorted name order is kept in ``manifest``) and ``malformed`` for files
    that are not a JSON object. ``skip`` excludes one file (the redaction
    policy when it lives in the same folder)."""
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(folder).select(
        F.regexp_replace("value", "^\ufeff", "").alias("value"), file_path().alias("manifest_path"))
    is_obj = F.coalesce(json_type(F.col("value")) == "OBJECT", F.lit(False))
    whole = F.try_parse_json("value")
    # defaults as text too: they may carry keys that no schema names
    of_records = F.transform(F.try_variant_get(whole, "$.records", "array<variant>"),
                             lambda r: F.to_json(F.try_variant_get(r, "$.defaults", "variant")))
    df = raw.select(F.from_json("value", MANIFEST).alias("m"), "manifest_path", (~is_obj).alias("malformed"),
                    F.to_json(F.try_variant_get(whole, "$.defaults", "variant")).alias("defaults_json"), of_records.alias("record_defaults_json"))
    df = df.select("m.*", "manifest_path", "malformed", "defaults_json", "record_defaults_json")
    df = df.withColumn("manifest", F.regexp_extract("manifest_path", r"([^/]+)$", 1))
    if skip:
        df = df.filter(F.col("manifest") != skip.rsplit("/", 1)[-1])
    return df.withColumn("source_id", F.coalesce(F.col("source_id"), F.regexp_replace("manifest", r"\.json$", "")))


def manifest_records(manifests: DataFrame, key: str = "manifest") -> DataFrame:
    """Enabled manifests -> one row per (record, path): key, record_index,
    path_index, path, format (default jsonl_messages), record defaults, and
    ``error_reason`` for records without any path."""
    m = manifests.filter(F.coalesce(F.col("enabled"), F.lit(True)))
    r = m.select(*[c for c in m.columns if c != "records"], F.posexplode("records").alias("record_index", "record"))
    paths = F.coalesce(F.when(F.col("record.path").isNotNull(), F.array(F.col("record.path"))), F.col("record.paths"))
    r = r.withColumn("error_reason", F.when(paths.isNull(), F.lit("record_without_path")))
    r = r.select("*", F.posexplode_outer(paths).alias("path_index", "path"))
    return r.withColumn("format", F.coalesce(F.col("record.format"), F.lit("jsonl_messages")))


def read_fetch_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Fetch manifest -> one row per record with its 1-based position and the
    batch name (falling back to the parent folder name). The document is read in
    splits, however many records it holds; a leading BOM is tolerated."""
    members = read_json_members(spark, path)
    named = members.filter((F.col("key") == "batch_name") & F.col("item").isNull()).groupBy(F.col("file").alias("_f")).agg(
        F.try_variant_get(F.try_parse_json(F.max("value")), "$", "string").alias("named"))
    recs = members.filter((F.col("key") == "records") & F.col("item").isNotNull())
    batch = F.coalesce(F.when(F.col("named") != "", F.col("named")), F.regexp_extract("file", r"([^/]+)/[^/]+$", 1))
    return recs.join(F.broadcast(named), F.col("file") == F.col("_f"), "left").select(
        batch.alias("batch_name"), (F.col("item") + 1).alias("ord"), F.from_json("value", FETCH_RECORD).alias("r")).select(
        "batch_name", "ord", "r.*")


def read_fetch_records(spark: SparkSession, path: str) -> DataFrame:
    """What ``fetch_batch`` writes: a folder of JSONL fetch records, each with
    its batch name, numbered from 1 by their fetch index."""
    lines = read_jsonl(spark, path, T.StructType([*FETCH_RECORD.fields, T.StructField("batch_name", T.StringType())]))
    bad = F.raise_error(F.concat(F.lit("not a fetch record: "), F.col("file"), F.lit(":"), F.col("line").cast("string")))
    return lines.withColumn("ord", F.when(F.col("_corrupt").isNotNull(), bad.cast("bigint")).otherwise(
        F.coalesce(F.col("index"), F.col("ord")))).drop("file", "line", "_corrupt", "_not_text")
