"""End-to-end jobs: file sources -> operators -> sinks, one function per stage.

Each job builds one lazy plan per output and writes it; control data
(manifests, policy) is read on the driver only where it is configuration, and
every per-record step runs on the executors.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import config as C
from corpusmill.config import CurationConfig
from corpusmill.functions import freeform as FF
from corpusmill.functions import ordering as ORD
from corpusmill.functions import text as TX
from corpusmill.operators import evaluation as EV
from corpusmill.operators import gate as GT
from corpusmill.operators import records as RC
from corpusmill.operators import redact as RD
from corpusmill.operators import render as RN
from corpusmill.operators import review as RV
from corpusmill.operators import writeups as W
from corpusmill.session import checkpoint_dir, staged
from corpusmill.sinks import body_store as BS
from corpusmill.sinks import cache_log as CL
from corpusmill.sinks import writers as S
from corpusmill.sources import files as SF
from corpusmill.sources import jsonl as J
from corpusmill.sources import manifests as M

ARTIFACTS = M.ARTIFACTS
TEXT_KEYS = ("id", "category", "difficulty", "challenge_family", "split", "source", "license", "system_prompt")
QA_KEYS = tuple(C.PROMPT_ALIASES) + tuple(C.ANSWER_ALIASES)
MESSAGES = T.StructField("messages", T.ArrayType(J.MESSAGE))


def _schema(artifacts: T.StructType, extra: T.StructType, *more: T.StructField) -> T.StructType:
    text = [T.StructField(n, T.StringType()) for n in TEXT_KEYS]
    return T.StructType([*text, T.StructField("artifacts", artifacts), *more, *extra.fields])


class BuildError(ValueError):
    pass


@dataclass(frozen=True)
class DatasetBuildResult:
    samples: DataFrame
    quarantine: DataFrame
    summary: DataFrame
    skipped_manifests: tuple = ()  # enabled JSON files without records (reported, not built)
    run: dict = field(default_factory=dict)  # what the summary document says about the run
    rows: DataFrame | None = None  # samples and quarantine in one frame


# ---------------------------------------------------------------------------
# Stage D: manifests -> samples
# ---------------------------------------------------------------------------

def _resolve(spark: SparkSession, repo_root: str, manifest_path: str, p: str) -> str:
    """A manifest's path: its own if absolute, else beside the manifest if there is
    something, else under the repository's root."""
    if SF.is_absolute(p):
        return SF.plain(p)
    beside = SF.child_path(spark, SF.parent_path(spark, manifest_path), p)
    return beside if _exists(spark, beside) else SF.child_path(spark, repo_root, p)


def _strip_uri(c):
    return F.regexp_replace(c, r"^file:(//)?", "")


_exists = S.path_exists


def _items(spark, fmt: str, paths: list[str]) -> DataFrame:
    """(file, item, value): the JSON items of one record format; item is the
    1-based line for line formats and 0-based for whole documents."""
    if fmt in ("jsonl_qa", "jsonl_messages"):
        return J.read_lines(spark, paths).select("file", F.col("line").alias("item"), "value")
    if fmt in ("json_qa", "json_messages"):
        return J.read_json_items(spark, paths).select("file", F.col("item").cast("bigint").alias("item"), "value")
    raise BuildError(f"Unsupported record format: {fmt}")


def _infer(values: DataFrame) -> T.StructType:
    """The keys of the JSON objects in column ``value`` with their types, found by
    one aggregate; keys of mixed types are free-form values (VARIANT)."""
    kind = values.filter(J.json_type(F.col("value")) == "OBJECT").select(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
    if not kind or not kind.startswith("OBJECT<"):
        return T.StructType()
    kind = re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"(: |ARRAY<)VOID\b", r"\1STRING", kind))
    return _free(T.DataType.fromDDL(kind))


def _free(kind: T.DataType) -> T.DataType:
    """``kind`` with lists of free-form values taken as free-form wholes."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _free(f.dataType)) for f in kind.fields])
    return T.VariantType() if isinstance(kind, T.ArrayType) and FF.has_variant(kind) else kind


def _undeclared(found: T.StructType, declared: set[str]) -> list[T.StructField]:
    return [f for f in found.fields if f.name not in declared]


def _merge_types(a: T.StructType, b: T.StructType) -> T.StructType:
    """Keys of both; where the types differ otherwise than in keys, free-form."""
    out = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        have = out.get(f.name, f.dataType)
        both = isinstance(have, T.StructType) and isinstance(f.dataType, T.StructType)
        out[f.name] = _merge_types(have, f.dataType) if both else have if have == f.dataType else T.VariantType()
    return T.StructType([T.StructField(k, v) for k, v in out.items()])


def _merge(base, over):
    """Configuration objects merged at every depth."""
    if not (isinstance(base, dict) and isinstance(over, dict)):
        return over
    return {**base, **{k: _merge(base[k], v) if k in base else v for k, v in over.items()}}


def _load_format(spark, fmt: str, paths: list[str], extra: T.StructType | None, items: DataFrame | None = None,
                 artifacts: T.StructType = ARTIFACTS) -> DataFrame:
    """Rows of one record format: file, item, seq (the sample's 0-based number in
    its file, where its empty id asks for it), sample fields, messages or QA
    fields, ``error_reason``, and ``_own``: the record's other keys, as they are."""
    extra = extra or T.StructType()
    items = items if items is not None else _items(spark, fmt, paths)
    own = FF.without_keys(F.try_parse_json("value"), ["id", "messages", *QA_KEYS])
    items = items.withColumn("_own", F.coalesce(own, F.parse_json(F.lit("{}"))))
    qa_schema = _schema(artifacts, extra, *[T.StructField(n, T.StringType()) for n in QA_KEYS])
    msg_schema = _schema(artifacts, extra, MESSAGES)
    if fmt.endswith("_qa"):
        df = _qa_from_text(items, "value", qa_schema)
    elif fmt.endswith("_messages"):
        df = _messages_from_text(items, "value", msg_schema)
        if fmt.startswith("jsonl_"):  # blank lines do not count; only (file, line) is shuffled for all rows
            empty = F.coalesce(F.col("id") == "", F.lit(False))
            place = J.with_sequence(items.select("file", F.col("item").alias("line"))).select("file", F.col("line").alias("item"), "seq")
            df = df.filter(~empty).withColumn("seq", F.lit(None).cast("bigint")).unionByName(df.filter(empty).join(place, ["file", "item"]))
        else:
            df = df.withColumn("seq", F.col("item"))
    else:
        raise BuildError(f"Unsupported record format: {fmt}")
    if fmt.endswith("_qa"):
        # the system message (record's, else record defaults') is added once,
        # after the control table is joined
        df = RC.qa_to_messages(df, default_system_prompt=None, system_col=None)
        df = df.withColumn("error_reason", F.coalesce("read_error", "error_reason"))
        df = df.drop("read_error").withColumn("seq", F.lit(None).cast("bigint"))
    return df.withColumn("file", _strip_uri(F.col("file"))).withColumn("format", F.lit(fmt))


def _qa_from_text(df: DataFrame, value_col: str, schema: T.StructType) -> DataFrame:
    """QA items: the first prompt and answer alias that is there must be text."""
    v = F.col(value_col)
    kind = F.coalesce(J.json_type(v), F.lit(""))
    def first_not_text(names):
        kinds = [F.coalesce(J.json_type(v, f"$.{n}"), F.lit("VOID")) for n in names]
        return F.coalesce(*[F.when(~k.isin("VOID", ""), k) for k in kinds], F.lit("STRING")) != "STRING"
    err = F.when(kind == "", F.lit("malformed_json")).when(kind != "OBJECT", F.lit("not_an_object")).when(
        first_not_text(C.PROMPT_ALIASES) | first_not_text(C.ANSWER_ALIASES), F.lit("prompt_or_answer_not_text"))
    return df.select("file", "item", F.from_json(v, schema).alias("r"), "_own", err.alias("read_error")).select(
        "file", "item", "r.*", "_own", "read_error")


def _messages_from_text(df: DataFrame, value_col: str, schema: T.StructType) -> DataFrame:
    """Message items: an object with ``messages`` or a bare list; every entry an
    object whose content is text."""
    v = F.ltrim(F.col(value_col))
    kind = F.coalesce(J.json_type(v), F.lit(""))
    is_list = kind == "ARRAY"
    obj = F.from_json(v, schema)
    lst = F.from_json(v, T.ArrayType(J.MESSAGE))
    cols = [F.when(~is_list, obj[f.name]).alias(f.name) for f in schema.fields if f.name != "messages"]
    entries = F.when(is_list, F.try_variant_get(F.try_parse_json(v), "$", "array<variant>")).otherwise(
        F.try_variant_get(F.try_parse_json(v), "$.messages", "array<variant>"))
    entry_type = lambda x: F.regexp_extract(F.schema_of_variant(x), "^[A-Z]+", 0)
    content_type = lambda x: F.coalesce(
        F.regexp_extract(F.schema_of_variant(F.try_variant_get(x, "$.content", "variant")), "^[A-Z]+", 0), F.lit("VOID"))
    held = J.json_type(v, "$.messages")
    err = (
        F.when(kind == "", F.lit("malformed_json"))
        .when(~kind.isin("ARRAY", "OBJECT"), F.lit("not_a_list_or_object"))
        .when(~is_list & held.isNull(), F.lit("object_without_messages"))
        .when(~is_list & (held != "ARRAY"), F.lit("empty_messages"))
        .when(F.exists(entries, lambda x: entry_type(x) != "OBJECT"), F.lit("entry_not_an_object"))
        .when(F.exists(entries, lambda x: ~content_type(x).isin("STRING", "VOID")), F.lit("content_not_text"))
    )
    return df.select("file", "item", *cols, F.when(is_list, lst).otherwise(obj["messages"]).alias("messages"),
                     "_own", err.alias("error_reason"))


def build_dataset(spark: SparkSession, manifest_dir: str, repo_root: str, *, policy: RD.RedactionPolicy | None = None,
                  policy_path: str | None = None, strict_anonymize: bool = False,
                  default_system_prompt: str = C.DEFAULT_SYSTEM_PROMPT, allow_missing_paths: bool = False,
                  extra_fields: T.StructType | None = None, ledger_listing: DataFrame | None = None,
                  infer_extra: bool = True) -> DatasetBuildResult:
    """Manifests -> normalised samples, quarantined rows and the summary.

    Order per sample: defaults merge -> strict key drop -> redaction -> id ->
    messages -> fills -> provenance -> required keys. Keys that no schema names,
    of records and of defaults, pass through (dropped and redacted like the
    rest): their types are inferred by one aggregate over the records, or given
    as ``extra_fields``; ``infer_extra=False`` keeps only the given ones."""
    if policy is None and policy_path:
        policy = RD.load_policy(policy_path)
    skip = os.path.basename(policy_path) if policy_path and os.path.dirname(os.path.abspath(policy_path)) == os.path.abspath(manifest_dir) else None
    manifests = M.read_manifests(spark, manifest_dir, skip=skip)
    heads = manifests.select("manifest", "enabled", "malformed", F.size(F.coalesce("records", F.array())).alias("n")).collect()
    if not heads:
        raise BuildError(f"No manifest JSON files found under {manifest_dir}")
    broken = sorted(h["manifest"] for h in heads if h["malformed"])
    if broken:
        raise BuildError(f"Not a JSON object: {', '.join(broken)}")
    skipped = sorted(h["manifest"] for h in heads if h["enabled"] is not False and h["n"] == 0)
    recs = M.manifest_records(manifests.select(
        "manifest", "manifest_path", "source_id", "enabled", "records", "source", "license", "defaults", "defaults_json",
        "record_defaults_json"), "manifest")
    # Control rows are configuration: one per (manifest, record, path).
    ctl_rows = recs.select("manifest", "manifest_path", "source_id", "source", "license", "defaults", "record_index",
                           "path_index", "path", "format", "record", "error_reason", "defaults_json",
                           F.try_element_at("record_defaults_json", F.col("record_index") + 1).alias("record_json")).collect()
    if not ctl_rows:
        raise BuildError(f"No manifest records found under {manifest_dir}")
    bad = [r for r in ctl_rows if r["error_reason"]]
    if bad:
        raise BuildError(f"Record must include 'path' or 'paths': {bad[0]['manifest']}#{bad[0]['record_index']}")

    # Review gate on record defaults over manifest defaults.
    gate_rows = []
    for r in ctl_rows:
        rd = r["record"]["defaults"]
        ledger = _field(r, "source_ledger_path")
        if isinstance(ledger, str) and ledger.strip():
            ledger = _resolve(spark, repo_root, SF.plain(r["manifest_path"]), ledger)
        # the gate looks at the manifest's own source, else at its defaults'
        source = r["source"] if r["source"] is not None else (r["defaults"]["source"] if r["defaults"] is not None else None)
        gate_rows.append((r["manifest"], r["record_index"], source, rd["source_bucket"] if rd is not None else None,
                          _field(r, "allowed_for_training"), _field(r, "allowed_for_redistribution"),
                          _field(r, "review_status"), _field(r, "redistribution_status"), ledger))
    gate_df = spark.createDataFrame(gate_rows, "manifest string, record_index int, source string, source_bucket string, "
                                    "allowed_for_training boolean, allowed_for_redistribution boolean, review_status string, "
                                    "redistribution_status string, source_ledger_path string")
    if ledger_listing is None:
        existing = sorted({g[8] for g in gate_rows if g[8] and _exists(spark, g[8])})
        ledger_listing = spark.createDataFrame([(p,) for p in existing], "source_ledger_path string")
    failures = GT.gate_failures(GT.review_gate(gate_df, "manifest", ledger_listing)).orderBy("manifest", "record_index").collect()
    if failures:
        f = failures[0]
        raise BuildError(f"Reviewed scraped manifest blocked ({f['gate_error']}): {f['manifest']} record #{f['record_index']}")

    # Resolve paths on the driver (bounded list), then read each format once.
    resolved = []
    for r in ctl_rows:
        p = _resolve(spark, repo_root, SF.plain(r["manifest_path"]), r["path"])
        if not _exists(spark, p):
            if allow_missing_paths:
                continue
            raise BuildError(f"Source path does not exist: {p}")
        resolved.append((r, p))
    by_format: dict[str, set[str]] = {}
    for r, p in resolved:
        by_format.setdefault(r["format"], set()).add(p)
    if not by_format:
        raise BuildError("No record file exists")
    items = {fmt: _items(spark, fmt, sorted(ps)) for fmt, ps in by_format.items()}
    plain = [_merge(_merge({n: r[n] if r[n] is not None else C.UNKNOWN for n in ("source", "license")},
                           _loads(r["defaults_json"])), _loads(r["record_json"])) for r, _ in resolved]
    levels = max(map(FF.depth_of, plain))
    plain = [json.dumps(p) for p in plain]
    given = extra_fields or T.StructType()
    artifacts = ARTIFACTS
    if infer_extra:
        found = _infer(spark.createDataFrame([(p,) for p in plain], "value string"))
        for fmt in sorted(items):
            found = _merge_types(found, _infer(items[fmt]))
        named = {*TEXT_KEYS, *QA_KEYS, "messages", "artifacts", "provenance", *(f.name for f in M.RECORD_DEFAULTS.fields), *given.names}
        own = [f for f in found.fields if f.name == "artifacts" and isinstance(f.dataType, T.StructType)]
        if own:
            artifacts = T.StructType([*ARTIFACTS.fields, *_undeclared(own[0].dataType, set(ARTIFACTS.names))])
        given = T.StructType([*given.fields, *_undeclared(found, named)])
    frames = [_load_format(spark, fmt, sorted(by_format[fmt]), given, items[fmt], artifacts) for fmt in by_format]
    rows = frames[0]
    for fr in frames[1:]:
        rows = rows.unionByName(fr, allowMissingColumns=True)

    # Control table: record defaults merged over manifest defaults, per path.
    ctl = spark.createDataFrame([
        (p, r["format"], r["manifest"], r["source_id"], int(r["record_index"]), _field(r, "system_prompt"), text)
        for (r, p), text in zip(resolved, plain, strict=True)],
        "file string, format string, manifest string, source_id string, record_index int, d_system_prompt string, d_json string")
    ctl = ctl.withColumn("d_values", F.parse_json("d_json")).drop("d_json")
    # every row read must find the record that listed its file
    joined = rows.join(ctl, ["file", "format"], "left").withColumn(
        "error_reason", F.when(F.col("manifest").isNull(), F.lit("no_manifest_record")).otherwise(F.col("error_reason")))

    stem = F.regexp_extract(F.col("file"), r"([^/]+?)(?:\.[^./]*)?$", 1)
    fallback = F.concat_ws("_", F.col("source_id"), stem, F.col("record_index").cast("string"), F.col("item").cast("string"))
    # a falsy QA id and an absent message id get the record's number; an empty
    # message id gets the sample's number in its file
    third = F.concat_ws("_", F.col("source_id"), stem, F.col("seq").cast("string"))
    loader_id = F.when(F.col("format").endswith("_qa"), F.coalesce(TX.py_truthy_str(F.col("id")), fallback)) \
        .otherwise(F.coalesce(TX.py_truthy_str(F.coalesce(F.col("id"), fallback)), third))
    df = joined.withColumn("id", loader_id)
    # QA system prompt: record's own, else the record defaults'.
    qa_sys = F.coalesce(TX.py_truthy_str(F.col("system_prompt")), TX.py_truthy_str(F.col("d_system_prompt")))
    df = df.withColumn("messages", F.when(F.col("format").endswith("_qa") & qa_sys.isNotNull() & F.col("messages").isNotNull(),
                                          F.concat(F.array(F.struct(F.lit("system").alias("role"), qa_sys.alias("content"))), F.col("messages")))
                       .otherwise(F.col("messages")))
    # the record over its defaults, at every depth; its own null wins
    named = ("category", "difficulty", "challenge_family", "split", "source", "license", "system_prompt")
    rest = T.StructType([*[T.StructField(n, T.StringType()) for n in named], T.StructField("artifacts", artifacts), *given.fields])
    df = df.withColumn("_all", FF.merge_values(F.col("_own"), F.coalesce("d_values", F.parse_json(F.lit("{}"))), levels))
    df = df.withColumn("_m", F.from_json(F.to_json("_all"), rest))
    merged = {f.name: F.col("_m")[f.name] for f in rest.fields}
    for f in ("category", "difficulty", "challenge_family", "source", "license"):
        merged[f"_no_{f}"] = F.try_variant_get("_all", f"$.{f}", "variant").isNull()
    # language and has_code are always there
    merged["artifacts"] = F.struct(*[merged["artifacts"][f.name].alias(f.name) for f in artifacts.fields])
    df = df.withColumns(merged)
    df = df.withColumn("original_id", F.col("id").cast("string"))
    kept_qa = [c for c in QA_KEYS if c in df.columns] if infer_extra else []
    extra_names = [*given.names, *kept_qa]
    body_cols = ["id", "category", "difficulty", "challenge_family", "split", "source", "license", "system_prompt",
                 "artifacts", "messages"] + extra_names
    unnamed = [c for c in df.columns if c.startswith("_no_")]
    keep = ["original_id", "manifest", "source_id", "file", "error_reason", "item", "record_index", *unnamed]
    df = df.select(*keep, *body_cols)
    if strict_anonymize:
        df = RD.drop_metadata(df, C.DEFAULT_DROP_KEYS, keep=keep)
    if policy is not None:
        df = RD.apply_policy(df, policy, keep=keep)
    if strict_anonymize:
        # a category that is null by the record's own word is spelt out
        spelt = F.when(F.col("category").isNull() & ~F.col("_no_category"), F.lit("None")).otherwise(F.col("category"))
        new_id = RC.sample_id("original_id", spelt, "strict")
    elif policy is not None:
        new_id = RC.sample_id("original_id", mode="policy", redacted_id=F.col("id"))
    else:
        new_id = RC.sample_id("id")
    df = df.withColumn("id", new_id)
    norm = RC.normalize_messages_nested(F.col("messages"), F.col("system_prompt"), default_system_prompt)
    df = df.withColumn("_n", norm).withColumn("messages", F.col("_n.messages")).withColumn(
        "error_reason", F.coalesce(F.col("error_reason"), F.col("_n.error_reason"))).drop("_n")
    df = df.withColumns({c[4:]: F.when(F.col(c), F.lit(C.UNKNOWN)).otherwise(F.col(c[4:])) for c in unnamed}).drop(*unnamed)
    if not strict_anonymize:
        df = df.withColumn("provenance", F.struct(F.col("source_id").alias("source_id"), F.col("file").alias("source_path")))
    df = df.drop("system_prompt")
    absent = [k for k in C.REQUIRED_SAMPLE_KEYS if k not in df.columns]
    if absent:
        raise BuildError(f"Samples lack required keys: {', '.join(absent)}")
    samples, quarantine = _split_rows(df)
    summary = RC.dataset_summary(samples)
    run = {"manifest_dir": SF.child_path(spark, manifest_dir, "."), "strict_anonymize": strict_anonymize,
           "redaction_rules": SF.child_path(spark, os.getcwd(), policy_path) if policy_path else None}
    return DatasetBuildResult(samples, quarantine, summary, tuple(skipped), run, df)


def _split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, quarantine)"""
    good = rows.filter(F.col("error_reason").isNull())
    samples = good.withColumns({"_o1": F.col("record_index"), "_o2": F.col("file"), "_o3": F.col("item")}).drop(
        "error_reason", "original_id", "source_id", "file", "item", "record_index")
    return samples, rows.filter(F.col("error_reason").isNotNull())


def _field(r, name: str):
    """Record default, else manifest default (record defaults override)."""
    for d in (r["record"]["defaults"], r["defaults"]):
        if d is not None and name in d.__fields__ and d[name] is not None:
            return d[name]
    return None


def _loads(text: str | None) -> dict:
    value = json.loads(text) if text else {}
    return value if isinstance(value, dict) else {}


def write_dataset(result: DatasetBuildResult, output_dir: str, overwrite: bool = False, fail_on_duplicates: bool = True,
                  fail_on_quarantine: bool = True) -> None:
    """Strict mode checks (bad records, duplicate ids) then one folder per
    split and the summary document."""
    spark = result.samples.sparkSession
    with S.RunOutput(spark, output_dir, ("samples", "summary", "counts"), overwrite) as run:
        samples, quarantine = _split_rows(staged(result.rows, "samples"))  # the text chain runs once
        if fail_on_quarantine:
            bad = quarantine.orderBy("manifest", "record_index", "file", "item").select("file", "item", "error_reason").limit(1).collect()
            if bad:
                raise BuildError(f"Invalid record {bad[0]['file']}:{bad[0]['item']}: {bad[0]['error_reason']}")
        if fail_on_duplicates:
            dup = RC.duplicate_ids(samples).orderBy("id").limit(1).collect()
            if dup:
                raise BuildError(f"Duplicate sample id detected: {dup[0]['id']}")
        S.write_split_jsonl(samples.withColumnRenamed("manifest", "_manifest"), run["samples"],
                            order_by=["_manifest", "_o1", "_o2", "_o3"])
        about = {**result.run, "output_dir": SF.child_path(spark, output_dir, ".")}
        S.write_summary(run_document(RC.dataset_summary(samples), about), run["summary"])
        S.write_jsonl(RC.dataset_counts(samples), run["counts"])


def run_document(document: DataFrame, about: dict) -> DataFrame:
    """A one-row document with what the run knows of itself (paths, flags, times)."""
    def value(v):
        if isinstance(v, dict):
            return F.parse_json(F.lit(json.dumps(v)))
        return F.lit(v) if v is not None else F.lit(None).cast("string")
    return document.withColumns({k: value(v) for k, v in about.items()})


# ---------------------------------------------------------------------------
# Stage W: transformed write-ups -> train/eval samples
# ---------------------------------------------------------------------------

TRANSFORMED = T.StructType([T.StructField(n, T.StringType()) for n in (
    "review_id", "source_url", "final_url", "permission_basis", "transform_method", "transform_url",
    "transform_status", "transform_error", "content_sha256", "content")])
LINK = T.StructType([T.StructField("index", T.LongType()), T.StructField("ctftime_writeup_url", T.StringType()),
                     T.StructField("original_url", T.StringType()), T.StructField("original_error", T.StringType())])


def _parsed(rows: DataFrame, strict: bool) -> DataFrame:
    """Rows of ``read_jsonl`` that parsed; ``strict`` fails on the first line
    that did not."""
    if strict:
        bad = rows.filter(F.col("_corrupt").isNotNull()).orderBy("ord").select("file", "line").limit(1).collect()
        if bad:
            raise BuildError(f"Not a JSON object: {bad[0]['file']}:{bad[0]['line']}")
    return rows.filter(F.col("_corrupt").isNull()).drop("file", "line", "_corrupt", "_not_text")


def read_transformed(spark: SparkSession, path: str, strict: bool = True, quarantine_path: str | None = None) -> DataFrame:
    """Transformed rows with ``ord``, unique over all files of ``path``."""
    rows = J.read_jsonl(spark, path, TRANSFORMED)
    if not strict and quarantine_path:
        bad = rows.filter(F.col("_corrupt").isNotNull()).select("file", "line", F.col("_corrupt").alias("value"))
        S.write_jsonl(bad, quarantine_path, order_by=["file", "line"])
    return _parsed(rows, strict)


def build_writeup_dataset(spark: SparkSession, transformed_path: str, output_dir: str, enumeration_path: str | None = None,
                          cfg: CurationConfig = W.DEFAULT, overwrite: bool = False, strict: bool = True) -> DataFrame:
    """Transformed JSONL (+ link JSONL) -> split folders (split kept in the
    body) and a summary; returns the summary frame. ``strict`` stops at lines
    that are not JSON objects; otherwise they are written to ``quarantine``."""
    names = ["samples", "summary"] if strict else ["quarantine", "samples", "summary"]
    with S.RunOutput(spark, output_dir, names, overwrite) as run:
        t = read_transformed(spark, transformed_path, strict, None if strict else run["quarantine"])
        links = None
        if enumeration_path:
            links = _parsed(J.read_jsonl(spark, enumeration_path, LINK), strict)
        stage = os.path.join(checkpoint_dir(spark), f"writeup-rows-{uuid.uuid4().hex}")
        cur = W.curate_writeups(t, links, cfg, stage_dir=stage)
        samples = W.build_samples(cur, cfg).withColumnRenamed("first_ord", "_first_ord")
        S.write_split_jsonl(samples, run["samples"], keep_split_in_body=True, order_by="_first_ord")
        summary = W.curation_summary(cur)
        S.write_summary(summary, run["summary"])
    return summary


# ---------------------------------------------------------------------------
# Stage R: fetch manifest -> review ledger
# ---------------------------------------------------------------------------

def prepare_review(spark: SparkSession, fetch_manifest: str, output_dir: str, overwrite: bool = False, **ledger_args) -> DataFrame:
    """``fetch_manifest``: a manifest document, or the folder of records that
    ``fetch_batch`` writes. The ledger keeps ``ord``."""
    recs = M.read_fetch_manifest(spark, fetch_manifest) if fetch_manifest.endswith(".json") else M.read_fetch_records(spark, fetch_manifest)
    first = recs.select("batch_name").limit(1).collect()
    if not first:
        raise BuildError(f"Fetch manifest has no records: {fetch_manifest}")
    led = RV.review_ledger(recs, first[0]["batch_name"], index_col="ord", **ledger_args)
    with S.RunOutput(spark, output_dir, ("review_ledger", "review_ledger_csv", "review_summary"), overwrite) as run:
        S.write_jsonl(led, run["review_ledger"], order_by="ord")
        S.write_ledger_csv(led, run["review_ledger_csv"])
        summary = RV.review_summary(led)
        S.write_summary(summary, run["review_summary"])
    return summary


# ---------------------------------------------------------------------------
# Stage E: cases + responses -> report
# ---------------------------------------------------------------------------

CASE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("category", T.StringType()), T.StructField("prompt", T.StringType()),
    T.StructField("messages", T.ArrayType(J.MESSAGE)), T.StructField("checks", T.ArrayType(EV.CHECK)),
    T.StructField("exact", T.StringType()), T.StructField("contains", T.StringType()), T.StructField("regex", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


def load_cases(spark: SparkSession, cases_path: str) -> DataFrame:
    c = J.read_jsonl(spark, cases_path, CASE)
    bad = c.filter(F.col("_corrupt").isNotNull()).orderBy("ord").select("file", "line").limit(1).collect()
    if bad:
        raise BuildError(f"Not a JSON object: {bad[0]['file']}:{bad[0]['line']}")
    # numbered over all case files, so that defaults cannot collide
    return c.withColumn("id", EV.default_case_id("id", F.col("ord"))).drop("_corrupt", "_not_text")


def run_eval(spark: SparkSession, cases_path: str, responses: DataFrame, report_dir: str,
             default_system_prompt: str | None = None, template: RN.ChatTemplate = RN.DEFAULT_TEMPLATE,
             overwrite: bool = False, model: str | None = None, adapter: str | None = None,
             generation: dict | None = None) -> DataFrame:
    """Scores ``responses`` (id, response) and writes per-case results, the
    per-category report, and a document with the totals and the run's own facts
    (``model``, ``adapter`` and ``generation`` say what produced the responses;
    ``results`` names the folder of per-case results). Returns the report frame."""
    started = time.time()
    with S.RunOutput(spark, report_dir, ("results", "report", "report_document"), overwrite) as run:
        cases = load_cases(spark, cases_path)
        if cases.limit(1).count() == 0:
            raise BuildError(f"No evaluation cases were found in {cases_path}")
        cases = cases.withColumn("prompt_text", RN.render_prompt(F.col("messages"), F.col("prompt"), default_system_prompt, template))
        scored = EV.score_cases(cases, responses, "id")
        S.write_jsonl(scored.select("id", "category", "passed", F.col("checks_result").alias("checks"),
                                    F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"), "response"),
                      run["results"])
        report = EV.eval_report(scored)
        S.write_jsonl(report, run["report"])
        folder = SF.child_path(spark, report_dir, ".")
        about = {"model_name_or_path": model, "adapter_path": adapter, "cases_path": cases_path, "report_path": f"{folder}/report_document",
                 "duration_seconds": round(time.time() - started, 3), "generation": generation or {}, "results": f"{folder}/results"}
        S.write_summary(run_document(EV.report_document(report), about), run["report_document"])
    return report


def render_training_split(spark: SparkSession, split_path: str, out_path: str, template: RN.ChatTemplate = RN.DEFAULT_TEMPLATE,
                          overwrite: bool = False) -> DataFrame:
    """Sample JSONL -> one ``text`` column; an empty split is an error."""
    df = spark.read.schema(T.StructType([T.StructField("messages", T.ArrayType(J.MESSAGE))])).json(split_path)
    out = RN.render_split(df, "messages", template)
    if out.limit(1).count() == 0:
        raise BuildError(f"split is empty: {split_path}")
    bad = out.filter(F.col("error_reason").isNotNull()).limit(1).collect()
    if bad:
        raise BuildError(f"record rejected: {bad[0]['error_reason']}")
    with S.RunOutput(spark, os.path.dirname(out_path.rstrip("/")), [os.path.basename(out_path.rstrip("/"))], overwrite) as run:
        out.select("text").write.json(run[run.names[0]])
    return out


# ---------------------------------------------------------------------------
# Stages L, F, T: link enumeration, fetch batch + cache, transform selection
# ---------------------------------------------------------------------------

def enumerate_links(spark: SparkSession, index_pages: DataFrame, detail_pages: DataFrame | None, output_dir: str,
                    target_source: str = "ctftime", overwrite: bool = False) -> DataFrame:
    """Landed index pages (ord, html) and optional detail pages (url, html[,
    error]) -> link rows, first-occurrence target list and the summary."""
    from corpusmill.operators import links as LK

    found = LK.ordered_distinct(LK.extract_links(index_pages, "html", "ord"), "url", "page_ord", "pos")
    rows = found.select(F.col("url").alias("ctftime_writeup_url"), "page_ord", "pos")
    if detail_pages is not None:
        # the original link is extracted next to the page (narrow), so only
        # URLs take part in the join, never page HTML
        landed = F.col("error") if "error" in detail_pages.columns else F.lit(None).cast("string")
        det = detail_pages.select(F.col("url").alias("_u"), LK.original_link(F.col("html")).alias("_orig"), landed.alias("_err")) \
            .groupBy("_u").agg(F.max("_orig").alias("_orig"), F.max("_err").alias("_err"))  # one detail page per URL
        rows = rows.join(det, rows["ctftime_writeup_url"] == det["_u"], "left")
        orig, error = F.col("_orig"), F.when(F.col("_orig").isNull(), F.col("_err"))
    else:
        orig = error = F.lit(None).cast("string")
    rows = ORD.numbered(rows, ["page_ord", "pos"], "index")
    link_rows = rows.select("index", "ctftime_writeup_url", orig.alias("original_url"), error.alias("original_error"))
    targets = LK.target_urls(link_rows, target_source)
    with S.RunOutput(spark, output_dir, ("targets", "links", "summary"), overwrite) as run:
        S.write_target_list(targets, run["targets"])
        S.write_jsonl(link_rows, run["links"], order_by="index")
        summary = LK.enumeration_summary(link_rows, targets)
        S.write_summary(summary, run["summary"])
    return summary


def url_lines(spark: SparkSession, urls=(), url_file: str | None = None) -> DataFrame:
    """(ord, line): literal urls, then the lines of a file."""
    lines = spark.createDataFrame([(i, u) for i, u in enumerate(urls, 1)], "ord bigint, line string")
    if url_file:
        lines = lines.unionByName(J.read_url_file(spark, url_file).withColumn("ord", F.col("ord") + len(urls)))
    return lines


def fetch_batch(spark: SparkSession, url_lines: DataFrame, payloads: DataFrame, cache_log: str | None,
                output_dir: str, batch_name: str | None = None, body_dir: str | None = None, cache_mode: str = "reuse",
                batch_seq: int | None = None, overwrite: bool = False, fetched_at: str | None = None) -> DataFrame:
    """URL lines (ord, line) + landed payloads (url, final_url, body, status,
    content_type_raw[, status_code, headers]) -> fetch records.

    ``reuse``: URLs whose latest cache entry is ok become ``cached`` records;
    the rest take their landed payload (none landed -> an error record). New
    ok records are appended whole to the cache log; their ordinal orders by
    (``batch_seq``, index), so later batches win on read. ``batch_seq`` defaults
    to the current epoch second, ``fetched_at`` to the current time, ``batch_name``
    to one made of it. With ``body_dir`` the bodies of ok payloads are stored there,
    once per digest, and ``body_path`` names the store's entry. Bodies are stored
    first and stay if a later sink fails: the next run finds them there."""
    clock = datetime.now(timezone.utc)
    batch_name = batch_name or clock.strftime("scrape_%Y%m%d_%H%M%S")
    now = F.lit(fetched_at or clock.isoformat())
    from corpusmill.operators import fetch as FE

    urls = FE.url_list(url_lines)
    if cache_mode not in ("reuse", "refresh", "off"):
        raise BuildError(f"unknown cache_mode: {cache_mode}")
    idx = ORD.numbered(urls, ["ord"], "idx").select("url", "idx")
    if cache_mode == "reuse" and cache_log and _exists(spark, cache_log):
        hits, misses = FE.cache_lookup(idx, CL.read(spark, cache_log))
        kept = [c for c in ("final_url", "content_type", "content_length", "sha256", "filename", "status_code", "headers", "body_path")
                if f"cache_{c}" in hits.columns]
        cached = hits.select(F.col("idx").cast("bigint").alias("index"), "url", F.lit("cached").alias("status"),
                             *[F.col(f"cache_{c}").alias(c) for c in kept], now.alias("fetched_at"), F.lit(True).alias("cache_hit"),
                             F.col("cache_fetched_at").alias("cached_from"))
        todo = misses
    else:
        cached, todo = None, idx
    # bodies are reduced to digest and length next to the payload (narrow);
    # only that metadata meets the URL list in the join
    meta = FE.payload_metadata(payloads)
    # one payload per URL (a successful one first, then the larger digest), so
    # a URL landed twice still yields one fetch record
    cols = [c for c in meta.columns if c != "url"]
    pick = F.struct(F.coalesce(F.col("status") != "error", F.lit(False)), F.coalesce(F.col("body_sha256"), F.lit("")))
    meta = meta.groupBy("url").agg(F.max_by(F.struct(*cols), pick).alias("_m")).select("url", "_m.*")
    joined = todo.join(meta, "url", "left")
    landed_error = F.col("error") if "error" in meta.columns else F.lit(None).cast("string")
    joined = joined.withColumn("error", F.when(F.col("status").isNull(), F.lit("MissingPayload: nothing landed for this URL"))
                               .otherwise(landed_error))
    fetched = FE.fetch_log(joined, index_col="idx").withColumns(
        {"fetched_at": now, "cache_hit": F.lit(False), "cached_from": F.lit(None).cast("string")})
    if body_dir is not None:
        ok = F.col("status") == "ok"
        fetched = fetched.withColumn("body_path", F.when(ok, F.concat(F.lit(body_dir.rstrip("/") + "/"), F.col("sha256"))))
        landed_ok = payloads.filter(F.coalesce(F.col("status") != "error", F.lit(False)))
        S.require_new(spark, [os.path.join(output_dir, "fetch_manifest")], overwrite)
        BS.append_bodies(landed_ok.select(F.sha2(F.col("body").cast("binary"), 256).alias("sha256"), "body"), body_dir)
    fetched = staged(fetched, "fetched")
    records = fetched if cached is None else fetched.unionByName(cached, allowMissingColumns=True)
    with S.RunOutput(spark, output_dir, ("fetch_manifest",), overwrite) as run:
        S.write_jsonl(records.withColumn("batch_name", F.lit(batch_name)), run["fetch_manifest"], order_by="index")
        if cache_mode != "off" and cache_log:
            seq = F.lit(int(batch_seq if batch_seq is not None else time.time())).cast("bigint")
            new = fetched.filter(F.col("status") == "ok").withColumn("ord", ORD.first_key(seq, F.col("index"))).drop(
                "index", "error", "cache_hit", "cached_from")
            CL.append(new, cache_log)
    return records


def transform_selected(spark: SparkSession, ledger: DataFrame, landed_text: DataFrame, output_dir: str,
                       include_unapproved: bool = False, limit: int | None = None, overwrite: bool = False,
                       body_dir: str | None = None) -> DataFrame:
    """Approved ledger rows -> routed transform targets joined with the text
    landed for them (transform_url, text) -> transformed rows and summary. Rows
    whose method is ``local_cached_body`` take the body that their ``body_path``
    names in the store ``body_dir`` (by digest, the path's last part); without a
    store, or for paths that are no digests, the text landed for the path."""
    from corpusmill.operators import transform as TR

    sel = RV.approved_rows(ledger, include_unapproved) if limit is None else \
        RV.approved_rows_limited(ledger, limit, include_unapproved)
    routed = TR.route_targets(sel)
    digest = F.regexp_extract("transform_url", r"([0-9a-f]{64})$", 1)
    stored = F.lit(False) if body_dir is None else (F.col("transform_method") == "local_cached_body") & (digest != "")
    routed = routed.withColumn("_digest", F.when(stored, digest))
    # one landed text per target URL (the longest, ties to the larger digest): picked
    # by keys alone, then the picked rows' texts; equal rows collapse by digest
    keyed = landed_text.select("transform_url", "text", F.length("text").alias("_n"), TX.sha256_hex(F.col("text")).alias("_d"))
    best = keyed.filter(F.col("_d").isNotNull()).groupBy(F.col("transform_url").alias("_t")).agg(F.max(F.struct("_n", "_d")).alias("_best"))
    chosen = keyed.join(best, (F.col("transform_url") == F.col("_t")) & (F.col("_d") == F.col("_best._d"))).groupBy("_t").agg(
        F.first("text").alias("text"))
    got = routed.join(chosen, F.when(F.col("_digest").isNull(), routed["transform_url"]) == F.col("_t"), "left")
    if body_dir is not None:
        bodies = BS.read_body_store(spark, body_dir).select(F.col("sha256").alias("_s"), BS.body_text(F.col("body")).alias("_body"))
        got = got.join(bodies, F.col("_digest") == F.col("_s"), "left").withColumn("text", F.coalesce("text", "_body"))
    ok = F.col("text").isNotNull()
    missing = F.when(F.col("_digest").isNotNull(), F.lit("MissingContent: no stored body for body_path")).otherwise(
        F.lit("MissingContent: nothing landed for transform_url"))
    out = got.select(
        "review_id", "source_url", "final_url", "permission_basis", "transform_method", "transform_url",
        F.when(ok, F.lit("ok")).otherwise(F.lit("error")).alias("transform_status"),
        F.when(~ok, missing).alias("transform_error"),
        F.col("text").alias("content"), "ord", ok.alias("_ok"))
    out = TR.landed_text(out)
    out = out.withColumn("content_sha256", F.when(F.col("_ok"), F.col("content_sha256"))).drop("_ok")
    with S.RunOutput(spark, output_dir, ("transformed", "transform_summary"), overwrite) as run:
        out = staged(out, "transformed")
        S.write_jsonl(out, run["transformed"], order_by="ord")
        summary = TR.transform_summary(out, ledger)
        S.write_summary(summary, run["transform_summary"])
    return summary
