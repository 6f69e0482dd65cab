"""Stage D: manifest-described QA / messages records -> normalised samples
(PRJ1-14, FLT5/6, JOIN4, AGG1/2).

Two representations are supported:

* nested: one row per sample with ``messages ARRAY<STRUCT<role, content>>``
  (what JSONL readers produce) -- handled with higher-order functions on the
  row, no shuffle;
* exploded: one row per message ``(sample key, pos, role, content)`` -- sample
  checks become partial aggregates, so even a sample with a huge number of
  messages never has to be collected into one task.

Bad samples are not raised at the first error: ``error_reason`` marks them and
callers choose ``quarantine`` (split good/bad) or ``strict`` (fail the job).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill.functions import text as TX

def _role_map() -> Column:
    return F.create_map(*[x for k, v in C.ROLE_ALIASES.items() for x in (F.lit(k), F.lit(v))])


def normalize_role(role) -> Column:
    """strip + lower, then the alias table (human/prompt/... -> user, ...)."""
    r = F.lower(TX.py_strip(F.coalesce(TX.col(role).cast("string"), F.lit("None"))))
    return F.coalesce(F.try_element_at(_role_map(), r), r)


def message_error(role_n, content) -> Column:
    """Per-message problem, role checked before content; null when fine."""
    c = TX.col(content)
    return (
        F.when(~TX.col(role_n).isin(*C.ALLOWED_ROLES), F.lit("unsupported_role"))
        .when(c.isNull() | (TX.py_strip(c) == ""), F.lit("blank_content"))
    )


# --------------------------------------------------------------------------
# QA records
# --------------------------------------------------------------------------

def first_value(df: DataFrame, names) -> Column:
    """First non-null among the alias columns that exist."""
    cols = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*cols) if cols else F.lit(None).cast("string")


def qa_to_messages(df: DataFrame, prompt_aliases=C.PROMPT_ALIASES, answer_aliases=C.ANSWER_ALIASES,
                   default_system_prompt: str | None = None, system_col: str | None = "system_prompt") -> DataFrame:
    """Adds ``messages`` ([system], user, assistant) and ``error_reason``
    (missing prompt/answer). The system prompt is the record's
    (``system_col``), else ``default_system_prompt`` (the record defaults');
    empty strings count as absent. ``system_col=None`` leaves the system
    message to the caller."""
    prompt = first_value(df, prompt_aliases)
    answer = first_value(df, answer_aliases)
    sys_cols = [TX.py_truthy_str(F.col(system_col))] if system_col and system_col in df.columns else []
    if default_system_prompt:
        sys_cols.append(F.lit(default_system_prompt))
    system = F.coalesce(*sys_cols) if sys_cols else F.lit(None).cast("string")
    msg = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    msgs = F.filter(F.array(F.when(system.isNotNull(), msg("system", system)), msg("user", TX.py_strip(prompt)),
                            msg("assistant", TX.py_strip(answer))), lambda m: m.isNotNull())
    err = F.when(prompt.isNull() | answer.isNull(), F.lit("missing_prompt_or_answer"))
    return df.withColumns({"messages": F.when(err.isNull(), msgs), "error_reason": err})


def default_id(id_col, source_id: str, stem: str, record_index, line_index) -> Column:
    """``id or f"{source_id}_{stem}_{record_index}_{line_index}"`` (falsy id replaced)."""
    fallback = F.concat_ws("_", F.lit(source_id), F.lit(stem), TX.col(record_index).cast("string"),
                           TX.col(line_index).cast("string"))
    return F.coalesce(TX.py_truthy_str(TX.col(id_col).cast("string")), fallback)


# --------------------------------------------------------------------------
# Messages: nested form
# --------------------------------------------------------------------------

def normalize_messages_nested(messages, sample_system_prompt=None,
                              default_system_prompt: str = C.DEFAULT_SYSTEM_PROMPT) -> Column:
    """struct(messages, error_reason) for one ``ARRAY<STRUCT<role, content>>``:
    roles normalised, contents stripped, a system message prepended when the
    first message is not one, at least one assistant message required."""
    m = TX.col(messages)
    norm = F.transform(m, lambda x: F.struct(normalize_role(x["role"]).alias("role"),
                                             x["content"].alias("raw"),
                                             TX.py_strip(x["content"]).alias("content")))
    errs = F.filter(F.transform(norm, lambda x: message_error(x["role"], x["raw"])), lambda e: e.isNotNull())
    clean = F.transform(norm, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    sys_text = F.coalesce(TX.py_truthy_str(TX.col(sample_system_prompt)) if sample_system_prompt is not None else F.lit(None).cast("string"),
                          F.lit(default_system_prompt))
    first_role = F.element_at(clean, 1)["role"]
    with_sys = F.when(first_role != "system",
                      F.concat(F.array(F.struct(F.lit("system").alias("role"), sys_text.alias("content"))), clean)
                      ).otherwise(clean)
    err = (
        F.when(m.isNull() | (F.size(m) <= 0), F.lit("empty_messages"))
        .when(F.size(errs) > 0, F.element_at(errs, 1))
        .when(~F.exists(clean, lambda x: x["role"] == "assistant"), F.lit("no_assistant"))
    )
    return F.struct(F.when(err.isNull(), with_sys).alias("messages"), err.alias("error_reason"))


# --------------------------------------------------------------------------
# Messages: exploded form
# --------------------------------------------------------------------------

def normalize_message_rows(rows: DataFrame, key: str, pos: str, role: str = "role", content: str = "content",
                           system_prompts: DataFrame | None = None,
                           default_system_prompt: str = C.DEFAULT_SYSTEM_PROMPT,
                           salt_buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Exploded messages -> (messages, samples).

    ``messages``: key, pos (0-based after injection), role, content for valid
    samples. ``samples``: key, n_messages, injected (system prepended),
    error_reason for every sample. Sample checks are partial aggregates over
    the message rows (first message by pos, first error by pos, assistant
    count), then a join on the sample key brings them back to the messages.
    ``salt_buckets`` spreads each key's messages over that many join keys, for
    corpora with very long samples. ``pos`` must be the 0-based message ordinal within its sample.
    """
    m = rows.select(F.col(key).alias("key"), F.col(pos).alias("pos"),
                    normalize_role(F.col(role)).alias("role"), F.col(content).alias("raw"))
    m = m.withColumns({"content": TX.py_strip(F.col("raw")), "err": message_error(F.col("role"), F.col("raw"))})
    # Hash-aggregatable sample checks: the first message's "is system" flag as
    # min_by over a boolean, the first error as min over pos * 4 + code.
    codes = {"unsupported_role": 1, "blank_content": 2}
    code = F.when(F.col("err") == "unsupported_role", F.lit(codes["unsupported_role"])) \
        .when(F.col("err") == "blank_content", F.lit(codes["blank_content"]))
    per = m.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.min_by(F.col("role") == "system", F.col("pos")).alias("first_is_system"),
        F.min(F.col("pos").cast("bigint") * 4 + code).alias("first_err"),
        F.count_if(F.col("role") == "assistant").alias("n_assistant"),
    )
    err_code = F.pmod(F.col("first_err"), F.lit(4))
    first_err = F.when(err_code == 1, F.lit("unsupported_role")).when(err_code == 2, F.lit("blank_content"))
    err = F.coalesce(first_err, F.when(F.col("n_assistant") == 0, F.lit("no_assistant")))
    samples = per.select(
        F.col("key").alias(key), F.col("n_messages").cast("bigint").alias("n_messages"),
        (~F.col("first_is_system")).alias("injected"), err.alias("error_reason"))
    good = samples.filter(F.col("error_reason").isNull()).select(F.col(key).alias("key"), "injected")
    if salt_buckets:
        # the narrow sample side (key, flag) is replicated once per salt value
        salted = good.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        body = m.withColumn("_salt", F.pmod(F.col("pos"), F.lit(salt_buckets))).join(salted, ["key", "_salt"], "inner").drop("_salt")
    else:
        body = m.join(good, "key", "inner")
    # Positions are the sample's own 0-based ordinals (posexplode / turn
    # numbers); a prepended system message shifts them by one. No per-sample
    # window, so a very long sample is never gathered into one task.
    body = body.withColumn("pos", (F.col("pos") + F.col("injected").cast("int")).cast("bigint"))
    sys_rows = good.filter(F.col("injected")).select("key", F.lit(0).cast("bigint").alias("pos"),
                                                     F.lit("system").alias("role"))
    if system_prompts is not None:
        sp = system_prompts.select(F.col(key).alias("key"), TX.py_truthy_str(F.col("system_prompt")).alias("sp"))
        sys_rows = sys_rows.join(sp, "key", "left").withColumn("content", F.coalesce("sp", F.lit(default_system_prompt))).drop("sp")
    else:
        sys_rows = sys_rows.withColumn("content", F.lit(default_system_prompt))
    msgs = body.select("key", "pos", "role", "content").unionByName(sys_rows)
    return msgs.withColumnRenamed("key", key), samples


# --------------------------------------------------------------------------
# Defaults, ids, duplicates, summary
# --------------------------------------------------------------------------

SAMPLE_DEFAULT_FIELDS = ("category", "difficulty", "challenge_family", "split", "source", "license")


def merge_defaults(samples: DataFrame, record_defaults: DataFrame, on: list[str],
                   fields=SAMPLE_DEFAULT_FIELDS, artifact_fields=("language", "has_code")) -> DataFrame:
    """Layered defaults: sample value, else record default, else manifest
    default (``record_defaults`` already holds record-over-manifest values
    with ``d_`` prefixed columns), then the fixed fills ('unknown'). The join
    strategy is left to Spark."""
    ctl = record_defaults
    j = samples.join(ctl, on, "left")
    out = {}
    for f in fields:
        s = F.col(f) if f in samples.columns else F.lit(None).cast("string")
        d = F.col(f"d_{f}") if f"d_{f}" in ctl.columns else F.lit(None).cast("string")
        merged = F.coalesce(s, d)
        if f in ("category", "difficulty", "challenge_family", "source", "license"):
            merged = F.coalesce(merged, F.lit(C.UNKNOWN))
        out[f] = merged
    arts = []
    for a in artifact_fields:
        s = F.col("artifacts")[a] if "artifacts" in samples.columns else F.lit(None)
        d = F.col("d_artifacts")[a] if "d_artifacts" in ctl.columns else F.lit(None)
        arts.append(F.coalesce(s, d).alias(a))
    out["artifacts"] = F.struct(*arts)
    keep = [c for c in samples.columns if c not in out]
    return j.select(*[F.col(c) for c in keep], *[v.alias(k) for k, v in out.items()])


def sample_id(id_col, category_col=None, mode: str = "plain", redacted_id=None) -> Column:
    """Output id: ``plain`` -> slugify(id); ``policy`` -> slugify(redacted id)
    + '_' + short_hash(original id); ``strict`` -> slug(lower(category)) (or
    'sample') + '_' + short_hash(original id)."""
    orig = TX.col(id_col).cast("string")
    if mode == "plain":
        return TX.slugify(orig)
    if mode == "policy":
        return F.concat(TX.slugify(TX.col(redacted_id) if redacted_id is not None else orig), F.lit("_"), TX.short_hash(orig))
    if mode == "strict":
        cat = F.coalesce(TX.col(category_col).cast("string"), F.lit("sample"))
        return F.concat(TX.slugify(F.lower(cat)), F.lit("_"), TX.short_hash(orig))
    raise ValueError(mode)


def duplicate_ids(samples: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids used more than once: (id, n). Partial aggregation keeps a hot id cheap."""
    return samples.groupBy(id_col).agg(F.count(F.lit(1)).cast("bigint").alias("n")).filter(F.col("n") > 1)


def dataset_counts(samples: DataFrame, manifest_col: str = "manifest") -> DataFrame:
    """(dimension, value, n): samples by split (missing -> 'dataset'), category,
    source and manifest, and in total, in one grouping-sets aggregate."""
    split = F.coalesce(TX.py_truthy_str(F.col("split")), F.lit("dataset")).alias("split")
    base = samples.select(split, F.col("category").cast("string").alias("category"),
                          F.col("source").cast("string").alias("source"), F.col(manifest_col).cast("string").alias("manifest"))
    dims = ["split", "category", "source", "manifest"]
    g = base.groupingSets([*[[d] for d in dims], []], *dims).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))
    # grouping_id has a bit for each dimension that is not grouped by
    name = value = None
    for k, d in enumerate(dims):
        mine = F.col("gid") == 15 - (8 >> k)
        name = F.when(mine, F.lit(d)) if name is None else name.when(mine, F.lit(d))
        value = F.when(mine, F.coalesce(F.col(d), F.lit("None"))) if value is None else value.when(mine, F.coalesce(F.col(d), F.lit("None")))
    return g.select(name.otherwise(F.lit("total")).alias("dimension"), value.alias("value"), "n")


def dataset_summary(samples: DataFrame, manifest_col: str = "manifest") -> DataFrame:
    """The counts as one document of sorted maps. Its size is that of the sets
    of splits, categories, sources and manifests; ``dataset_counts`` has the
    same as rows."""
    g = dataset_counts(samples, manifest_col)
    def m(d):
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("dimension") == d, F.struct("value", "n")))))
    return g.agg(
        F.coalesce(F.sum(F.when(F.col("dimension") == "total", F.col("n"))), F.lit(0)).cast("bigint").alias("total_samples"),
        m("split").alias("splits"), m("category").alias("categories"), m("source").alias("sources"), m("manifest").alias("manifests"),
    ).withColumn("files_written", F.transform(F.map_keys("splits"), lambda s: F.concat(s, F.lit(".jsonl"))))
