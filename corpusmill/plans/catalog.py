"""Registered queries: one callable per operator of the inventory.

Each takes ``(spark, sf_dir)``, reads the driver tables (or a fixture derived
from them by SQL) and returns a DataFrame whose columns are aliased to the
names the DuckDB oracle uses. Nested results are flattened or exploded so the
two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import CurationConfig
from corpusmill.functions import text as TX
from corpusmill.functions import urls as U
from corpusmill.operators import writeups as W
from corpusmill.operators.transform import route_target
from corpusmill.plans.fixtures import fixture
from corpusmill.session import load_tables, run_sql, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def long_form(one_row: DataFrame, columns: list[str], map_col: str | None = None, map_prefix: str = "") -> DataFrame:
    """One-row summary -> (metric, value) rows, so engines compare exactly."""
    parts = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in columns]
    arr = F.array(*parts)
    if map_col:
        extra = F.transform(F.map_entries(F.col(map_col)),
                            lambda e: F.struct(F.concat(F.lit(map_prefix), e["key"]).alias("metric"),
                                               e["value"].cast("bigint").alias("value")))
        arr = F.concat(arr, extra)
    return one_row.select(F.inline(arr))


# ---------------------------------------------------------------------------
# Stage W: write-up curation
# ---------------------------------------------------------------------------

def _curated(spark, sf_dir, cfg: CurationConfig = W.DEFAULT):
    return W.curate_writeups(fixture(spark, sf_dir, "transformed_fx"), fixture(spark, sf_dir, "enumeration_fx"), cfg)


def writeup_samples_flat(samples: DataFrame) -> DataFrame:
    return samples.select(
        "id", "category", "split", "difficulty", "source", "license", "challenge_family",
        F.col("messages")[1]["content"].alias("user_prompt"),
        F.col("messages")[2]["content"].alias("content"),
        F.col("artifacts.has_code").alias("has_code"),
        F.col("artifacts.source_url").alias("source_url"),
    )


@query("writeup_flagship")
def q_writeup_flagship(spark, sf_dir):
    return writeup_samples_flat(W.build_samples(_curated(spark, sf_dir)))


@query("build_samples")
def q_build_samples(spark, sf_dir):
    s = W.build_samples(_curated(spark, sf_dir))
    # outer: a built sample always has 3 messages, and the outer form keeps
    # Catalyst from inferring (and pushing down) a size(messages) > 0 filter
    # that would re-derive the whole message array below the join.
    return s.select("id", F.posexplode_outer("messages").alias("pos", "m")).select(
        "id", F.col("pos").cast("bigint").alias("pos"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@query("curation_summary")
def q_curation_summary(spark, sf_dir):
    summary = W.curation_summary(_curated(spark, sf_dir))
    cols = ["input_ok_rows", "selected_rows", "dropped_short", "dropped_low_signal", "train_rows", "eval_rows"]
    return long_form(summary, cols, "categories", "category:")


def _ok_rows(spark, sf_dir):
    return W.prepare_rows(fixture(spark, sf_dir, "transformed_fx"))


@query("select_preferred")
def q_select_preferred(spark, sf_dir):
    rows = _ok_rows(spark, sf_dir)
    return W.select_preferred(rows, fixture(spark, sf_dir, "enumeration_fx")).select("ord", "group_key", "group_rows")


@query("link_groups")
def q_link_groups(spark, sf_dir):
    """Canonical group key of every ok row (left join on the link table)."""
    rows = _ok_rows(spark, sf_dir)
    lt = W.link_table(fixture(spark, sf_dir, "enumeration_fx"))
    j = rows.join(lt, rows["url"] == lt["original_url"], "left")
    return j.select(rows["ord"], rows["url"], F.coalesce(lt["agg_url"], rows["url"]).alias("group_key"))


@query("clean_content")
def q_clean_content(spark, sf_dir):
    rows = _ok_rows(spark, sf_dir)
    clean = TX.with_clean_content(spread(rows.select("ord", "transform_method", "content")), "content", "transform_method", "clean")
    return clean.select("ord", "transform_method", F.col("clean").alias("content"))


@query("html_to_text")
def q_html_to_text(spark, sf_dir):
    pages = spread(load_tables(spark, sf_dir, ["pages"])["pages"])
    return TX.with_html_text(pages.select("page_id", "html"), "html", "text").select("page_id", "text")


@query("looks_like_html")
def q_looks_like_html(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["pages", "documents"])
    pages = t["pages"].select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), TX.looks_like_html(TX.py_strip("html")).alias("is_html"))
    docs = t["documents"].select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), TX.looks_like_html(TX.py_strip("text")).alias("is_html"))
    return pages.unionByName(docs)


@query("strip_preamble")
def q_strip_preamble(spark, sf_dir):
    fx = spread(fixture(spark, sf_dir, "transformed_fx"))
    return fx.select("ord", TX.strip_preamble(F.col("content")).alias("content"))


@query("redact_flags")
def q_redact_flags(spark, sf_dir):
    fx = spread(fixture(spark, sf_dir, "transformed_fx"))
    red = TX.redact_flags(F.col("content"))
    return fx.select("ord", red.alias("content"), F.contains(red, F.lit("<FLAG>")).alias("has_flag"))


@query("truncate_min_length")
def q_truncate_min_length(spark, sf_dir):
    rows = _ok_rows(spark, sf_dir)
    cfg = W.DEFAULT
    t = W.with_curated_text(spread(rows.select("ord", "transform_method", "content")), "content", cfg).select("ord", "content")
    n = F.length("content").cast("bigint")
    return t.select("ord", "content", n.alias("n_chars"), (n < cfg.min_chars).alias("too_short"))


@query("low_signal_filter")
def q_low_signal_filter(spark, sf_dir):
    rows = _ok_rows(spark, sf_dir)
    t = W.with_curated_text(spread(rows.select("ord", "url", "transform_method", "content")), "text")
    return t.select("ord", "url", W.keep_record(F.col("url"), F.col("text")).alias("keep"))


@query("infer_category")
def q_infer_category(spark, sf_dir):
    fx = spread(fixture(spark, sf_dir, "transformed_fx"))
    return W.with_category(fx.select("ord", "final_url", "content"), "final_url", "content").select("ord", "category")


@query("hash_split")
def q_hash_split(spark, sf_dir):
    fx = fixture(spark, sf_dir, "transformed_fx")
    k = F.col("final_url")
    return fx.select("ord", TX.short_hash(k).alias("short_hash"), TX.hash_bucket(k).cast("bigint").alias("bucket"),
                     W.split_for(k).alias("split"))


@query("has_code")
def q_has_code(spark, sf_dir):
    fx = fixture(spark, sf_dir, "transformed_fx")
    return fx.select("ord", TX.has_code(F.col("content")).alias("has_code"))


@query("url_parts")
def q_url_parts(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["pages"])["pages"]
    fx = fixture(spark, sf_dir, "transformed_fx")
    urls = t.select(F.col("page_id").alias("id"), F.col("url")).unionByName(
        fx.select((F.col("ord") + 1000000).alias("id"), F.col("final_url").alias("url")))
    return urls.select("id", "url", U.url_netloc("url").alias("netloc"), U.url_host("url").alias("host"),
                       U.url_path("url").alias("path"))


@query("route_targets")
def q_route_targets(spark, sf_dir):
    fx = fixture(spark, sf_dir, "transformed_fx")
    r = route_target(F.col("final_url"), None, F.col("body_path"))
    return fx.select("ord", r["method"].alias("transform_method"), r["url"].alias("transform_url"))


@query("github_raw_url")
def q_github_raw_url(spark, sf_dir):
    fx = fixture(spark, sf_dir, "transformed_fx")
    gh = fx.filter(U.url_host("final_url").isin("github.com", "www.github.com"))
    return gh.select("ord", "final_url", U.github_raw_url(F.col("final_url")).alias("raw_url"))


# ---------------------------------------------------------------------------
# Stages L, F, R, T: links, fetch log and cache, review ledger, transform
# ---------------------------------------------------------------------------

from corpusmill.operators import fetch as FE  # noqa: E402
from corpusmill.operators import links as LK  # noqa: E402
from corpusmill.operators import review as RV  # noqa: E402
from corpusmill.operators import transform as TR  # noqa: E402

PAGE_LINK_PATTERN = r'href="(/[^"]+)"'
BATCH_NAME = "ctftime batch/01"
FETCHED_AT = "2026-01-01T00:00:00+00:00"


@query("url_list")
def q_url_list(spark, sf_dir):
    return FE.url_list(fixture(spark, sf_dir, "urls_fx"))


@query("extract_links")
def q_extract_links(spark, sf_dir):
    pages = load_tables(spark, sf_dir, ["pages"])["pages"]
    hits = LK.extract_links(pages, "html", "page_id", PAGE_LINK_PATTERN)
    return LK.ordered_distinct(hits, "url", "page_ord", "pos")


@query("original_link")
def q_original_link(spark, sf_dir):
    d = spread(fixture(spark, sf_dir, "detail_fx"))
    return d.select("page_id", LK.original_link(F.col("html")).alias("original_url"))


def _link_rows(spark, sf_dir):
    d = fixture(spark, sf_dir, "detail_fx").withColumn(
        "agg_url", F.concat(F.lit("https://ctftime.org/writeup/"), F.col("page_id").cast("string")))
    return LK.link_rows(d.withColumn("index", F.col("page_id") + 1), "agg_url", "html", "index")


@query("target_urls")
def q_target_urls(spark, sf_dir):
    return LK.target_urls(_link_rows(spark, sf_dir), "both").select(
        "url", F.col("index").cast("bigint").alias("index"), "pos")


@query("enumeration_summary")
def q_enumeration_summary(spark, sf_dir):
    rows = _link_rows(spark, sf_dir)
    s = LK.enumeration_summary(rows, LK.target_urls(rows, "both"))
    return long_form(s, ["writeup_pages", "target_urls", "original_errors"])


@query("fetch_log")
def q_fetch_log(spark, sf_dir):
    return FE.fetch_log(fixture(spark, sf_dir, "fetch_fx"))


def _fetch_records(spark, sf_dir):
    log = FE.fetch_log(fixture(spark, sf_dir, "fetch_fx"), body_dir="data/raw/scraped/batch/files")
    ok = F.col("status") != "error"
    return log.withColumns({
        "fetched_at": F.lit(FETCHED_AT),
        "status_code": F.when(ok, F.lit(200)),
        "error": F.when(~ok, F.lit("ConnectError: connection failed")),
    })


def _ledger(spark, sf_dir):
    return RV.review_ledger(_fetch_records(spark, sf_dir), BATCH_NAME, approve_training=True,
                            review_status="approved_for_training", permission_basis="  explicit permission ")


@query("review_ledger")
def q_review_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir).drop("ord")


@query("review_summary")
def q_review_summary(spark, sf_dir):
    led = RV.review_ledger(_fetch_records(spark, sf_dir), BATCH_NAME, approve_redistribution=True)
    return long_form(RV.review_summary(led), ["records", "pending_reviews", "approved_for_training", "approved_for_redistribution"])


def _reviewed(spark, sf_dir):
    """Ledger after a reviewer revoked training approval on every 5th row."""
    led = _ledger(spark, sf_dir)
    return led.withColumn("allowed_for_training",
                          F.when(F.col("ord") % 5 == 0, F.lit(False)).otherwise(F.col("allowed_for_training")))


@query("approved_rows")
def q_approved_rows(spark, sf_dir):
    return RV.approved_rows(_reviewed(spark, sf_dir)).select("review_id", "source_url", "fetch_status")


@query("approved_rows_limited")
def q_approved_rows_limited(spark, sf_dir):
    return RV.approved_rows_limited(_reviewed(spark, sf_dir), 25).select("review_id", "source_url", "fetch_status")


@query("cache_lookup")
def q_cache_lookup(spark, sf_dir):
    urls = fixture(spark, sf_dir, "fetch_fx").select("idx", "url")
    probe = FE.cache_probe(urls, fixture(spark, sf_dir, "cache_fx"))
    return probe.select("idx", "url", F.col("cache_hit").alias("hit"), F.col("cache_body_hash").alias("body_hash"))


@query("cache_upsert")
def q_cache_upsert(spark, sf_dir):
    fx = fixture(spark, sf_dir, "fetch_fx").filter(F.col("status") == "ok")
    updates = fx.select("url", F.lit("ok").alias("status"), F.sha1(F.col("body")).alias("body_hash"),
                        (F.col("idx") + 2000000).alias("ord"))
    return FE.cache_upsert(fixture(spark, sf_dir, "cache_fx"), updates).select(
        "cache_key", "status", "body_hash", F.col("ord").cast("bigint").alias("ord"))


@query("normalize_text")
def q_normalize_text(spark, sf_dir):
    fx = spread(fixture(spark, sf_dir, "crlf_fx"))
    return TR.landed_text(fx).select("doc_id", "content", "content_sha256")


@query("transform_summary")
def q_transform_summary(spark, sf_dir):
    fx = fixture(spark, sf_dir, "transformed_fx")
    r = route_target(F.col("final_url"), None, F.col("body_path"))
    t = fx.withColumn("transform_method", r["method"])
    return long_form(TR.transform_summary(t, fx), ["input_rows", "selected_rows", "successes", "errors"], "methods", "method:")


# ---------------------------------------------------------------------------
# Stage D: dataset build (QA / messages records)
# ---------------------------------------------------------------------------

from corpusmill import config as CF  # noqa: E402
from corpusmill.operators import records as RC  # noqa: E402

QA_PROMPTS = ("prompt", "question", "user_text")
QA_ANSWERS = ("answer", "assistant", "completion")


def _qa(spark, sf_dir):
    """QA records with their default ids: line number = conv_id * 100 + turn + 1
    in a file 'qa' of record 0 of source 'qa_source'."""
    fx = fixture(spark, sf_dir, "qa_fx").withColumn("line", F.col("conv_id") * 100 + F.col("turn") + 1)
    return fx.withColumn("raw_id", RC.default_id("id", "qa_source", "qa", F.lit(0), F.col("line")))


def _explode_messages(df, key):
    return df.select(key, F.posexplode_outer("messages").alias("pos", "m")).filter(F.col("m").isNotNull()).select(
        key, F.col("pos").cast("bigint").alias("pos"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@query("qa_to_messages")
def q_qa_to_messages(spark, sf_dir):
    qa = RC.qa_to_messages(_qa(spark, sf_dir), QA_PROMPTS, QA_ANSWERS, CF.DEFAULT_SYSTEM_PROMPT)
    return _explode_messages(qa.withColumn("id", RC.sample_id("raw_id")), "id")


@query("default_ids")
def q_default_ids(spark, sf_dir):
    return _qa(spark, sf_dir).select("conv_id", "turn", F.col("raw_id").alias("id"))


@query("slugify_ids")
def q_slugify_ids(spark, sf_dir):
    return _qa(spark, sf_dir).select("conv_id", "turn", RC.sample_id("raw_id").alias("id"))


@query("anonymize_ids")
def q_anonymize_ids(spark, sf_dir):
    qa = _qa(spark, sf_dir)
    redacted = F.regexp_replace(F.col("raw_id"), "(?iu)qa", "item")
    return qa.select("conv_id", "turn",
                     RC.sample_id("raw_id", "category", "strict").alias("id_strict"),
                     RC.sample_id("raw_id", mode="policy", redacted_id=redacted).alias("id_policy"))


def _messages(spark, sf_dir):
    return RC.normalize_message_rows(fixture(spark, sf_dir, "messages_fx"), "conv_id", "turn")


@query("messages_normalize")
def q_messages_normalize(spark, sf_dir):
    return _messages(spark, sf_dir)[0]


@query("message_quarantine")
def q_message_quarantine(spark, sf_dir):
    return _messages(spark, sf_dir)[1].filter(F.col("error_reason").isNotNull()).select("conv_id", "n_messages", "error_reason")


@query("system_injection")
def q_system_injection(spark, sf_dir):
    return _messages(spark, sf_dir)[1].filter(F.col("error_reason").isNull()).select("conv_id", "injected")


RECORD_DEFAULTS_SQL = """
select record_index,
  case record_index when 0 then 'rev' when 1 then 'pwn' end as d_category,
  case record_index when 0 then 'easy' when 1 then 'hard' else 'medium' end as d_difficulty,
  case record_index when 0 then 'warmup' when 2 then 'heap' end as d_challenge_family,
  case record_index when 0 then 'train' when 1 then 'eval' end as d_split,
  'self_authored' as d_source,
  case when record_index = 2 then 'internal_or_permitted' end as d_license,
  named_struct('language', case when record_index < 2 then 'python' end, 'has_code', record_index = 0) as d_artifacts
from (select distinct conv_id % 3 as record_index from qa_fx) r
"""


def _merged(spark, sf_dir):
    qa = _qa(spark, sf_dir).withColumn("record_index", F.col("conv_id") % 3)
    ctl = run_sql(spark, RECORD_DEFAULTS_SQL, {"qa_fx": qa})
    return RC.merge_defaults(qa, ctl, ["record_index"])


@query("defaults_merge")
def q_defaults_merge(spark, sf_dir):
    m = _merged(spark, sf_dir)
    return m.select(F.col("raw_id").alias("id"), "category", "difficulty", "challenge_family", "split", "source",
                    "license", F.col("artifacts.language").alias("language"), F.col("artifacts.has_code").alias("has_code"))


@query("duplicate_ids")
def q_duplicate_ids(spark, sf_dir):
    docs = load_tables(spark, sf_dir, ["documents"])["documents"]
    ids = docs.select(F.concat(F.lit("doc_"), TX.short_hash(F.col("text"))).alias("id"))
    return RC.duplicate_ids(ids)


def _metric_entry(prefix):
    def fn(e):
        return F.struct(F.concat(F.lit(prefix), e["key"]).alias("metric"), e["value"].cast("bigint").alias("value"))
    return fn


@query("dataset_summary")
def q_dataset_summary(spark, sf_dir):
    m = _merged(spark, sf_dir).withColumn("manifest", F.concat(F.lit("m"), (F.col("conv_id") % 2).cast("string"), F.lit(".json")))
    s = RC.dataset_summary(m)
    parts = [F.array(F.struct(F.lit("total_samples").alias("metric"), F.col("total_samples").alias("value")))]
    for name, prefix in (("splits", "split:"), ("categories", "category:"), ("sources", "source:"), ("manifests", "manifest:")):
        parts.append(F.transform(F.map_entries(name), _metric_entry(prefix)))
    return s.select(F.inline(F.concat(*parts)))


MANIFEST_RECORDS_SQL = """
select manifest_id, source, not (manifest_id % 10 = 9) as enabled,
  case when manifest_id % 2 = 0
       then array(named_struct('path', cast(null as string), 'paths', array(concat('data/m', cast(manifest_id as string), '/a.jsonl'),
                                                                           concat('data/m', cast(manifest_id as string), '/b.jsonl')),
                               'format', 'jsonl_messages'),
                  named_struct('path', concat('data/m', cast(manifest_id as string), '/qa.json'), 'paths', cast(null as array<string>),
                               'format', 'json_qa'))
       else array(named_struct('path', concat('data/m', cast(manifest_id as string), '/qa.jsonl'), 'paths', cast(null as array<string>),
                               'format', 'jsonl_qa')) end as records
from manifest_fx
"""


@query("manifest_records")
def q_manifest_records(spark, sf_dir):
    from corpusmill.sources.manifests import manifest_records

    control = run_sql(spark, MANIFEST_RECORDS_SQL, {"manifest_fx": fixture(spark, sf_dir, "manifest_fx")})
    return manifest_records(control, "manifest_id").select(
        "manifest_id", F.col("record_index").cast("bigint").alias("record_index"),
        F.col("path_index").cast("bigint").alias("path_index"), "path", "format")


# ---------------------------------------------------------------------------
# Redaction and the review gate
# ---------------------------------------------------------------------------

from corpusmill.operators import gate as GT  # noqa: E402
from corpusmill.operators import redact as RD  # noqa: E402

DOC_POLICY = {
    "drop_keys": ["title", "source_path"],
    "rules": [
        {"pattern": 'token = "[0-9a-f]{40}"', "replacement": "<TOKEN>"},
        {"pattern": r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "replacement": "<EMAIL>", "flags": ["IGNORECASE"]},
    ],
}


@query("redact_rules")
def q_redact_rules(spark, sf_dir):
    docs = spread(load_tables(spark, sf_dir, ["documents"])["documents"])
    policy = RD.load_policy(DOC_POLICY)
    return RD.apply_policy(docs.select("doc_id", "text", "lang", "source"), policy, keep=("doc_id",))


def _nested_records(spark, sf_dir):
    qa = _qa(spark, sf_dir)
    return qa.select(
        F.col("raw_id").alias("id"),
        F.col("category"),
        F.concat(F.lit("Contest "), F.col("conv_id").cast("string")).alias("contest_name"),
        F.struct(F.lit("python").alias("language"), F.concat(F.lit("P"), F.col("turn").cast("string")).alias("problem_title"),
                 F.struct(F.col("conv_id").cast("string").alias("event_name"), F.lit("ok").alias("state")).alias("meta")).alias("artifacts"),
        F.array(F.struct(F.lit("t1").alias("tag"), F.lit("x").alias("title"))).alias("tags"),
    )


@query("drop_metadata")
def q_drop_metadata(spark, sf_dir):
    d = RD.drop_metadata(_nested_records(spark, sf_dir))
    return d.select("id", F.to_json(F.struct(*[c for c in d.columns if c != "id"]), {"ignoreNullFields": "false"}).alias("doc"))


GATE_SQL = """
select manifest_id, source, source_bucket, allowed_for_training, allowed_for_redistribution, review_status,
  redistribution_status,
  case when manifest_id % 17 = 0 then concat('old/', source_ledger_path) else source_ledger_path end as source_ledger_path
from manifest_fx
"""


@query("review_gate")
def q_review_gate(spark, sf_dir):
    fx = fixture(spark, sf_dir, "manifest_fx")
    recs = run_sql(spark, GATE_SQL, {"manifest_fx": fx})
    listing = fx.filter(F.col("source_ledger_path").isNotNull()).select("source_ledger_path")
    g = GT.review_gate(recs, "manifest_id", listing)
    return g.select("manifest_id", "requires_review", "gate_error")


# ---------------------------------------------------------------------------
# Stages C and E: chat rendering and evaluation
# ---------------------------------------------------------------------------

from corpusmill.operators import evaluation as EV  # noqa: E402
from corpusmill.operators import render as RN  # noqa: E402

CASE_KEYS = {"exact": "exact_v", "contains": "contains_v", "regex": "regex_v"}


def _cases(spark, sf_dir):
    """Eval cases; the line index of item k is k + 1 (one case per line)."""
    c = fixture(spark, sf_dir, "cases_fx")
    return c.withColumn("id", EV.default_case_id("id", F.col("item_id") + 1))


def _scored(spark, sf_dir):
    cases = _cases(spark, sf_dir)
    responses = fixture(spark, sf_dir, "responses_fx")
    return EV.score_cases(cases, responses, "item_id", checks=EV.normalize_checks(cases, key_columns=CASE_KEYS))


@query("eval_default_ids")
def q_eval_default_ids(spark, sf_dir):
    return _cases(spark, sf_dir).select("item_id", "id")


@query("eval_checks")
def q_eval_checks(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("id", F.posexplode("checks_result").alias("pos", "r")).select(
        "id", F.col("pos").cast("bigint").alias("pos"), F.col("r.type").alias("type"), F.col("r.expected").alias("expected"),
        F.col("r.passed").alias("passed"), F.col("r.detail").alias("detail"))


@query("eval_cases")
def q_eval_cases(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("id", "category", "passed", F.size("checks_result").cast("bigint").alias("n_checks"), "response")


@query("eval_report")
def q_eval_report(spark, sf_dir):
    return EV.eval_report(_scored(spark, sf_dir)).select("category", "total", "passed", "failed", "pass_rate")


@query("render_chat_text")
def q_render_chat_text(spark, sf_dir):
    s = W.build_samples(_curated(spark, sf_dir))
    return s.select("id", RN.render_messages(F.col("messages")).alias("text"))


@query("render_eval_prompt")
def q_render_eval_prompt(spark, sf_dir):
    c = _cases(spark, sf_dir)
    with_msgs = F.when(F.col("item_id") % 7 == 3, F.array(
        F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))))
    return c.select("id", RN.render_prompt(with_msgs, F.col("prompt"), CF.DEFAULT_SYSTEM_PROMPT).alias("text"),
                    RN.render_prompt(with_msgs, F.col("prompt"), None).alias("text_no_system"))
