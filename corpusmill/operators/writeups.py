"""Stage W: transformed write-ups -> grouped, cleaned, redacted, filtered,
classified and split chat samples (FLT1-3, JOIN1, WIN1/4, PRJ26-37, AGG3/4).

Plan shape (see README "write-up curation"):

* keys side (narrow, no text): url, host priority and raw length per row;
  best row per URL, then per canonical group, both as hash aggregates with
  map-side partial aggregation, so a hot URL or a hot group never lands whole
  on one task;
* text side: every ok row is cleaned, redacted, truncated and classified in one
  narrow projection *before* any exchange, and rows that will be dropped carry
  no text, so the one exchange of text moves at most ``max_chars`` per row;
* the two sides meet on the row ordinal (unique key, no skew).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.config import CurationConfig
from corpusmill.functions import ordering as ORD
from corpusmill.functions import text as TX
from corpusmill.functions import urls as U
from corpusmill.operators.transform import route_method
from corpusmill.session import spread, staged

DEFAULT = CurationConfig()


# --------------------------------------------------------------------------
# Column-level pieces
# --------------------------------------------------------------------------

def _scores(hay: Column, cfg: CurationConfig):
    if cfg.keyword_match == "word":
        def hits(kws):
            total = F.lit(0)
            for k in kws:
                total = total + hay.rlike(r"(?U)\b" + re.escape(k) + r"\b").cast("int")
            return total
        return [(cat, hits(kws)) for cat, kws in cfg.category_keywords.items()]
    return [(cat, TX.count_contains(hay, kws)) for cat, kws in cfg.category_keywords.items()]


def _scores_by_name(hay: str, cfg: CurationConfig):
    if cfg.keyword_match == "word":
        return _scores(F.col(hay), cfg)
    return [(cat, TX.count_contains(hay, kws)) for cat, kws in cfg.category_keywords.items()]


def _pick(scores, cfg: CurationConfig) -> Column:
    best = F.greatest(*[s for _, s in scores]) if len(scores) > 1 else scores[0][1]
    out = F.when(best <= 0, F.lit(cfg.fallback_category))
    for cat, s in scores:
        out = out.when(s == best, F.lit(cat))
    return out


def infer_category(url, content, cfg: CurationConfig = DEFAULT) -> Column:
    """Most keyword hits (substring tests) in lower(url + '\\n' + content);
    ties go to the earlier category; no hit -> fallback."""
    hay = F.lower(F.concat(TX.col(url), F.lit("\n"), TX.col(content)))
    return _pick(_scores(hay, cfg), cfg)


def with_category(df: DataFrame, url: str, text: str, out: str = "category", cfg: CurationConfig = DEFAULT) -> DataFrame:
    """``infer_category`` as staged projections: the lower-cased haystack and
    one score column per category are materialised, so the expression stays
    small and each keyword test runs once per row."""
    hay = F.lower(F.concat(F.col(url), F.lit("\n"), F.col(text)))
    df = df.withColumn("_hay", hay)
    names = [f"_score_{i}" for i in range(len(cfg.category_keywords))]
    df = df.withColumns({n: sc for n, (_, sc) in zip(names, _scores_by_name("_hay", cfg))})
    df = df.withColumn("_best", F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0]))
    picked = F.when(F.col("_best") <= 0, F.lit(cfg.fallback_category))
    for n, cat in zip(names, cfg.category_keywords):
        picked = picked.when(F.col(n) == F.col("_best"), F.lit(cat))
    return df.withColumn(out, picked).drop("_hay", "_best", *names)


def keep_record(url, content, cfg: CurationConfig = DEFAULT) -> Column:
    """Low-signal filter: video hosts, medium profile pages, GitHub pages that
    are neither blob nor tree, medium pages with boilerplate markers."""
    return keep_record_parsed(U.url_host(url), U.url_path(url), content, cfg)


def keep_record_parsed(host, path, content, cfg: CurationConfig = DEFAULT) -> Column:
    """``keep_record`` on an already parsed host and path."""
    host, path = TX.col(host), TX.col(path)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    is_medium = host.endswith(cfg.medium_suffix)
    head = F.lower(F.substring(TX.col(content), 1, cfg.boilerplate_window))
    boiler = F.when(is_medium, TX.count_contains(head, cfg.boilerplate_markers)).otherwise(F.lit(0))
    return ~(
        host.isin(*cfg.low_signal_hosts)
        | (is_medium & path.rlike(r"^/@[^/]+/?\z"))
        | (host.isin(*cfg.github_hosts) & ~F.contains(path, F.lit("/blob/")) & ~F.contains(path, F.lit("/tree/")))
        | (is_medium & (boiler >= cfg.boilerplate_min_hits))
    )


def curated_text(content, method, cfg: CurationConfig = DEFAULT) -> Column:
    """clean -> redact flags -> truncate to max chars -> strip."""
    cleaned = TX.clean_content(content, method, cfg.unescape, cfg.preamble_marker)
    return TX.truncate(TX.redact_flags(cleaned), cfg.max_chars)


def split_for(group_key, cfg: CurationConfig = DEFAULT) -> Column:
    return F.when(TX.hash_bucket(group_key, cfg.eval_buckets) == 0, F.lit("eval")).otherwise(F.lit("train"))


# --------------------------------------------------------------------------
# Frames
# --------------------------------------------------------------------------

def link_table(links: DataFrame, ord_col: str = "ord") -> DataFrame:
    """(original_url -> aggregator_url), last row wins per original URL.

    Rows without an aggregator URL are ignored; pairs need both URLs."""
    agg_url = TX.py_strip(F.coalesce(F.col("ctftime_writeup_url"), F.lit("")))
    orig = TX.py_strip(F.coalesce(F.col("original_url"), F.lit("")))
    pairs = links.select(agg_url.alias("agg_url"), orig.alias("original_url"), F.col(ord_col).alias("ord"))
    pairs = pairs.filter((F.col("agg_url") != "") & (F.col("original_url") != ""))
    return pairs.groupBy("original_url").agg(F.max_by("agg_url", "ord").alias("agg_url"))


def prepare_rows(transformed: DataFrame, cfg: CurationConfig = DEFAULT) -> DataFrame:
    """ok rows with url, parsed host/path, transform method, raw length and
    host priority. Each parsed field is its own column so later steps reuse it."""
    cols = set(transformed.columns)
    src = F.col("source_url") if "source_url" in cols else None
    body = F.col("body_path") if "body_path" in cols else F.lit(None).cast("string")
    method = F.col("transform_method") if "transform_method" in cols else F.lit(None).cast("string")
    df = transformed.filter(F.col("transform_status") == "ok").select(
        F.col("ord").cast("bigint").alias("ord"),
        U.row_url(F.col("final_url"), src).alias("url"),
        method.alias("transform_method"),
        body.alias("body_path"),
        F.col("content"),
    )
    df = df.withColumns({"host": U.url_host("url"), "path": U.url_path("url")})
    if "transform_method" not in cols:
        routed = route_method(F.col("host"), F.col("path"), F.col("body_path"))
        df = df.withColumn("transform_method", routed)
    return df.withColumns({
        "prio": F.when(F.col("host").endswith(cfg.aggregator_suffix), F.lit(0)).otherwise(F.lit(1)),
        "raw_len": F.length(F.coalesce(F.col("content"), F.lit(""))).cast("bigint"),
    })


def select_preferred(rows: DataFrame, links: DataFrame | None, cfg: CurationConfig = DEFAULT) -> DataFrame:
    """Best row per canonical group: (non-aggregator host, content length) is
    the priority, ties keep the earliest row.

    Returns one row per group: ord (winner), group_key, first_ord (first
    appearance of the group), group_rows. Works on keys only; max over
    (prio, len, -ord) is associative, so per-URL then per-group partial
    aggregation gives the exact winner. The priority is packed into one
    decimal key so both levels are hash aggregates.
    """
    own = cfg.null_url == "own_group"
    solo = F.when((F.col("url") == "") & F.lit(own), F.col("ord"))
    key = ORD.best_key(F.col("prio"), F.col("raw_len"), F.col("ord"))
    per_url = rows.select("ord", "url", key.alias("best"), solo.alias("solo")).groupBy("url", "solo").agg(
        F.max("best").alias("best"),
        F.min("ord").alias("first_ord"),
        F.count(F.lit(1)).alias("n"),
    )
    if links is not None:
        lt = link_table(links)
        keyed = per_url.join(lt, per_url["url"] == lt["original_url"], "left").select(
            per_url["*"], F.coalesce(lt["agg_url"], per_url["url"]).alias("group_key"))
    else:
        keyed = per_url.withColumn("group_key", F.col("url"))
    groups = keyed.groupBy("group_key", "solo").agg(
        F.max("best").alias("best"), F.min("first_ord").alias("first_ord"), F.sum("n").alias("group_rows"))
    return groups.select(
        ORD.ord_of_best(F.col("best")).alias("ord"), "group_key", "first_ord", F.col("group_rows").cast("bigint").alias("group_rows"))


def with_curated_text(df: DataFrame, out: str, cfg: CurationConfig = DEFAULT) -> DataFrame:
    """``curated_text`` of (content, transform_method) as staged projections."""
    df = TX.with_clean_content(df, "content", "transform_method", "_clean", cfg.unescape, cfg.preamble_marker)
    return df.withColumn(out, TX.truncate(TX.redact_flags(F.col("_clean")), cfg.max_chars)).drop("_clean")


def curate_rows(rows: DataFrame, cfg: CurationConfig = DEFAULT, carry=()) -> DataFrame:
    """Per-row text work, staged as narrow projections (each step one column,
    so every stage stays small enough for whole-stage codegen): final content,
    drop reason, category, has_code. Dropped rows keep no text. ``carry`` names
    other columns that stay."""
    names = ["ord", "url", *carry]
    df = with_curated_text(rows.select(*names, "host", "path", "transform_method", "content"), "text", cfg)
    reason = (
        F.when(F.length(F.coalesce("text", F.lit(""))) < cfg.min_chars, F.lit("short"))
        .when(~keep_record_parsed(F.col("host"), F.col("path"), F.col("text"), cfg), F.lit("low_signal"))
    )
    df = df.select(*names, reason.alias("drop_reason"), "text")
    # Filters on drop_reason downstream must not be re-derived from the whole
    # text chain below this point; predicates on generator output are not
    # pushed below a Generate, so the chain is evaluated once per row.
    df = df.select(F.inline(F.array(F.struct(*names, "drop_reason", "text"))))
    kept = F.col("drop_reason").isNull()
    df = df.select(*names, "drop_reason", F.when(kept, F.col("text")).alias("content"))
    df = with_category(df, "url", "content", "category", cfg)
    return df.withColumn("has_code", TX.has_code(F.col("content")))


#: Winners sent to every task, with their group's facts; beyond so many rows a
#: filter of ``FILTER_BITS`` goes there instead and the facts are joined afterwards.
BROADCAST_WINNERS = 2_000_000
FILTER_BITS = 1 << 27


def _winners_only(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows whose ``ord`` may be a winner's, by a bitmap of hashed ordinals of fixed
    size (built and probed in the JVM). It lets a few others pass."""
    def bit(ord_col):
        return F.pmod(F.xxhash64(ord_col), F.lit(FILTER_BITS))
    # numbers from 1: a bucket holds 32 768 of them
    place = (bit(F.col("ord")) + 1).alias("p")
    maps = winners.select(place).groupBy(F.bitmap_bucket_number("p").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_map"))
    number = bit(F.col("ord")) + 1
    at = F.bitmap_bit_position(number)
    probe = rows.withColumn("_in", F.bitmap_bucket_number(number)).join(F.broadcast(maps), F.col("_in") == F.col("_bucket"))
    byte = F.conv(F.hex(F.substring("_map", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return probe.filter(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1).select(*rows.columns)


def curate_writeups(transformed: DataFrame, links: DataFrame | None = None, cfg: CurationConfig = DEFAULT,
                    stage_dir: str | None = None, broadcast_winners: int = BROADCAST_WINNERS) -> DataFrame:
    """One row per selected group: ord, group_key, first_ord, group_rows, url,
    drop_reason, content, category, has_code, split.

    The winners are found first, from keys and text lengths, and staged; the text
    is then scanned for them alone, so nothing else is cleaned and no raw text is
    shuffled. ``stage_dir`` (a folder under the shared checkpoint location) keeps
    the result as Parquet, for callers that read it more than once; it also cuts
    lineage, so recovery never repeats the text work."""
    rows = prepare_rows(transformed, cfg)
    winners = staged(select_preferred(rows, links, cfg), "winners")
    facts = winners.withColumnRenamed("ord", "_w")
    carry = [c for c in winners.columns if c != "ord"]
    if winners.count() <= broadcast_winners:
        met = rows.join(F.broadcast(facts), F.col("ord") == F.col("_w")).drop("_w")
        out = curate_rows(spread(met), cfg, carry)
    else:
        some = curate_rows(spread(_winners_only(rows, winners)), cfg)
        out = some.join(facts, F.col("ord") == F.col("_w")).drop("_w")
    out = out.withColumn("split", F.when(F.col("drop_reason").isNull(), split_for(F.col("group_key"), cfg)))
    if stage_dir is not None:
        out.write.mode("errorifexists").parquet(stage_dir)
        out = transformed.sparkSession.read.parquet(stage_dir)
    return out


def build_samples(curated: DataFrame, cfg: CurationConfig = DEFAULT) -> DataFrame:
    """Kept rows -> chat samples (id, metadata, 3 messages, artifacts, split)."""
    prompts = F.create_map(*[x for k, v in cfg.user_prompts.items() for x in (F.lit(k), F.lit(v))])
    cat = F.col("category")
    user = F.coalesce(F.try_element_at(prompts, cat), F.lit(cfg.user_prompts[cfg.fallback_category]))
    msg = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return curated.filter(F.col("drop_reason").isNull()).select(
        F.concat(cat, F.lit("_"), TX.short_hash(F.col("group_key"))).alias("id"),
        cat.alias("category"),
        F.lit("unknown").alias("difficulty"),
        F.lit(cfg.sample_source).alias("source"),
        F.lit(cfg.sample_license).alias("license"),
        cat.alias("challenge_family"),
        F.col("split"),
        F.array(msg("system", F.lit(cfg.system_prompt)), msg("user", user), msg("assistant", F.col("content"))).alias("messages"),
        F.struct(F.col("has_code").alias("has_code"), F.col("url").alias("source_url")).alias("artifacts"),
        F.col("first_ord"),
    )


def curation_summary(curated: DataFrame) -> DataFrame:
    """Counters of the curation run in one aggregation: input_ok_rows,
    selected_rows, dropped_short, dropped_low_signal, train_rows, eval_rows and
    the category counts of kept rows."""
    per = curated.groupBy("drop_reason", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("group_rows").alias("rows"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "eval").alias("eval"),
    )
    n = F.col("n")
    kept = F.col("drop_reason").isNull()
    return per.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("input_ok_rows"),
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("selected_rows"),
        F.coalesce(F.sum(F.when(F.col("drop_reason") == "short", n)), F.lit(0)).cast("bigint").alias("dropped_short"),
        F.coalesce(F.sum(F.when(F.col("drop_reason") == "low_signal", n)), F.lit(0)).cast("bigint").alias("dropped_low_signal"),
        F.coalesce(F.sum("train"), F.lit(0)).cast("bigint").alias("train_rows"),
        F.coalesce(F.sum("eval"), F.lit(0)).cast("bigint").alias("eval_rows"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(kept, F.struct(F.coalesce("category", F.lit("")), n))))).alias("categories"),
    )
