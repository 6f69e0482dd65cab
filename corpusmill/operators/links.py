"""Stage L: link enumeration over landed index/detail pages (PRJ38-40, WIN2, AGG9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill.functions import ordering as ORD
from corpusmill.functions import text as TX


def absolute_url(rel, base: str = C.AGGREGATOR_BASE_URL) -> Column:
    """Resolve an href against ``base`` for the forms the extractor emits:
    absolute URLs, protocol-relative ``//host/..`` and root-relative ``/path``."""
    rel = TX.col(rel)
    scheme = base.split("://", 1)[0]
    origin = base.split("://", 1)[0] + "://" + base.split("://", 1)[1].split("/", 1)[0]
    return (
        F.when(rel.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), rel)
        .when(rel.startswith("//"), F.concat(F.lit(scheme + ":"), rel))
        .when(rel.startswith("/"), F.concat(F.lit(origin), rel))
        .otherwise(F.concat(F.lit(base.rsplit("/", 1)[0] + "/"), rel))
    )


def extract_links(pages: DataFrame, html_col: str = "html", ord_col: str = "ord",
                  pattern: str = C.WRITEUP_LINK_PATTERN, base: str = C.AGGREGATOR_BASE_URL) -> DataFrame:
    """Every match of ``pattern`` (group 1) as an absolute URL, with its page
    ordinal and position: (url, page_ord, pos)."""
    hits = pages.select(F.col(ord_col).alias("page_ord"),
                        F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(pattern), 1)).alias("pos", "rel"))
    return hits.select(absolute_url("rel", base).alias("url"), "page_ord", F.col("pos").cast("bigint").alias("pos"))


def ordered_distinct(df: DataFrame, key: str, *order_cols: str) -> DataFrame:
    """First occurrence of each ``key`` in (order_cols) order: one row per key
    with the ordinal(s) of its first appearance. A hash aggregate with partial
    aggregation (one or two non-negative ordinals packed into one key), so a
    repeated key costs one row per map task."""
    if len(order_cols) not in (1, 2):
        first = F.min(F.struct(*order_cols)).alias("first")
        return df.groupBy(key).agg(first).select(key, *[F.col("first")[c].alias(c) for c in order_cols])
    two = len(order_cols) == 2
    k = ORD.first_key(*[F.col(c) for c in order_cols])
    g = df.groupBy(key).agg(F.min(k).alias("_first"))
    parts = ORD.split_first_key(F.col("_first"), two)
    return g.select(key, *[p.alias(c) for p, c in zip(parts, order_cols)])


def original_link(html) -> Column:
    """First 'Original writeup (... http...)' link; null when absent or when it
    equals the page's canonical link."""
    ws = TX.WS
    orig_re = r"(?iu)Original writeup(?:</a>)?" + ws + r"*\((?:<a[^>]+href=\")?(https?://[^\")<\x09-\x0d\x1c-\x20\x{85}\p{Z}]+)"
    canon = F.regexp_extract(TX.col(html), C.CANONICAL_LINK_PATTERN, 1)
    orig = F.regexp_extract(TX.col(html), orig_re, 1)
    return F.when((orig != "") & ~((canon != "") & (orig == canon)), orig)


def link_rows(detail: DataFrame, url_col: str, html_col: str, ord_col: str) -> DataFrame:
    """Link table rows: (index, ctftime_writeup_url, original_url, original_error)."""
    return detail.select(
        F.col(ord_col).alias("index"),
        F.col(url_col).alias("ctftime_writeup_url"),
        original_link(F.col(html_col)).alias("original_url"),
        F.lit(None).cast("string").alias("original_error"),
    )


def target_urls(rows: DataFrame, target_source: str = "ctftime") -> DataFrame:
    """Target list from link rows: aggregator, original or both URLs, first
    occurrence wins: (url, index, pos)."""
    agg = F.col("ctftime_writeup_url")
    orig = F.col("original_url")
    orig_ok = orig.isNotNull() & (orig != "")
    if target_source == "ctftime":
        arr = F.array(agg)
    elif target_source == "original":
        arr = F.when(orig_ok, F.array(orig)).otherwise(F.array().cast("array<string>"))
    elif target_source == "both":
        arr = F.when(orig_ok, F.array(agg, orig)).otherwise(F.array(agg))
    else:
        raise ValueError(f"unknown target_source: {target_source}")
    ex = rows.select("index", F.posexplode(arr).alias("pos", "url"))
    return ordered_distinct(ex.withColumn("pos", F.col("pos").cast("bigint")), "url", "index", "pos")


def enumeration_summary(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """writeup_pages, target_urls, original_errors in one aggregation."""
    t = rows.select(F.lit(0).alias("src"), F.col("original_error").isNotNull().alias("err")).unionByName(
        targets.select(F.lit(1).alias("src"), F.lit(False).alias("err")))
    return t.agg(
        F.count_if(F.col("src") == 0).cast("bigint").alias("writeup_pages"),
        F.count_if(F.col("src") == 1).cast("bigint").alias("target_urls"),
        F.count_if((F.col("src") == 0) & F.col("err")).cast("bigint").alias("original_errors"),
    )
