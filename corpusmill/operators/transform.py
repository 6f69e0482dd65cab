"""Stage T: route approved ledger rows to a transform method and normalise the
landed text (PRJ19-21, AGG6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill.functions import text as TX
from corpusmill.functions import urls as U


def route_method(host, path, body_path) -> Column:
    """Transform method from a parsed host/path; first rule wins: aggregator
    host with a landed body -> local_cached_body; raw GitHub host or a
    rewritable github.com blob/tree URL -> github_raw; else the reader proxy."""
    host = TX.col(host)
    has_body = F.coalesce(TX.py_strip(TX.col(body_path)) != "", F.lit(False))
    return (
        F.when(host.endswith(C.AGGREGATOR_HOST_SUFFIX) & has_body, F.lit("local_cached_body"))
        .when(host == C.GITHUB_RAW_HOST, F.lit("github_raw"))
        .when(host.isin(*C.GITHUB_HOSTS) & U.github_raw_from_path(path).isNotNull(), F.lit("github_raw"))
        .otherwise(F.lit("jina"))
    )


def route_target(final_url, source_url, body_path, body_root: str | None = None,
                 proxy_prefix: str = C.READER_PROXY_PREFIX) -> Column:
    """struct(method, url) for one ledger row (see ``route_method``); the URL
    is the body path, the raw URL, or the proxy URL."""
    url = U.row_url(final_url, source_url)
    host = U.url_host(url)
    path = U.url_path(url)
    bp = TX.col(body_path)
    local = bp if body_root is None else F.when(bp.startswith("/"), bp).otherwise(F.concat(F.lit(body_root.rstrip("/") + "/"), bp))
    method = route_method(host, path, bp)
    target = (
        F.when(method == "local_cached_body", local)
        .when(host == C.GITHUB_RAW_HOST, url)
        .when(method == "github_raw", U.github_raw_from_path(path))
        .otherwise(F.concat(F.lit(proxy_prefix), U.strip_http_scheme(url)))
    )
    return F.struct(method.alias("method"), target.alias("url"))


def route_targets(ledger: DataFrame, body_root: str | None = None) -> DataFrame:
    """Adds ``transform_method`` and ``transform_url`` to approved ledger rows."""
    src = "source_url" if "source_url" in ledger.columns else None
    src_col = F.col(src) if src else None
    r = route_target(F.col("final_url"), src_col, F.col("body_path"), body_root)
    return ledger.withColumn("_route", r).withColumns(
        {"transform_method": F.col("_route.method"), "transform_url": F.col("_route.url")}
    ).drop("_route")


def normalize_text(c) -> Column:
    """CRLF/CR -> LF, then strip."""
    return TX.py_strip(TX.normalize_newlines(c))


def landed_text(df: DataFrame, content_col: str = "content") -> DataFrame:
    """Normalised text plus its SHA-256 (transform_status ok rows)."""
    norm = normalize_text(F.col(content_col))
    return df.withColumn("content", norm).withColumn("content_sha256", TX.sha256_hex(F.col("content")))


def transform_summary(transformed: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """input / selected / ok / error counters plus counts per method, one
    aggregation (ledger rows and transformed rows are tagged and unioned)."""
    t = transformed.select(
        F.lit(0).alias("src"),
        F.coalesce(F.col("transform_method"), F.lit("")).alias("m"),
        F.col("transform_status").alias("st"),
    )
    if ledger is not None:
        t = t.unionByName(ledger.select(F.lit(1).alias("src"), F.lit(None).cast("string").alias("m"),
                                        F.lit(None).cast("string").alias("st")))
    per = t.groupBy("src", "m").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("st") == "ok").alias("ok"),
        F.count_if(F.col("st") == "error").alias("err"),
    )
    is_t = F.col("src") == 0
    cols = [
        F.coalesce(F.sum(F.when(is_t, F.col("n"))), F.lit(0)).cast("bigint").alias("selected_rows"),
        F.coalesce(F.sum("ok"), F.lit(0)).cast("bigint").alias("successes"),
        F.coalesce(F.sum("err"), F.lit(0)).cast("bigint").alias("errors"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(is_t, F.struct("m", "n"))))).alias("methods"),
    ]
    if ledger is not None:
        cols.insert(0, F.coalesce(F.sum(F.when(~is_t, F.col("n"))), F.lit(0)).cast("bigint").alias("input_rows"))
    return per.agg(*cols)
