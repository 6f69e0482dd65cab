"""Stage F: URL lists, fetch-log projection over landed payloads, and the
shared URL cache (SRC10, PRJ22-25, JOIN2/3, WIN2/4, SNK8).

No network I/O happens here: payloads arrive as a table (url, final_url, body,
status, headers) and every step is a projection, join or aggregate on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as TX
from corpusmill.functions import urls as U
from corpusmill.operators.links import ordered_distinct


def clean_url_line(line) -> Column:
    """strip, then drop a leading BOM; null for blank and '#' lines."""
    s = F.regexp_replace(TX.py_strip(TX.col(line)), "^\ufeff+", "")
    return F.when((s != "") & ~s.startswith("#"), s)


def url_list(lines: DataFrame, line_col: str = "line", ord_col: str = "ord") -> DataFrame:
    """Kept URL lines, first occurrence wins: (url, ord)."""
    kept = lines.select(clean_url_line(F.col(line_col)).alias("url"), F.col(ord_col).alias("ord")).filter(F.col("url").isNotNull())
    return ordered_distinct(kept, "url", "ord")


def payload_metadata(payloads: DataFrame) -> DataFrame:
    """Payload rows with the body replaced by its SHA-256 and byte length, so
    later joins move metadata only."""
    body = F.col("body").cast("binary")
    return payloads.withColumns({"body_sha256": F.sha2(body, 256), "body_length": F.octet_length(body).cast("bigint")}).drop("body")


def fetch_log(payloads: DataFrame, index_col: str = "idx", body_dir: str | None = None,
              max_http_status: int | None = None) -> DataFrame:
    """Fetch records for landed payloads: content type, byte length, SHA-256,
    body file name, response headers; error rows keep only url/index/status.

    Any HTTP status counts as a successful fetch (as specified) unless
    ``max_http_status`` is given and ``status_code`` exceeds it."""
    ok = F.col("status") != "error"
    if max_http_status is not None and "status_code" in payloads.columns:
        ok = ok & (F.coalesce(F.col("status_code"), F.lit(0)) <= max_http_status)
    ctype = U.normalize_content_type(F.col("content_type_raw"))
    if "body" in payloads.columns:
        body = F.col("body").cast("binary")
        length, digest = F.octet_length(body).cast("bigint"), F.sha2(body, 256)
    else:  # already reduced by payload_metadata
        length, digest = F.col("body_length"), F.col("body_sha256")
    fname = U.body_filename(F.col(index_col), F.col("final_url"), ctype)
    cols = {
        "index": F.col(index_col).cast("bigint"),
        "url": F.col("url"),
        "status": F.col("status"),
        "final_url": F.when(ok, F.col("final_url")),
        "content_type": F.when(ok, ctype),
        "content_length": F.when(ok, length),
        "sha256": F.when(ok, digest),
        "filename": F.when(ok, fname),
    }
    if "status_code" in payloads.columns:
        cols["status_code"] = F.col("status_code").cast("int")
    if "headers" in payloads.columns:  # MAP<STRING,STRING> of raw response headers
        hdr = F.col("headers")
        cols["headers"] = F.when(ok, F.struct(*[F.try_element_at(hdr, F.lit(k)).alias(n) for n, k in (
            ("content_type", "Content-Type"), ("content_length", "Content-Length"),
            ("last_modified", "Last-Modified"), ("etag", "ETag"))]))
    cols["status"] = F.when(ok | (F.col("status") == "error"), F.col("status")).otherwise(F.lit("error"))
    if "error" in payloads.columns:  # the fetcher's message for failed fetches
        cols["error"] = F.when(~F.coalesce(ok, F.lit(False)), F.col("error"))
    if body_dir is not None:
        cols["body_path"] = F.when(ok, F.concat(F.lit(body_dir.rstrip("/") + "/"), fname))
    return payloads.select(*[v.alias(k) for k, v in cols.items()])


def latest_entries(cache: DataFrame, key_col: str = "url", ord_col: str = "ord") -> DataFrame:
    """Cache index: last write wins per trimmed URL key (max_by over ord)."""
    cols = [c for c in cache.columns if c not in (ord_col,)]
    keyed = cache.withColumn("_key", TX.py_strip(F.col(key_col)))
    entry = F.max_by(F.struct(*cols, F.col(ord_col).alias(ord_col)), F.col(ord_col)).alias("e")
    return keyed.groupBy("_key").agg(entry).select(F.col("_key").alias("cache_key"), "e.*")


def cache_lookup(urls: DataFrame, cache: DataFrame, url_col: str = "url", ord_col: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(hits, misses): a URL hits only when its latest entry has status ok.

    One left join against the one-row-per-key cache index (AQE broadcasts it
    when it is small at run time); hits and misses are two filters of it."""
    j = cache_probe(urls, cache, url_col, ord_col)
    entry_cols = [c for c in j.columns if c.startswith("cache_") and c != "cache_hit"]
    hits = j.filter("cache_hit").select(*urls.columns, F.lit("cached").alias("fetch_status"), *entry_cols)
    misses = j.filter(~F.col("cache_hit")).select(*urls.columns)
    return hits, misses


def cache_probe(urls: DataFrame, cache: DataFrame, url_col: str = "url", ord_col: str = "ord") -> DataFrame:
    """Every URL with ``cache_hit`` and, for hits, the entry's fields as
    ``cache_<field>``."""
    idx = latest_entries(cache, url_col, ord_col).filter(F.col("status") == "ok")
    keyed = urls.withColumn("_key", TX.py_strip(F.col(url_col)))
    j = keyed.join(idx, keyed["_key"] == idx["cache_key"], "left")
    entry_cols = [idx[c].alias(f"cache_{c}") for c in idx.columns if c not in ("cache_key", url_col)]
    return j.select(*[keyed[c] for c in urls.columns], idx["cache_key"].isNotNull().alias("cache_hit"), *entry_cols)


def cache_upsert(cache: DataFrame, updates: DataFrame, key_col: str = "url", ord_col: str = "ord") -> DataFrame:
    """New cache index: entries of ``updates`` replace older ones per key."""
    return latest_entries(cache.unionByName(updates, allowMissingColumns=True), key_col, ord_col)


def new_bodies(payloads: DataFrame, stored_keys: DataFrame, sha_col: str = "sha256") -> DataFrame:
    """Content-addressed store: one body per digest, only digests not stored
    yet (write each body once)."""
    one = payloads.dropDuplicates([sha_col])
    return one.join(stored_keys.select(F.col(sha_col).alias("_k")), one[sha_col] == F.col("_k"), "left_anti")
