"""URL Column builders.

``parse_url`` drops userinfo/port, rejects IDN hosts and raises on odd input in
ANSI mode, so the generic-syntax split is done with one regex instead:
group 1 = scheme, group 2 = netloc (userinfo and port kept), group 3 = path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill.functions.text import col, py_truthy_str

URL_SPLIT = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"
# Schemes whose last path segment loses its ';params' part.
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps",
    "rtspu", "sip", "sips", "mms", "sftp", "tel",
)


def _prepared(url) -> Column:
    # Tabs/newlines are removed anywhere, C0 controls and spaces at the start.
    u = F.regexp_replace(F.coalesce(col(url), F.lit("")), r"[\t\r\n]", "")
    return F.regexp_replace(u, r"^[\x00-\x20]+", "")


def url_scheme(url) -> Column:
    return F.lower(F.regexp_extract(_prepared(url), URL_SPLIT, 1))


def url_netloc(url) -> Column:
    """Network location, userinfo and port kept (not lower-cased)."""
    return F.regexp_extract(_prepared(url), URL_SPLIT, 2)


def url_host(url) -> Column:
    """Lower-cased netloc, the host field every host rule tests."""
    return F.lower(url_netloc(url))


def url_path(url) -> Column:
    u = _prepared(url)
    path = F.regexp_extract(u, URL_SPLIT, 3)
    scheme = F.lower(F.regexp_extract(u, URL_SPLIT, 1))
    return F.when(scheme.isin(*PARAM_SCHEMES), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)


def row_url(final_url, source_url=None) -> Column:
    """``final_url or source_url or ''``."""
    parts = [py_truthy_str(final_url)]
    if source_url is not None:
        parts.append(py_truthy_str(source_url))
    return F.coalesce(*parts, F.lit(""))


def github_raw_url(url) -> Column:
    """github.com blob/tree URL -> raw file URL; null when not rewritable."""
    return github_raw_from_path(url_path(url))


def github_raw_from_path(path) -> Column:
    """Raw-file URL from a parsed github.com path: >= 5 segments; blob -> the
    file, tree -> its README.md; otherwise null."""
    parts = F.filter(F.split(col(path), "/"), lambda x: x != "")
    n = F.size(parts)
    head = F.concat(
        F.lit("https://" + C.GITHUB_RAW_HOST + "/"),
        F.element_at(parts, 1), F.lit("/"), F.element_at(parts, 2), F.lit("/"), F.element_at(parts, 4), F.lit("/"),
    )
    rest = F.array_join(F.slice(parts, 5, F.greatest(n - 4, F.lit(1))), "/")
    mode = F.element_at(parts, 3)
    return (
        F.when(n < 5, F.lit(None).cast("string"))
        .when(mode == "blob", F.concat(head, rest))
        .when(mode == "tree", F.concat(head, rest, F.lit("/README.md")))
    )


def strip_http_scheme(url) -> Column:
    """removeprefix('https://') then removeprefix('http://')."""
    return F.regexp_replace(F.regexp_replace(col(url), r"^https://", ""), r"^http://", "")


def normalize_content_type(c) -> Column:
    """null/'' -> octet-stream; else the part before ';', stripped, lower-cased."""
    from corpusmill.functions.text import py_strip

    c = col(c)
    main = F.lower(py_strip(F.substring_index(c, ";", 1)))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(C.DEFAULT_CONTENT_TYPE)).otherwise(main)


def extension_for(content_type) -> Column:
    m = F.create_map(*[x for kv in C.EXTENSION_BY_CONTENT_TYPE.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.try_element_at(m, col(content_type)), F.lit(C.DEFAULT_EXTENSION))


def sanitize_name(c) -> Column:
    s = F.btrim(F.regexp_replace(col(c), r"[^A-Za-z0-9._-]+", "_"), F.lit("._-"))
    return F.when(s == "", F.lit("file")).otherwise(s)


def body_filename(index, final_url, content_type) -> Column:
    """``%03d_<name>``: last path segment, else netloc, else 'page'; sanitised;
    extension added when the name has no dot."""
    # last segment, ignoring trailing '/' and '/.' the way a path name does
    last = F.regexp_extract(url_path(final_url), r"([^/]*)(?:/\.?)*$", 1)
    base = F.coalesce(py_truthy_str(last), py_truthy_str(url_netloc(final_url)), F.lit("page"))
    base = sanitize_name(base)
    base = F.when(F.contains(base, F.lit(".")), base).otherwise(F.concat(base, extension_for(content_type)))
    return F.concat(F.format_string("%03d", col(index)), F.lit("_"), base)
