"""Text Column builders: whitespace, newlines, HTML, flags, slugs, hashes.

All of these return ``Column`` expressions that run inside whole-stage codegen.
The only Python on the path is the optional exact entity decoder, which is fed
null for every row that the native entity table already covers.
"""

from __future__ import annotations

import html as _html
import sys

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import config as C

# Python's str.isspace() set (the characters str.strip() removes), as a
# character list for btrim and as an equivalent regex class (Java and RE2).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
NOT_WS = r"[^\x09-\x0d\x1c-\x20\x{85}\p{Z}"  # open class: caller appends extra chars + "]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(col(c), F.lit(PY_WHITESPACE))


def normalize_newlines(c) -> Column:
    """CRLF and lone CR become LF."""
    return F.regexp_replace(col(c), r"\r\n?", "\n")


def collapse_blank_lines(c) -> Column:
    return F.regexp_replace(col(c), r"\n{3,}", "\n\n")


def after_marker(c, marker: str) -> Column:
    """Text after the first occurrence of ``marker``, unchanged if absent."""
    c = col(c)
    pos = F.instr(c, marker)
    return F.when(pos > 0, c.substr(pos + F.lit(len(marker)), F.lit(2**31 - 1))).otherwise(c)


def strip_preamble(c, marker: str = C.PREAMBLE_MARKER) -> Column:
    return py_strip(after_marker(c, marker))


def looks_like_html(c, window: int = C.HTML_SNIFF_WINDOW) -> Column:
    head = F.lower(F.substring(col(c), 1, window))
    cond = F.lit(False)
    for marker in C.HTML_SNIFF_MARKERS:
        cond = cond | F.contains(head, F.lit(marker))
    return cond


# Entity table decoded natively. ``&amp;`` is replaced last, which gives the
# single-pass result (``&amp;lt;`` -> ``&lt;``).
NATIVE_ENTITIES = {
    "&quot;": '"',
    "&copy;": "\u00a9",
    "&middot;": "\u00b7",
    "&lt;": "<",
    "&gt;": ">",
    "&nbsp;": "\xa0",
    "&apos;": "'",
    "&#39;": "'",
}
_NATIVE_NAMES = "|".join(k[1:-1] for k in list(NATIVE_ENTITIES) + ["&amp;"])
# An '&' that may start an entity the native table does not cover.
NEEDS_EXACT_DECODER = r"&(?!(?:" + _NATIVE_NAMES + r");)[^\t\n\f <&;]"


def _unescape_series(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else _html.unescape(v))


try:  # ship the decoder by value: executors need pandas/pyarrow, not this package
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: falls back to by-reference
    pass

_unescape_exact = F.pandas_udf(_unescape_series, T.StringType())


def unescape_native(c) -> Column:
    c = col(c)
    for ent, ch in NATIVE_ENTITIES.items():
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def unescape_entities(c, mode: str = "exact") -> Column:
    """HTML entity decoding.

    ``native`` decodes the fixed table only. ``exact`` also routes rows holding
    any other entity-like sequence through the stdlib decoder; all other rows
    pass null to it, so the Python worker sees only the rows that need it.
    """
    c = col(c)
    if mode == "native":
        return unescape_native(c)
    needs = F.coalesce(c.rlike(NEEDS_EXACT_DECODER), F.lit(False))
    return F.when(needs, _unescape_exact(F.when(needs, c))).otherwise(unescape_native(c))


def html_strip_tags(c) -> Column:
    """Scripts/styles dropped, block ends become newlines, other tags spaces."""
    v = col(c)
    v = F.regexp_replace(v, r"(?isu)<script.*?>.*?</script>", " ")
    v = F.regexp_replace(v, r"(?isu)<style.*?>.*?</style>", " ")
    v = F.regexp_replace(v, r"(?iu)<br" + WS + r"*/?>", "\n")
    v = F.regexp_replace(v, r"(?iu)</p" + WS + r"*>", "\n\n")
    v = F.regexp_replace(v, r"(?iu)</div" + WS + r"*>", "\n")
    return F.regexp_replace(v, r"(?isu)<[^>]+>", " ")


def html_tidy(c) -> Column:
    """Runs of spaces/tabs -> one space, indentation after newlines removed,
    3+ newlines -> 2, stripped."""
    v = F.regexp_replace(col(c), r"[ \t]+", " ")
    v = F.regexp_replace(v, r"\n[ \t]+", "\n")
    return py_strip(collapse_blank_lines(v))


def html_to_text(c, unescape: str = "exact") -> Column:
    """Markup removal: scripts/styles dropped, block ends become newlines,
    remaining tags become spaces, entities decoded, whitespace tidied.
    Prefer ``with_html_text`` on frames: it materialises the tag-stripped text
    once instead of referencing the expression from each decoder branch."""
    return html_tidy(unescape_entities(html_strip_tags(c), unescape))


def with_html_text(df, src: str, out: str, unescape: str = "exact", only_when: Column | None = None):
    """``html_to_text`` as staged projections on a frame. With ``only_when``
    the conversion runs only for matching rows; other rows keep ``src``."""
    stripped = html_strip_tags(F.col(src))
    df = df.withColumn("_html_tags", F.when(only_when, stripped) if only_when is not None else stripped)
    df = df.withColumn("_html_ent", unescape_entities(F.col("_html_tags"), unescape))
    text = html_tidy(F.col("_html_ent"))
    if only_when is not None:
        text = F.when(F.col("_html_tags").isNotNull(), text).otherwise(F.col(src))
    return df.withColumn(out, text).drop("_html_tags", "_html_ent")


# Java forms of the flag patterns: Unicode word boundaries and case folding
# (``(?U)``), Python's whitespace set in place of ``\s``.
FLAG_PATTERNS_JAVA = (
    r"(?U)(?i)\b[a-z0-9_]{0,32}\{[^{}\n]{4,200}\}",
    r"(?U)(?i)\bflag" + WS + r"*[:=]" + WS + r"*" + NOT_WS + r"`]+",
)


def redact_flags(c, patterns=FLAG_PATTERNS_JAVA, replacement: str = C.FLAG_REPLACEMENT) -> Column:
    v = col(c)
    for p in patterns:
        v = F.regexp_replace(v, p, replacement)
    return v


def clean_content(content, method, unescape: str = "exact", marker: str = C.PREAMBLE_MARKER) -> Column:
    """strip -> html_to_text (cached body or HTML-looking) -> preamble -> blank lines -> strip."""
    s = py_strip(content)
    is_html = (F.coalesce(col(method), F.lit("")) == "local_cached_body") | looks_like_html(s)
    s = F.when(is_html, html_to_text(s, unescape)).otherwise(s)
    s = strip_preamble(s, marker)
    return py_strip(collapse_blank_lines(s))


def with_clean_content(df, content: str, method: str, out: str, unescape: str = "exact", marker: str = C.PREAMBLE_MARKER):
    """``clean_content`` as staged projections on a frame, each text step once."""
    df = df.withColumn("_s0", py_strip(F.col(content)))
    is_html = (F.coalesce(F.col(method), F.lit("")) == "local_cached_body") | looks_like_html(F.col("_s0"))
    df = with_html_text(df, "_s0", "_s1", unescape, only_when=is_html)
    return df.withColumn(out, py_strip(collapse_blank_lines(strip_preamble(F.col("_s1"), marker)))).drop("_s0", "_s1")


def truncate(c, n: int) -> Column:
    """First ``n`` code points, then stripped."""
    return py_strip(F.substring(col(c), 1, n))


def short_hash(c, n: int = C.SHORT_HASH_LEN) -> Column:
    """First ``n`` hex digits of SHA-1 over the UTF-8 bytes."""
    return F.substring(F.sha1(col(c).cast("binary")), 1, n)


def hash_bucket(c, buckets: int = C.EVAL_BUCKETS) -> Column:
    """int(short_hash, 16) % buckets (40-bit value, fits a long)."""
    return F.pmod(F.conv(short_hash(c), 16, 10).cast("bigint"), F.lit(buckets))


def slugify(c, fallback: str = "sample") -> Column:
    """strip; runs outside [a-zA-Z0-9._-] -> '_'; trim '._-' at both ends; empty -> fallback."""
    s = F.regexp_replace(py_strip(c), r"[^a-zA-Z0-9._-]+", "_")
    s = F.btrim(s, F.lit("._-"))
    return F.when(s == "", F.lit(fallback)).otherwise(s)


def contains_any(c, needles) -> Column:
    c = col(c)
    cond = F.lit(False)
    for n in needles:
        cond = cond | F.contains(c, F.lit(n))
    return cond


def sql_str(s: str) -> str:
    """Spark SQL string literal (backslash escapes are processed by the parser)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def count_contains(c, needles) -> Column:
    """Number of needles that occur in ``c``. With a column name the sum is
    one SQL expression (one call into the JVM instead of three per needle);
    the plan is the same either way."""
    if isinstance(c, str):
        if not needles:
            return F.lit(0)
        return F.expr(" + ".join(f"cast(contains(`{c}`, {sql_str(n)}) as int)" for n in needles))
    total = F.lit(0)
    for n in needles:
        total = total + F.contains(c, F.lit(n)).cast("int")
    return total


def has_code(c, markers=C.HAS_CODE_MARKERS) -> Column:
    return contains_any(c, markers)


def sha256_hex(c) -> Column:
    return F.sha2(col(c).cast("binary"), 256)


def py_truthy_str(c) -> Column:
    """Python ``x or ...`` on an optional string: null and '' are falsy."""
    c = col(c)
    return F.when(c != "", c)
