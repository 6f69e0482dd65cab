import hashlib
import html
import re

from pyspark.sql import functions as F

from conftest import many
from corpusmill.functions import text as TX


def test_py_strip_matches_python_whitespace(spark):
    s = " \t\n\xa0 \x1c\x1f\x85​﻿a\xa0　 "
    assert many(spark, lambda c: TX.py_strip(c), [s, "", "  x y  ", None]) == [s.strip(), "", "x y", None]
    assert s.strip() == "​﻿a"


FLAG_CASES = [
    "CTF{abcd} x",
    "flag: CTF{abcdef}",
    " {abcd}",
    "x" * 40 + "{abcd}",
    "FLAG\xa0: zz",
    "the flag = secret_value and more",
    "flag{a}",
    "éflag: q",
    "pico_ctf{" + "y" * 201 + "}",
    "data{line\nbreak}",
    "use `flag:` carefully",
]


def python_redact(s):
    for p in (r"(?i)\b[a-z0-9_]{0,32}\{[^{}\n]{4,200}\}", r"(?i)\bflag\s*[:=]\s*[^\s`]+"):
        s = re.sub(p, "<FLAG>", s)
    return s


def test_flag_redaction_matches_python_re(spark):
    got = many(spark, lambda c: TX.redact_flags(F.col(c)), FLAG_CASES)
    assert got == [python_redact(s) for s in FLAG_CASES]
    assert got[0] == "<FLAG> x" and got[1] == "<FLAG>" and got[2] == " {abcd}"
    assert got[3] == "x" * 40 + "<FLAG>" and got[4] == "<FLAG>"


def test_preamble_marker_first_occurrence(spark):
    got = many(spark, lambda c: TX.strip_preamble(c), ["a Markdown Content: b Markdown Content: c", "none here", " x "])
    assert got == ["b Markdown Content: c", "none here", "x"]


def test_entities_exact_and_native(spark):
    vals = ["&amp;lt;", "&#39;x&#x27;", "&copy 2020", "&ampx", "R&D &notit", "a &quot;b&quot; &middot; &copy;", "&unknown; &", None]
    exact = many(spark, lambda c: TX.unescape_entities(F.col(c), "exact"), vals)
    assert exact == [None if v is None else html.unescape(v) for v in vals]
    native = many(spark, lambda c: TX.unescape_entities(F.col(c), "native"), vals[:1] + vals[5:6])
    assert native == ["&lt;", 'a "b" · ©']


HTML_CASES = [
    # (input, expected) -- expected values worked out by hand
    ("<html><head><style>p{x}</style><script>var a='</p>';</script></head><body><p>Hi &amp; bye</p>"
     "<div>one<br/>two<BR >three</div>\n\n\n\n  <b>bold</b>\t\ttabs &copy 2020</body></html>",
     "Hi & bye\n\none\ntwo\nthree\n\nbold tabs \u00a9 2020"),
    ("<SCRIPT type=x>alert(1)</SCRIPT>text<p >para</P >", "text para"),
    ("no markup at all", "no markup at all"),
    ("a<br\xa0/>b &amp;lt;tag&amp;gt;", "a\nb &lt;tag&gt;"),
]


def test_html_to_text_cases(spark):
    docs = [d for d, _ in HTML_CASES]
    got = many(spark, lambda c: TX.html_to_text(F.col(c)), docs)
    assert got == [e for _, e in HTML_CASES]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, v string")
    staged = [r["t"] for r in TX.with_html_text(df, "v", "t").orderBy("i").collect()]
    assert staged == got


def test_newlines_slug_hash_truncate(spark):
    assert many(spark, lambda c: TX.py_strip(TX.normalize_newlines(c)), ["a\r\nb\rc  \r\n"]) == ["a\nb\nc"]
    assert many(spark, lambda c: TX.slugify(c), ["  Hello World!! ", "...", "a.b-c_d", "é ü"]) == [
        "Hello_World", "sample", "a.b-c_d", "sample"]
    assert many(spark, lambda c: TX.slugify(c, "record"), ["##"]) == ["record"]
    words = ["abc", "grüße", "x/y 1"]
    assert many(spark, lambda c: TX.short_hash(c), words) == [hashlib.sha1(w.encode()).hexdigest()[:10] for w in words]
    assert many(spark, lambda c: TX.hash_bucket(c), words) == [int(hashlib.sha1(w.encode()).hexdigest()[:10], 16) % 10 for w in words]
    s = "ab\U0001F600cd  "
    assert many(spark, lambda c: TX.truncate(c, 3), [s]) == [s[:3].strip()]
    assert many(spark, lambda c: TX.has_code(c), ["```x", "import os", "plain", "select x"]) == [True, True, False, False]


def test_looks_like_html_window(spark):
    vals = ["<!DOCTYPE html><p>", "x" * 600 + "<html>", "  <HTML>"]
    assert many(spark, lambda c: TX.looks_like_html(c), vals) == [True, False, True]
