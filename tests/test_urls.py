from urllib.parse import urlparse

import pytest

from conftest import many
from corpusmill.functions import urls as U

EDGE_URLS = [
    "https://user:pw@Example.COM:8443/a/b?q=1#f",
    "http://bücher.example/straße",
    "http://[::1]:80/x",
    "https://host/a|b/c",
    "https://host/a b",
    "https://host/%zz",
    "host/no/scheme",
    "",
    "https://host/path;params",
    "https://host/a;b/c;d",
    "mailto:someone@example.com",
    "ftp://files.example/dir/f.txt;type=i",
    "//protocol.relative/x",
]


@pytest.mark.parametrize("part", ["host", "path"])
def test_url_parts_match_urlparse(spark, part):
    fn = {"host": U.url_host, "path": U.url_path}[part]
    got = many(spark, fn, EDGE_URLS)
    want = [urlparse(u).netloc.lower() if part == "host" else urlparse(u).path for u in EDGE_URLS]
    assert got == want


def test_github_raw_rewrite(spark):
    urls = ["https://github.com/o/r/blob/main/dir/f.md", "https://github.com/o/r/tree/main/w",
            "https://github.com/o/r", "https://github.com/o/r/issues/1/x", "https://github.com/o/r/blob/main"]
    assert many(spark, U.github_raw_url, urls) == [
        "https://raw.githubusercontent.com/o/r/main/dir/f.md",
        "https://raw.githubusercontent.com/o/r/main/w/README.md",
        None, None, None]


def test_content_type_and_filename(spark):
    assert many(spark, U.normalize_content_type, ["text/HTML; charset=x", None, "", " application/json ;v=1"]) == [
        "text/html", "application/octet-stream", "application/octet-stream", "application/json"]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "https://h.example/a/b/page", "text/html"), (12, "https://h.example/", "text/plain"),
                                (3, "https://h.example/x/report.pdf", "application/pdf"), (4, "", "image/png"),
                                (5, "https://h.example/a/./", "text/markdown")],
                               "i long, u string, ct string")
    got = [r[0] for r in df.orderBy("i").select(U.body_filename(F.col("i"), F.col("u"), F.col("ct"))).collect()]
    assert got == ["001_page.html", "003_report.pdf", "004_page.bin", "005_a.md", "012_h.example"]
