"""Names and bounds shared by the file readers."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 256 << 20  # of tables with a row a split; beyond it their join is a regular one


def file_path() -> Column:
    """The input file of a row as a plain path (Spark reports it percent-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def is_absolute(path: str) -> bool:
    """Whether ``path`` names a place of its own: a URI with a scheme, or a path
    from the root. (A name may hold a colon.)"""
    return path.startswith("/") or re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path) is not None


def child_path(spark: SparkSession, folder: str, path: str) -> str:
    """``path`` seen from ``folder``, without dot segments. URIs keep their scheme
    and authority; local files come as plain paths."""
    new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if is_absolute(path):
        found = new_path(path)
    else:
        base = new_path(folder).toUri()
        root = base.getPath()
        if base.getScheme() is None and not root.startswith("/"):
            root = f"{os.getcwd()}/{root}"
        found = new_path(base.getScheme(), base.getAuthority(), f"{root.rstrip('/')}/{path}")
    return plain(new_path(found.toUri().normalize()).toString())


def parent_path(spark: SparkSession, path: str) -> str:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent().toString()


def plain(path: str) -> str:
    """``file:`` URIs as plain paths."""
    return path[len("file:"):].replace("///", "/", 1) if path.startswith("file:///") else path.removeprefix("file:")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system its URI names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
