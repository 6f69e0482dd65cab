import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import build_session

    s = build_session("local[4]", app="corpusmill-tests", shuffle_partitions=8, driver_memory="4g")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusmill-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="corpusmill-test-")


def one(spark, col, value, dtype="string"):
    """Evaluate a Column on a one-row frame with column ``v``."""
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col.alias("r")).collect()[0]["r"]


def many(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", fn("v").alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]
