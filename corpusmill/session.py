"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, app: str = "corpusmill", shuffle_partitions: int | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Session for local runs and tests. On a cluster, use the session the
    platform provides; these settings are only defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        # rows reaching the exact entity decoder carry whole pages; smaller
        # Arrow batches bound the Python worker's memory per batch
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only a session on a local master gets a folder of its
    own when it is unset. Sessions without a SparkContext (Spark Connect) read
    the setting only."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    its rows are then fixed, whatever later reads or lost executors do."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/corpusmill-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """The named parquet tables of one scale factor as DataFrames (no views are
    registered)."""
    return {name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") for name in names}


def run_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run SQL whose bare table names refer to the given DataFrames, through
    PySpark's parameterised ``spark.sql`` (generated view names, dropped
    afterwards), so nothing in the session's catalog is replaced."""
    text = sql.replace("{", "{{").replace("}", "}}")
    for name in tables:
        text = re.sub(rf"\b{re.escape(name)}\b", "{" + name + "}", text)
    return spark.sql(text, **tables)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out before CPU-heavy work per row, if the session asks for it
    with ``spark.corpusmill.inputTasks`` (a number of tasks). Off by default:
    large tables come in more splits than there are task slots. It helps a
    single small file on a machine with many cores."""
    tasks = df.sparkSession.conf.get("spark.corpusmill.inputTasks", None)
    return df.repartition(int(tasks)) if tasks else df
