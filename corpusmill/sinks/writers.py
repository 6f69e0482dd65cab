"""Sinks (SNK1-8). Every writer refuses to replace existing output unless
``overwrite=True`` (``errorifexists`` otherwise). Writes go through Spark's
commit protocol, so a lost executor's tasks are retried without partial files
becoming visible.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill.sinks.body_store import append_bodies  # noqa: F401 - one of the sinks
from corpusmill.sources.files import path_exists


def require_new(spark, paths, overwrite: bool) -> None:
    """Refuse before the first write if any output is there already."""
    there = [] if overwrite else [p for p in paths if path_exists(spark, p)]
    if there:
        raise FileExistsError(f"output exists: {', '.join(there)}")


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def _ordered(df: DataFrame, order_by) -> DataFrame:
    """Input order restored at the sink: a range-partitioned global sort, so
    part files concatenated in name order follow ``order_by``."""
    if not order_by:
        return df
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*cols).drop(*[c for c in cols if c.startswith("_") and c not in ("_split",)])


def write_jsonl(df: DataFrame, path: str, overwrite: bool = False, keep_nulls: bool = True, order_by=None) -> None:
    """JSON lines, UTF-8 kept as is; null fields written out for a stable shape."""
    (_ordered(df, order_by).write.mode(_mode(overwrite)).option("ignoreNullFields", str(not keep_nulls).lower())
     .option("compression", "none").json(path))


def write_split_jsonl(samples: DataFrame, path: str, overwrite: bool = False, keep_split_in_body: bool = False,
                      default_split: str = "dataset", order_by=None) -> None:
    """One folder per split (``split=<name>/``). The dataset build drops the
    split from the record body; the write-up build keeps it
    (``keep_split_in_body``). Missing split -> ``default_split``."""
    split = F.coalesce(F.when(F.col("split") != "", F.col("split")), F.lit(default_split))
    if keep_split_in_body:
        df = samples.withColumn("_split", split)
        part = "_split"
    else:
        df = samples.withColumn("split", split)
        part = "split"
    if order_by:
        # split first: the writer needs rows grouped by the partition column,
        # and a sort that already starts with it is kept as is
        order_by = [part] + ([order_by] if isinstance(order_by, str) else list(order_by))
    (_ordered(df, order_by).write.mode(_mode(overwrite)).partitionBy(part).option("ignoreNullFields", "false")
     .option("compression", "none").json(path))


def _py_bool(c):
    return F.when(c, F.lit("True")).when(~c, F.lit("False"))


def write_ledger_csv(ledger: DataFrame, path: str, overwrite: bool = False) -> None:
    """Review ledger as CSV with a header, fixed column order; booleans and
    nulls written the way a Python csv writer renders them."""
    cols = []
    for c in C.LEDGER_COLUMNS:
        dt = dict(ledger.dtypes).get(c)
        cols.append((_py_bool(F.col(c)) if dt == "boolean" else F.col(c).cast("string")).alias(c))
    (ledger.select(*cols).write.mode(_mode(overwrite)).option("header", True).option("nullValue", "")
     .option("emptyValue", "").csv(path))


def write_summary(summary: DataFrame, path: str, overwrite: bool = False) -> None:
    """A one-row summary frame as a single JSON document (one small file)."""
    summary.coalesce(1).write.mode(_mode(overwrite)).option("ignoreNullFields", "false").json(path)


def write_target_list(targets: DataFrame, path: str, order_cols=("index", "pos"), overwrite: bool = False) -> None:
    """Target URLs as text lines in first-occurrence order (a range-partitioned
    sort, so the order holds across output files)."""
    targets.orderBy(*order_cols).select("url").write.mode(_mode(overwrite)).text(path)


class RunOutput:
    """All outputs of one run, or none: sinks write into a folder of the run's own
    beside the outputs, and leaving the ``with`` block renames them into place. An
    error in the block or while renaming removes what the run wrote and brings back
    what it had replaced. Existing outputs are refused before the first write unless
    ``overwrite``. A rename is one step on HDFS and local disks; object stores copy.

    ``with RunOutput(spark, folder, ["a", "b"], overwrite) as run: write(run["a"])``
    """

    def __init__(self, spark, folder: str, names, overwrite: bool = False):
        self.spark, self.names, self.overwrite = spark, list(names), overwrite
        self.folder = folder.rstrip("/")
        self.scratch = f"{self.folder}/_run-{uuid.uuid4().hex}"

    def __getitem__(self, name: str) -> str:
        if name not in self.names:
            raise KeyError(name)
        return f"{self.scratch}/new/{name}"

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.folder).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def __enter__(self):
        require_new(self.spark, [f"{self.folder}/{n}" for n in self.names], self.overwrite)
        return self

    def _rename(self, fs, source: str, target: str) -> None:
        fs.mkdirs(self._path(target).getParent())
        if not fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def __exit__(self, kind, error, trace) -> bool:
        fs, undo = self._fs(), []
        try:
            if kind is None:
                for n in self.names:
                    target = f"{self.folder}/{n}"
                    if fs.exists(self._path(target)):
                        if not self.overwrite:  # came up while the run was at work
                            raise FileExistsError(f"output exists: {target}")
                        self._rename(fs, target, f"{self.scratch}/old/{n}")
                        undo.append((f"{self.scratch}/old/{n}", target))
                    if fs.exists(self._path(self[n])):
                        self._rename(fs, self[n], target)
                        undo.append((target, self[n]))
        except BaseException:
            for source, target in reversed(undo):
                self._rename(fs, source, target)
            raise
        finally:
            fs.delete(self._path(self.scratch), True)
        return False
