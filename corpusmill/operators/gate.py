"""Review gate on manifest records (FLT7).

A manifest needs review when its source is a scraped-derivative source, or
when any of its records' own defaults name a scraped-derivative bucket. Every
record of such a manifest must then carry the five review fields, point at an
existing ledger, be allowed for training, and not be in a blocked review
status. The gate is evaluated on the control table (one row per manifest
record); ledger existence is a left join against a listing of ledger files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill.functions import text as TX


def review_gate(records: DataFrame, manifest_key: str, existing_ledgers: DataFrame | None = None,
                ledger_col: str = "source_ledger_path", strict: bool = False) -> DataFrame:
    """Adds ``requires_review`` and ``gate_error`` (first failing rule, null
    when the record passes or needs no review). ``strict`` also blocks
    ``pending_review`` and ``fetch_error`` statuses."""
    src = TX.py_strip(F.coalesce(F.col("source").cast("string"), F.lit("")))
    bucket = TX.py_strip(F.coalesce(F.col("source_bucket").cast("string"), F.lit("")))
    by_manifest = Window.partitionBy(manifest_key)
    needs = src.isin(*C.SCRAPED_REVIEW_SOURCES) | F.max(bucket.isin(*C.SCRAPED_REVIEW_SOURCE_BUCKETS)).over(by_manifest)
    df = records.withColumn("requires_review", needs)
    if existing_ledgers is not None:
        listing = existing_ledgers.select(F.col(ledger_col).alias("_ledger")).distinct().withColumn("_exists", F.lit(True))
        df = df.join(listing, df[ledger_col] == listing["_ledger"], "left").drop("_ledger")
        exists = F.coalesce(F.col("_exists"), F.lit(False))
    else:
        exists = F.lit(True)
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in C.REVIEW_REQUIRED_FIELDS]))
    blank = lambda c: TX.py_strip(F.col(c).cast("string")) == ""
    status = F.lower(TX.py_strip(F.col("review_status")))
    blocked = list(C.BLOCKED_REVIEW_STATUSES) + (["pending_review", "fetch_error"] if strict else [])
    err = (
        F.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ",")))
        .when(blank("review_status"), F.lit("review_status_blank"))
        .when(blank("redistribution_status"), F.lit("redistribution_status_blank"))
        .when(blank(ledger_col), F.lit("source_ledger_path_blank"))
        .when(~exists, F.lit("ledger_missing"))
        .when(~F.col("allowed_for_training").eqNullSafe(True), F.lit("not_allowed_for_training"))
        .when(status.isin(*blocked), F.lit("blocked_review_status"))
    )
    out = df.withColumn("gate_error", F.when(F.col("requires_review"), err))
    return out.drop("_exists") if "_exists" in out.columns else out


def gate_failures(records: DataFrame) -> DataFrame:
    """Records that block their manifest (strict mode raises on any)."""
    return records.filter(F.col("gate_error").isNotNull())
