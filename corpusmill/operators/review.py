"""Stage R: review ledger over fetch records, its summary, and approved-row
selection for the transform stage (PRJ18, FLT4/9, LIM1, AGG5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill import config as C
from corpusmill.functions import text as TX


def review_ledger(records: DataFrame, batch_name: str, *, index_col: str = "index",
                  approve_training: bool = False, approve_redistribution: bool = False,
                  review_status: str | None = None, redistribution_status: str | None = None,
                  permission_basis: str = "") -> DataFrame:
    """One ledger row per fetch record (the 20 ledger columns, fixed order)."""
    st = F.coalesce(TX.py_truthy_str(F.col("status")), F.lit("error"))
    ok = st.isin(*C.SUCCESS_FETCH_STATUSES)
    rs = F.lit(review_status.strip()) if review_status else None
    review = F.when(ok, rs if rs is not None else F.lit("pending_review")).otherwise(F.lit("fetch_error"))
    redis = F.when(ok, F.lit(redistribution_status.strip())) if redistribution_status else None
    redis = F.coalesce(redis, F.lit("review_required")) if redis is not None else F.lit("review_required")
    slug = TX.slugify(F.lit(batch_name), "record")
    cols = {c: F.col(c) for c in records.columns}
    get = lambda name, t="string": cols.get(name, F.lit(None).cast(t))
    final_url = F.coalesce(TX.py_truthy_str(get("final_url")), TX.py_truthy_str(get("url")))
    out = {
        "review_id": F.concat(slug, F.lit("_"), F.format_string("%04d", F.col(index_col))),
        "batch_name": F.lit(batch_name),
        "source_url": get("url"),
        "final_url": final_url,
        "fetched_at": get("fetched_at"),
        "http_status": get("status_code", "int"),
        "fetch_status": st,
        "fetch_error": get("error"),
        "content_type": get("content_type"),
        "sha256": get("sha256"),
        "body_path": get("body_path"),
        "author_if_known": F.lit(None).cast("string"),
        "license_if_known": F.lit(""),
        "permission_basis": F.lit(permission_basis.strip()),
        "review_status": review,
        "allowed_for_training": ok & F.lit(bool(approve_training)),
        "allowed_for_redistribution": ok & F.lit(bool(approve_redistribution)),
        "redistribution_status": redis,
        "transformation_status": F.lit("not_started"),
        "notes": F.lit(""),
    }
    return records.select(*[out[c].alias(c) for c in C.LEDGER_COLUMNS], F.col(index_col).alias("ord"))


def review_summary(ledger: DataFrame) -> DataFrame:
    return ledger.agg(
        F.count(F.lit(1)).cast("bigint").alias("records"),
        F.count_if(F.col("review_status") == "pending_review").cast("bigint").alias("pending_reviews"),
        F.count_if(F.col("allowed_for_training")).cast("bigint").alias("approved_for_training"),
        F.count_if(F.col("allowed_for_redistribution")).cast("bigint").alias("approved_for_redistribution"),
    )


def approved_rows(ledger: DataFrame, include_unapproved: bool = False) -> DataFrame:
    """Successful fetches that are approved for training (exactly True)."""
    cond = F.coalesce(F.col("fetch_status"), F.lit("")).isin(*C.SUCCESS_FETCH_STATUSES)
    if not include_unapproved:
        cond = cond & F.col("allowed_for_training").eqNullSafe(True)
    return ledger.filter(cond)


def approved_rows_limited(ledger: DataFrame, limit: int, include_unapproved: bool = False, ord_col: str = "ord") -> DataFrame:
    """The first ``limit`` selected rows in ledger order (a top-k: sorts run
    per partition and only ``limit`` rows per partition reach the merge)."""
    return approved_rows(ledger, include_unapproved).orderBy(ord_col).limit(max(int(limit), 0))
