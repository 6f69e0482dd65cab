"""Stage E: score model responses against declarative checks (SRC14, PRJ43/44,
JOIN5, AGG7/8).

Cases carry their checks as an array; each case row is scored with
higher-order functions over that array, so per-case results need no shuffle.
The only exchanges are the case/response join and the final report
aggregation (partial aggregates per category).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import config as C
from corpusmill.functions import text as TX

CHECK = T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.StringType()),
                      T.StructField("flags", T.ArrayType(T.StringType()))])

# Python ``re`` flag names -> Java inline flag letters.
FLAG_LETTERS = {"IGNORECASE": "i", "I": "i", "MULTILINE": "m", "M": "m", "DOTALL": "s", "S": "s",
                "VERBOSE": "x", "X": "x", "UNICODE": "", "U": ""}


def default_case_id(id_col, line_col) -> Column:
    """``case_%04d`` from the 1-based line index when the id is absent."""
    return F.coalesce(TX.col(id_col).cast("string"), F.format_string(C.EVAL_CASE_ID_FORMAT, TX.col(line_col)))


def normalize_checks(df: DataFrame, keys=C.CHECK_KEYS, key_columns: dict | None = None) -> Column:
    """Explicit ``checks`` when present, else one check per present key in
    exact, contains, regex order (``key_columns`` maps a key to its column)."""
    key_columns = key_columns or {k: k for k in keys}
    implied = F.filter(F.array(*[
        F.when(F.col(col).isNotNull(), F.struct(F.lit(k).alias("type"), F.col(col).cast("string").alias("value"),
                                                F.lit(None).cast("array<string>").alias("flags")))
        for k, col in key_columns.items() if col in df.columns]), lambda x: x.isNotNull())
    if "checks" in df.columns:
        return F.coalesce(F.col("checks"), implied)
    return implied


def _java_regex(value: Column, flags: Column) -> Column:
    letters = F.array_join(F.transform(F.coalesce(flags, F.array().cast("array<string>")),
                                       lambda f: F.coalesce(F.element_at(F.create_map(*[x for k, v in FLAG_LETTERS.items()
                                                                                        for x in (F.lit(k), F.lit(v))]), f),
                                                            F.raise_error(F.concat(F.lit("Unsupported regex flag: "), f)))), "")
    # Python-only syntax -> Java: named groups and their back-references, \Z
    pat = F.regexp_replace(value, r"\(\?P<([A-Za-z_][A-Za-z0-9_]*)>", "(?<$1>")
    pat = F.regexp_replace(pat, r"\(\?P=([A-Za-z_][A-Za-z0-9_]*)\)", "\\\\k<$1>")
    pat = F.regexp_replace(pat, r"(?<!\\)((?:\\\\)*)\\Z", "$1\\\\z")
    return F.concat(F.lit("(?dU"), letters, F.lit(")"), pat)


def check_result(response: Column, check: Column) -> Column:
    """struct(type, expected, passed, detail) for one check."""
    t = check["type"]
    v = check["value"]
    passed = (
        F.when(t == "exact", TX.py_strip(response) == TX.py_strip(v))
        .when(t == "contains", F.contains(response, v))
        .when(t == "regex", F.regexp(response, _java_regex(v, check["flags"])))
        .otherwise(F.raise_error(F.concat(F.lit("Unsupported check type: "), F.coalesce(t, F.lit("null")))))
    )
    detail = (F.when(t == "exact", F.lit("exact match")).when(t == "contains", F.lit("substring match"))
              .when(t == "regex", F.lit("regex match")))
    return F.struct(t.alias("type"), v.alias("expected"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("detail"))


def score_cases(cases: DataFrame, responses: DataFrame, on: str, response_col: str = "response",
                checks: Column | None = None) -> DataFrame:
    """Cases joined to responses; adds ``checks_result`` (array), ``passed``
    (all checks) and ``error_reason``: 'no_checks', or 'missing_response' for a
    case without a response, which fails."""
    chk = checks if checks is not None else normalize_checks(cases)
    c = cases.withColumn("_checks", chk)
    j = c.join(responses.withColumn("_answered", F.lit(True)), on, "left")
    resp = F.coalesce(F.col(response_col), F.lit(""))
    res = F.transform(F.col("_checks"), lambda x: check_result(resp, x))
    reason = F.when(F.size("_checks") <= 0, F.lit("no_checks")).when(F.col("_answered").isNull(), F.lit("missing_response"))
    out = j.withColumn("checks_result", res).withColumn("error_reason", reason)
    passed = F.when(F.col("error_reason").isNull(), F.forall("checks_result", lambda r: r["passed"])).when(
        F.col("error_reason") == "missing_response", F.lit(False))
    return out.withColumn("passed", passed).drop("_checks", "_answered")


def report_document(report: DataFrame) -> DataFrame:
    """The report as one document: the totals with one entry per category."""
    entry = F.struct("category", "total", "passed", "failed", "pass_rate")
    total = F.col("category") == "__total__"
    one = report.agg(F.max(F.when(total, entry)).alias("t"), F.sort_array(F.collect_list(F.when(~total, entry))).alias("by_category"))
    return one.select("t.total", "t.passed", "t.failed", "t.pass_rate", "by_category")


def eval_report(scored: DataFrame, category_col: str = "category") -> DataFrame:
    """Per category and overall (category '__total__'): total, passed,
    failed, pass_rate (half-even to 4 places). Null/empty category ->
    'uncategorized'."""
    cat = F.coalesce(TX.py_truthy_str(F.col(category_col).cast("string")), F.lit(C.UNCATEGORIZED)).alias("category")
    g = scored.select(cat, F.col("passed")).rollup("category").agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if(F.col("passed")).cast("bigint").alias("passed"),
        F.grouping("category").alias("_g"))
    g = g.withColumn("category", F.when(F.col("_g") == 1, F.lit("__total__")).otherwise(F.col("category"))).drop("_g")
    return g.withColumns({
        "failed": (F.col("total") - F.col("passed")).cast("bigint"),
        "pass_rate": F.when(F.col("total") > 0, F.bround(F.col("passed") / F.col("total"), 4)).otherwise(F.lit(0.0)),
    })
