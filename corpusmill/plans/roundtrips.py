"""Registered queries that go through files: a sink writes rows derived from the
given tables into the shared checkpoint folder, a reader or job reads them back,
and the rows must be those the oracle computes from the tables alone."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators import evaluation as EV
from corpusmill.functions import freeform as FF
from corpusmill.operators import fetch as FE
from corpusmill.operators import links as LK
from corpusmill.operators import redact as RD
from corpusmill.operators import writeups as W
from corpusmill.operators.transform import route_target
from corpusmill.plans import catalog as CT
from corpusmill.plans import jobs as JB
from corpusmill.plans import oracle as O
from corpusmill.plans.fixtures import fixture, with_ctes
from corpusmill.session import checkpoint_dir, load_tables, run_sql
from corpusmill.sinks import body_store as BS
from corpusmill.sinks import cache_log as CL
from corpusmill.sinks import writers as S
from corpusmill.sources import json_items as JI
from corpusmill.sources.files import file_path
from corpusmill.sources import jsonl as J

query, ORACLE = CT.query, O.ORACLE


def folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/corpusmill-{name}-{uuid.uuid4().hex}"


@query("jsonl_lines")
def q_jsonl_lines(spark, sf_dir):
    """SNK2, SRC9: numbers over all part files follow the written order."""
    docs, path = load_tables(spark, sf_dir, ["documents"])["documents"], folder(spark, "jsonl")
    S.write_jsonl(docs.select("doc_id", "text", "lang"), path, order_by="doc_id")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])
    return J.read_jsonl(spark, path, schema).select("ord", "doc_id", "text", "lang")


ORACLE["jsonl_lines"] = "select row_number() over (order by doc_id) as ord, doc_id, text, lang from documents"


def _samples_of_files(spark, sf_dir):
    """The write-up job's samples, read from part files of transformed rows."""
    rows = fixture(spark, sf_dir, "transformed_fx")
    method = route_target(F.col("final_url"), None, F.col("body_path"))["method"]
    path = folder(spark, "transformed")
    S.write_jsonl(rows.withColumn("transform_method", method).drop("body_path"), path, order_by="ord")
    read = JB.read_transformed(spark, path).drop("body_path")
    return W.build_samples(W.curate_writeups(read, fixture(spark, sf_dir, "enumeration_fx")))


@query("writeup_job_rows")
def q_writeup_job_rows(spark, sf_dir):
    """SRC12, PRJ27-37 behind the file reader."""
    return CT.writeup_samples_flat(_samples_of_files(spark, sf_dir))


ORACLE["writeup_job_rows"] = ORACLE["writeup_flagship"]


@query("split_files")
def q_split_files(spark, sf_dir):
    """SNK1: one folder a split, nothing lost."""
    path = folder(spark, "splits")
    samples = W.build_samples(CT._curated(spark, sf_dir)).withColumnRenamed("first_ord", "_first_ord")
    S.write_split_jsonl(samples, path, keep_split_in_body=True, order_by="_first_ord")
    back = spark.read.schema("id string, category string, split string, _split string").json(path)
    return back.groupBy("split", "category", F.col("_split").alias("folder")).agg(F.count("*").alias("n"))


ORACLE["split_files"] = (f"select split, category, split as folder, count(*) as n from ({ORACLE['writeup_flagship']}) t "
                         "group by split, category")


@query("render_split_file")
def q_render_split_file(spark, sf_dir):
    """SRC15, FLT8: a written split, rendered for the trainer."""
    path = folder(spark, "split")
    S.write_jsonl(W.build_samples(CT._curated(spark, sf_dir)), path)
    return JB.render_training_split(spark, path, folder(spark, "rendered")).select("text")


ORACLE["render_split_file"] = f"select text from ({ORACLE['render_chat_text']}) t"


@query("read_quarantine")
def q_read_quarantine(spark, sf_dir):
    """SRC7, FLT5: every line is a sample or has its reason."""
    conv = load_tables(spark, sf_dir, ["conversations"])["conversations"]
    chat = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.lit("ok").alias("content")))
    kinds = [F.lit('{"messages": [{"role": "user", "content": 7}]}'), F.lit('{"messages": ['), F.lit('{"id": "x"}'), F.lit('"text"'),
             F.lit('[{"role": "user", "content": "hi"}, "s"]')]
    value = F.to_json(F.struct(chat.alias("messages")))
    for k, kind in enumerate(kinds, 1):
        value = F.when((F.col("conv_id") + F.col("turn")) % 6 == k, kind).otherwise(value)
    path = folder(spark, "messages")
    conv.select(value.alias("value")).write.text(path)
    rows = JB._load_format(spark, "jsonl_messages", [path], None)
    return rows.groupBy(F.coalesce("error_reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


ORACLE["read_quarantine"] = """
select case (conv_id + turn) % 6 when 1 then 'content_not_text' when 2 then 'malformed_json' when 3 then 'object_without_messages'
  when 4 then 'not_a_list_or_object' when 5 then 'entry_not_an_object' else 'ok' end as reason, count(*) as n
from conversations group by 1"""


@query("eval_missing_response")
def q_eval_missing_response(spark, sf_dir):
    """JOIN5, AGG8: a case without a response counts as failed."""
    cases = CT._cases(spark, sf_dir)
    answers = fixture(spark, sf_dir, "responses_fx").filter(F.length("response") % 3 != 1)
    scored = EV.score_cases(cases, answers, "item_id", checks=EV.normalize_checks(cases, key_columns=CT.CASE_KEYS))
    return EV.eval_report(scored).select("category", "total", "passed", "failed", "pass_rate")


ORACLE["eval_missing_response"] = ORACLE["eval_report"].replace(
    "cres.passed from cs join cres using (item_id)",
    "cres.passed and length(r.response) % 3 <> 1 as passed from cs join cres using (item_id) join responses_fx r using (item_id)")


@query("ledger_csv")
def q_ledger_csv(spark, sf_dir):
    """SNK3: the ledger as CSV, read back as text."""
    path = folder(spark, "ledger")
    S.write_ledger_csv(CT._ledger(spark, sf_dir), path)
    return spark.read.option("header", True).csv(path).select("review_id", "source_url", "fetch_status", "allowed_for_training")


ORACLE["ledger_csv"] = with_ctes("", "fetch_fx") + ",\n" + O.FETCH_LOG + ",\n" + O.ledger_sql(
    True, False, "approved_for_training", "  explicit permission ") + """
select review_id, source_url, fetch_status, case when allowed_for_training then 'True' else 'False' end as allowed_for_training from led"""


@query("target_list_file")
def q_target_list_file(spark, sf_dir):
    """SNK6, SRC10: the target list, read back as the next job's url list."""
    path = folder(spark, "targets")
    S.write_target_list(LK.target_urls(CT._link_rows(spark, sf_dir), "both"), path)
    return FE.url_list(J.read_url_file(spark, path)).select("url", F.col("ord").cast("bigint").alias("ord"))


ORACLE["target_list_file"] = with_ctes("", "detail_fx") + ",\n" + O.LINK_ROWS + "\nselect url, row_number() over (order by idx, pos) as ord from td"


@query("body_store")
def q_body_store(spark, sf_dir):
    """SNK8: bodies appended once per digest, only those not stored yet."""
    path = folder(spark, "bodies")
    pages = load_tables(spark, sf_dir, ["pages"])["pages"]
    bodies = pages.select(F.sha2(F.col("html").cast("binary"), 256).alias("sha256"), F.col("html").alias("body"))
    BS.append_bodies(bodies.filter(F.length("body") % 2 == 0), path)
    BS.append_bodies(bodies, path)
    return BS.read_body_store(spark, path).select("sha256", F.length("body").cast("bigint").alias("length"))


ORACLE["body_store"] = "select sha256(html) as sha256, cast(length(html) as bigint) as length from pages group by html"


#: ``notes`` holds an object, a text, a list, null or nothing, by the document.
_NOTES = """
select doc_id, case doc_id % 5
  when 0 then to_json(named_struct('title', text, 'lang', lang, 'inner', array(named_struct('source_url', source, 'kept', concat('mail a', doc_id, '@x.org')))))
  when 1 then to_json(named_struct('v', concat('mail b', doc_id, '@x.org ', lang)))
  when 2 then to_json(named_struct('v', array(named_struct('event_name', text, 'n', doc_id, 'kept', concat('c', doc_id, '@x.org')))))
  else '{}' end as j from documents"""


@query("redact_variant")
def q_redact_variant(spark, sf_dir):
    """PRJ15, PRJ16 on values that no schema describes: keys dropped and texts
    masked at every depth, whatever type a document's value has."""
    notes = load_tables(spark, sf_dir, ["documents"])["documents"]
    texts = run_sql(spark, _NOTES, {"documents": notes})
    value = F.parse_json("j")
    free = texts.select("doc_id", F.when(F.col("doc_id") % 5 == 3, F.parse_json(F.lit("null"))).when(
        F.col("doc_id") % 5 == 0, value).otherwise(F.try_variant_get(value, "$.v", "variant")).alias("notes"))
    policy = RD.load_policy({"drop_keys": ["title", "event_name", "source_url"],
                             "rules": [{"pattern": r"([a-c])(\d+)@X\.ORG", "replacement": r"<\g<1>>", "flags": ["IGNORECASE"]}]})
    clean = RD.apply_policy(free, policy, keep=["doc_id"])

    def at(path, kind="string"):
        return F.try_variant_get("notes", path, kind)
    return clean.select(
        "doc_id", F.coalesce(FF.value_kind(F.col("notes")), F.lit("absent")).alias("kind"), at("$.title").alias("title"),
        at("$.lang").alias("lang"), F.json_object_keys(F.to_json(at("$.inner[0]", "variant"))).cast("string").alias("inner_keys"),
        F.coalesce(at("$.inner[0].kept"), at("$[0].kept")).alias("kept"), at("$[0].event_name").alias("event_name"),
        at("$[0].n", "bigint").alias("n"), F.when(FF.value_kind(F.col("notes")) == "STRING", at("$")).alias("plain"))


ORACLE["redact_variant"] = """
select doc_id, case doc_id % 5 when 0 then 'OBJECT' when 1 then 'STRING' when 2 then 'ARRAY' when 3 then 'VOID' else 'absent' end as kind,
  cast(null as varchar) as title, case when doc_id % 5 = 0 then lang end as lang, case when doc_id % 5 = 0 then '[kept]' end as inner_keys,
  case doc_id % 5 when 0 then 'mail <a>' when 2 then '<c>' end as kept, cast(null as varchar) as event_name,
  case when doc_id % 5 = 2 then doc_id end as n, case when doc_id % 5 = 1 then 'mail <b> ' || lang end as plain
from documents"""


@query("deep_merge")
def q_deep_merge(spark, sf_dir):
    """PRJ6, PRJ7, PRJ8: the dataset job's own merge over records read from files,
    three levels deep; a record's null is kept, an absent key takes the default."""
    docs = load_tables(spark, sf_dir, ["documents"])["documents"]
    record = """concat('{"id":"d', doc_id, '","prompt":"p","answer":"a"', case doc_id % 4
        when 0 then concat(',"meta":{"b":{"c":{"x":', doc_id, '}}}') when 1 then ',"meta":{"b":{"c":null},"k":null}'
        when 2 then ',"meta":7' else '' end, case doc_id % 3 when 0 then ',"category":null' when 1 then concat(',"category":"', lang, '"') else '' end, '}')"""
    root = folder(spark, "merge")
    docs.select(F.expr(record).alias("value")).write.text(f"{root}/records")
    files = sorted(r.file for r in spark.read.text(f"{root}/records").select(file_path().alias("file")).distinct().collect())
    manifest = {"source_id": "s", "defaults": {"category": "c0", "meta": {"k": "m", "b": {"c": {"x": 0, "y": "m"}}}},
                "records": [{"paths": [f"../records/{f.rsplit('/', 1)[1]}" for f in files], "format": "jsonl_qa", "defaults": {"meta": {"b": {"c": {"y": "r"}, "z": "r"}}}}]}
    one = spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1)
    one.select(F.from_json("value", "source_id string, defaults variant, records variant").alias("m")).select("m.*").write.json(f"{root}/manifests")
    samples = JB.build_dataset(spark, f"{root}/manifests", root).samples

    def at(path, kind="string"):
        return F.try_variant_get("meta", path, kind)
    return samples.select("id", "category", at("$.k").alias("k"), at("$.b.z").alias("z"), at("$.b.c.x", "bigint").alias("x"), at("$.b.c.y").alias("y"),
                          FF.value_kind(F.col("meta")).alias("kind"))


ORACLE["deep_merge"] = """
select 'd' || doc_id as id, case doc_id % 3 when 0 then null when 1 then lang else 'c0' end as category,
  case when doc_id % 4 in (0, 3) then 'm' end as k, case when doc_id % 4 <> 2 then 'r' end as z,
  case doc_id % 4 when 0 then doc_id when 3 then 0 end as x, case when doc_id % 4 in (0, 3) then 'r' end as y,
  case doc_id % 4 when 2 then 'BIGINT' else 'OBJECT' end as kind
from documents"""


def _write_documents(spark, sf_dir, path: str, head: str, tail: str) -> None:
    """The documents as eight JSON files, each one array in order of doc_id."""
    docs = load_tables(spark, sf_dir, ["documents"])["documents"]
    text = docs.select((F.col("doc_id") % 8).cast("int").alias("part"), "doc_id", F.to_json(F.struct("doc_id", "text", "lang")).alias("value"))
    dealt = text.repartitionById(8, F.col("part")).sortWithinPartitions("doc_id").select("value")

    def as_array(batches):
        first = True
        for b in batches:
            values = b.column(0).to_pylist()
            if first and values:
                values[0] = head + values[0]
            yield pa.RecordBatch.from_arrays([pa.array([v if first and not i else "," + v for i, v in enumerate(values)], pa.string())], ["value"])
            first = first and not values
        if not first:
            yield pa.RecordBatch.from_arrays([pa.array([tail])], ["value"])

    dealt.mapInArrow(as_array, "value string").write.option("lineSep", "\n").text(path)


@query("json_items")
def q_json_items(spark, sf_dir):
    """SRC6, SRC8: whole-file JSON arrays read in splits, with their item numbers."""
    path = folder(spark, "json")
    _write_documents(spark, sf_dir, path, "[", "]")
    items = JI.read_json_items(spark, path).select("item", F.from_json("value", "doc_id long, text string, lang string").alias("r"))
    return items.select(F.col("item").cast("bigint").alias("item"), "r.doc_id", "r.text", "r.lang")


ORACLE["json_items"] = "select row_number() over (partition by doc_id % 8 order by doc_id) - 1 as item, doc_id, text, lang from documents"


@query("json_members")
def q_json_members(spark, sf_dir):
    """SRC11: documents with a large array member, read in splits."""
    path = folder(spark, "json")
    _write_documents(spark, sf_dir, path, '{"batch": {"a": [1, 2]}, "records": [', '], "n": 8}')
    members = JI.read_json_members(spark, path)
    return members.select("key", "item", F.when(F.col("key") == "records", F.get_json_object("value", "$.doc_id")).otherwise(F.col("value")).alias("value"))


ORACLE["json_members"] = """
select 'records' as key, row_number() over (partition by doc_id % 8 order by doc_id) - 1 as item, cast(doc_id as varchar) as value from documents
union all select key, null, value from (select distinct doc_id % 8 as part from documents),
  (values ('batch', '{"a": [1, 2]}'), ('n', '8')) v(key, value)"""


@query("cache_compacted")
def q_cache_compacted(spark, sf_dir):
    """JOIN2/3, WIN4: batches appended to the cache log, a base written between
    them; the index is that of all batches."""
    log, entries = folder(spark, "cache"), fixture(spark, sf_dir, "cache_fx")
    early = F.col("ord") < 1000000
    CL.append(entries.filter(early & (F.col("ord") % 4 == 0)), log)
    CL.append(entries.filter(early & (F.col("ord") % 4 != 0)), log)
    CL.compact(spark, log)
    CL.append(entries.filter(~early), log)
    return FE.latest_entries(CL.read(spark, log)).select("cache_key", "status", "body_hash", "ord")


ORACLE["cache_compacted"] = with_ctes("", "cache_fx") + """
select trim(url) as cache_key, arg_max(status, ord) as status, arg_max(body_hash, ord) as body_hash, max(ord) as ord from cache_fx group by trim(url)"""


@query("cached_bodies")
def q_cached_bodies(spark, sf_dir):
    """SRC13: the transform job takes the bodies of cached pages from the store."""
    pages = load_tables(spark, sf_dir, ["pages"])["pages"]
    store, out = folder(spark, "bodies"), folder(spark, "transformed")
    digest = F.sha2(F.col("html").cast("binary"), 256)
    BS.append_bodies(pages.select(digest.alias("sha256"), F.col("html").cast("binary").alias("body")), store)
    text = F.lit(None).cast("string")
    ledger = pages.select(
        F.col("page_id").cast("string").alias("review_id"), F.lit("https://ctftime.org/writeup/1").alias("source_url"), text.alias("final_url"),
        text.alias("permission_basis"), F.concat(F.lit(f"{store}/"), digest).alias("body_path"), F.col("page_id").alias("ord"),
        F.lit("approved_for_training").alias("review_status"), F.lit(True).alias("allowed_for_training"), F.lit("ok").alias("fetch_status"))
    JB.transform_selected(spark, ledger, spark.createDataFrame([], "transform_url string, text string"), out, body_dir=store, include_unapproved=True)
    back = spark.read.schema("review_id string, transform_method string, transform_status string, content string").json(f"{out}/transformed")
    return back.select(F.col("review_id").cast("bigint").alias("page_id"), "transform_method", "transform_status", F.sha2("content", 256).alias("content_sha256"))


ORACLE["cached_bodies"] = f"""
select page_id, 'local_cached_body' as transform_method, 'ok' as transform_status, sha256(norm) as content_sha256
from (select page_id, {O.strip(O.rx('html', r'\r\n?', O.NL))} as norm from pages) t"""


@query("run_documents")
def q_run_documents(spark, sf_dir):
    """SNK4, SNK7: a run's document holds its totals and the run's own facts."""
    cases = load_tables(spark, sf_dir, ["benchmark"])["benchmark"].filter(F.col("item_id").isNotNull())
    path, out = folder(spark, "cases"), folder(spark, "eval")
    S.write_jsonl(cases.select(F.col("item_id").cast("string").alias("id"), F.lit("c").alias("category"), F.lit("p").alias("prompt"),
                               F.col("text").alias("exact")), path)
    answers = cases.select(F.col("item_id").cast("string").alias("id"), F.when(F.length("text") % 3 != 0, F.col("text")).otherwise(F.lit("no")).alias("response"))
    JB.run_eval(spark, path, answers, out, model="m", generation={"max_new_tokens": 5})
    doc = spark.read.schema("total long, passed long, failed long, model_name_or_path string, adapter_path string, cases_path string, "
                            "report_path string, results string, duration_seconds double, generation string").json(f"{out}/report_document")
    rows = [("total", F.col("total")), ("passed", F.col("passed")), ("failed", F.col("failed")), ("model", F.col("model_name_or_path")),
            ("adapter", F.col("adapter_path")), ("cases", F.col("cases_path") == path), ("report", F.col("report_path").endswith("/report_document")),
            ("results", F.col("results").endswith("/results")), ("took", F.col("duration_seconds") > 0), ("generation", F.col("generation"))]
    return doc.select(F.inline(F.array(*[F.struct(F.lit(k).alias("fact"), v.cast("string").alias("value")) for k, v in rows])))


ORACLE["run_documents"] = """
with b as (select count(*) as n, count(*) filter (where length(text) % 3 <> 0) as ok from benchmark where item_id is not null)
select fact, value from b, lateral (values ('total', cast(n as varchar)), ('passed', cast(ok as varchar)), ('failed', cast(n - ok as varchar)),
  ('model', 'm'), ('adapter', null), ('cases', 'true'), ('report', 'true'), ('results', 'true'), ('took', 'true'), ('generation', '{"max_new_tokens":5}')) v(fact, value)"""
