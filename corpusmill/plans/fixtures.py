"""Derived fixtures over the driver tables.

Plain SQL text that runs unchanged in Spark and DuckDB. ``queries()`` runs it
through parameterised ``spark.sql`` over the parquet tables (nothing is left
in the session catalog); ``oracle_sql()`` inlines it as CTEs. Each fixture is
a deterministic function of the given tables, so its size grows with them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from corpusmill.session import TABLES, load_tables, run_sql

FIXTURES: dict[str, str] = {}

FIXTURES["enumeration_fx"] = """
select concat('https://ctftime.org/writeup/', cast(doc_id as varchar(20))) as ctftime_writeup_url,
       concat('https://blog.example.org/w/', cast(doc_id as varchar(20))) as original_url, doc_id as ord
from documents where doc_id % 8 = 0
"""

FIXTURES["transformed_fx"] = """
select doc_id as ord,
  case doc_id % 8
    when 0 then concat('https://ctftime.org/writeup/', cast(doc_id as varchar(20)))
    when 1 then concat('https://blog.example.org/w/', cast(doc_id - 1 as varchar(20)))
    when 2 then concat('https://github.com/acme/r', cast(doc_id as varchar(20)),
      case when doc_id % 16 = 2 then '/blob/main/README.md' else '/tree/main/w' end)
    when 3 then concat('https://github.com/acme/r', cast(doc_id as varchar(20)))
    when 4 then concat('https://medium.com/@u', cast(doc_id as varchar(20)))
    when 5 then concat('https://www.youtube.com/watch?v=', cast(doc_id as varchar(20)))
    when 6 then concat('https://medium.com/@u/post-', cast(doc_id as varchar(20)))
    else concat('https://raw.githubusercontent.com/acme/r/main/', cast(doc_id as varchar(20)), '.md') end as final_url,
  case when doc_id % 3 = 0 then '/cache/a.html' end as body_path,
  case when doc_id % 11 = 0 then 'error' else 'ok' end as transform_status,
  concat(case when doc_id % 16 = 6 then 'Open in app Sign up Sign in 10 Followers ' else '' end,
         case when doc_id % 13 = 0 then 'Title: x Markdown Content: ' else '' end, text,
         case doc_id % 6 when 0 then ' pwntools rop libc' when 1 then ' ghidra angr decompile'
           when 2 then ' rsa aes ecb lattice' when 3 then ' pcap wireshark exif'
           when 4 then ' whois osint dns' else '' end,
         case doc_id % 5 when 0 then concat(' flag: CTF{', substring(sha1(text), 1, 12), '}')
           when 1 then ' FLAG = abc' else '' end) as content
from documents
"""

FIXTURES["fetch_fx"] = """
select page_id + 1 as idx, url, url as final_url, html as body,
  case when page_id % 10 = 3 then 'error' when page_id % 10 = 7 then 'cached' else 'ok' end as status,
  case page_id % 4 when 0 then 'text/html; charset=UTF-8' when 1 then 'TEXT/HTML' when 2 then 'application/json ;v=1' end as content_type_raw
from pages
"""

FIXTURES["cache_fx"] = """
select url, case when page_id % 6 = 0 then 'error' else 'ok' end as status, sha1(html) as body_hash, page_id as ord
from pages where page_id % 2 = 0
union all
select url, 'ok' as status, sha1(concat(html, 'v2')) as body_hash, page_id + 1000000 as ord from pages where page_id % 8 = 0
"""

FIXTURES["urls_fx"] = """
select page_id as ord, case when page_id % 9 = 4 then concat('# ', url) when page_id % 9 = 5 then '   '
  when page_id % 9 = 6 then concat('  ', url, ' ') else url end as line from pages
union all
select page_id + 1000000 as ord, url as line from pages where page_id % 3 = 0
"""

FIXTURES["qa_fx"] = """
select conv_id, turn,
  case when conv_id % 4 = 0 then null else concat('qa ', cast(conv_id as varchar(20)), '/', cast(turn as varchar(20))) end as id,
  case when conv_id % 3 = 0 then text end as prompt, case when conv_id % 3 = 1 then text end as question,
  case when conv_id % 3 = 2 then text end as user_text,
  case when turn % 4 = 0 then nxt end as answer, case when turn % 4 = 2 then nxt end as assistant,
  case when turn % 4 in (1, 3) then nxt end as completion,
  case when conv_id % 5 = 0 then 'rev' when conv_id % 5 = 1 then 'pwn' end as category
from (select u.conv_id, u.turn, u.text, a.text as nxt from conversations u
      join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
      where u.role = 'user' and a.role = 'assistant') z
"""

FIXTURES["messages_fx"] = """
select conv_id, turn,
  case when role = 'user' and conv_id % 4 = 1 then ' Human ' when role = 'user' and conv_id % 4 = 2 then 'PROMPT'
       when role = 'assistant' and conv_id % 4 = 3 then 'Bot' when conv_id % 25 = 24 then 'narrator' else role end as role,
  case when conv_id % 3 = 0 then concat('  ', text, ' ') when conv_id % 50 = 49 and turn = 1 then '   ' else text end as content
from conversations
"""

FIXTURES["cases_fx"] = """
select item_id, case when item_id % 6 = 5 then null else concat('case-', cast(item_id as varchar(20))) end as id,
  case item_id % 4 when 0 then 'rev' when 1 then 'pwn' when 2 then 'web' end as category, text as prompt,
  case when item_id % 5 = 0 then text end as exact_v, substring(text, 1, 12) as contains_v,
  case when item_id % 2 = 0 then '(?i)^[a-z]+ ' end as regex_v
from benchmark
"""

FIXTURES["responses_fx"] = """
select item_id, case item_id % 3 when 0 then text when 1 then concat(' ', text, ' ') else concat('# ', substring(text, 20)) end as response from benchmark
"""

FIXTURES["detail_fx"] = """
select page_id, concat(case when page_id % 3 = 0 then concat('<link rel="canonical" href="https://ctftime.org/writeup/', cast(page_id as varchar(20)), '">') else '' end, html,
  case page_id % 4
    when 0 then concat('Original writeup</a> (<a rel="x" href="https://blog.example.org/w/', cast(page_id as varchar(20)), '">link</a>)')
    when 1 then concat('ORIGINAL WRITEUP (https://blog.example.org/w/', cast(page_id as varchar(20)), ')')
    when 2 then concat('Original writeup (https://ctftime.org/writeup/', cast(page_id as varchar(20)), ')') else '' end) as html
from pages
"""

FIXTURES["crlf_fx"] = """
select doc_id, concat('  ', replace(replace(text, '. ', concat('.', chr(13), chr(10))), ', ', concat(',', chr(13)))) as content from documents
"""

FIXTURES["manifest_fx"] = """
select doc_id as manifest_id, case when doc_id % 3 = 0 then 'transformed_scraped' else 'self_authored' end as source,
  case when doc_id % 4 = 1 then 'scraped_derivative' end as source_bucket,
  case when doc_id % 7 = 0 then null else quality = 1 end as allowed_for_training,
  case when doc_id % 11 = 0 then null else toxic = 0 end as allowed_for_redistribution,
  case doc_id % 5 when 0 then 'Pending' when 1 then 'approved_for_training' when 2 then 'pending_review'
    when 3 then ' review_required ' else '' end as review_status,
  'manual_review_required' as redistribution_status, case when doc_id % 13 = 0 then null else 'ledger.jsonl' end as source_ledger_path
from labels
"""


def tables_of(sql: str) -> list[str]:
    return [t for t in TABLES if re.search(rf"\b{t}\b", sql)]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived fixture as a DataFrame (the driver tables it reads are
    registered first)."""
    return run_sql(spark, FIXTURES[name], load_tables(spark, sf_dir, tables_of(FIXTURES[name])))


def with_ctes(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named fixtures as CTEs (for DuckDB)."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} as ({FIXTURES[n].strip()})" for n in names)
    return f"with {ctes}\n{sql}"
