"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code path: plain SQL over the driver views
(``documents``, ``pages``, ...) with the fixtures inlined as CTEs. Helpers below
only produce SQL text for DuckDB (RE2 regexes, ``'g'`` for global replace).
"""

from __future__ import annotations

from corpusmill import config as C
from corpusmill.functions.text import PY_WHITESPACE
from corpusmill.plans.fixtures import with_ctes

ORACLE: dict[str, str] = {}

WS_CHARS = "(" + "||".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"
WS_RE = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
NL = "chr(10)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def rx(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {repl}, 'g')"


def netloc(url: str) -> str:
    return f"regexp_extract({url}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://([^/?#]*))?', 1)"


def host(url: str) -> str:
    return f"lower({netloc(url)})"


def path(url: str) -> str:
    raw = f"regexp_extract({url}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    return f"regexp_replace({raw}, ';[^/]*$', '')"


def unescape(x: str) -> str:
    table = [("&quot;", "'\"'"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&lt;", "'<'"), ("&gt;", "'>'"),
             ("&nbsp;", "chr(160)"), ("&apos;", "''''"), ("&#39;", "''''")]
    for ent, rep in table:
        x = f"replace({x}, {q(ent)}, {rep})"
    # '&amp' also decodes without its semicolon (legacy prefix rule); one
    # left-to-right pass keeps '&amp;amp;' -> '&amp;'
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def html_text(x: str) -> str:
    v = rx(x, r"(?is)<script.*?>.*?</script>", "' '")
    v = rx(v, r"(?is)<style.*?>.*?</style>", "' '")
    v = rx(v, r"(?i)<br" + WS_RE + r"*/?>", NL)
    v = rx(v, r"(?i)</p" + WS_RE + r"*>", f"{NL}||{NL}")
    v = rx(v, r"(?i)</div" + WS_RE + r"*>", NL)
    v = rx(v, r"(?is)<[^>]+>", "' '")
    v = unescape(v)
    v = rx(v, r"[ \t]+", "' '")
    v = rx(v, r"\n[ \t]+", NL)
    v = rx(v, r"\n{3,}", f"{NL}||{NL}")
    return strip(v)


def looks_html(x: str) -> str:
    head = f"lower(substring({x}, 1, {C.HTML_SNIFF_WINDOW}))"
    return "(" + " or ".join(f"contains({head}, {q(m)})" for m in C.HTML_SNIFF_MARKERS) + ")"


FLAG_RE = (
    r"(?i)\b[a-z0-9_]{0,32}\{[^{}\n]{4,200}\}",
    r"(?i)\bflag" + WS_RE + r"*[:=]" + WS_RE + r"*[^\x09-\x0d\x1c-\x20\x{85}\p{Z}`]+",
)


def redact(x: str) -> str:
    for p in FLAG_RE:
        x = rx(x, p, q(C.FLAG_REPLACEMENT))
    return x


def contains_count(h: str, words) -> str:
    return "(" + " + ".join(f"cast(contains({h}, {q(w)}) as integer)" for w in words) + ")"


def category(h: str) -> str:
    scores = {cat: contains_count(h, kws) for cat, kws in C.CATEGORY_KEYWORDS.items()}
    best = "greatest(" + ", ".join(scores.values()) + ")"
    whens = " ".join(f"when {s} = {best} then {q(cat)}" for cat, s in scores.items())
    return f"case when {best} <= 0 then {q(C.FALLBACK_CATEGORY)} {whens} end"


def has_code(x: str) -> str:
    return "(" + " or ".join(f"contains({x}, {q(m)})" for m in C.HAS_CODE_MARKERS) + ")"


def short_hash(x: str) -> str:
    return f"substring(sha1({x}), 1, 10)"


def bucket(x: str) -> str:
    return f"(cast('0x' || {short_hash(x)} as bigint) % 10)"


def keep(url_host: str, url_path: str, text: str) -> str:
    p = f"(case when {url_path} = '' then '/' else {url_path} end)"
    med = f"ends_with({url_host}, {q(C.MEDIUM_HOST_SUFFIX)})"
    head = f"lower(substring({text}, 1, {C.BOILERPLATE_WINDOW}))"
    hosts = ", ".join(q(h) for h in C.LOW_SIGNAL_HOSTS)
    gh = ", ".join(q(h) for h in C.GITHUB_HOSTS)
    return (
        f"not ({url_host} in ({hosts})"
        f" or ({med} and regexp_matches({p}, '^/@[^/]+/?$'))"
        f" or ({url_host} in ({gh}) and not contains({p}, '/blob/') and not contains({p}, '/tree/'))"
        f" or ({med} and {contains_count(head, C.BOILERPLATE_MARKERS)} >= {C.BOILERPLATE_MIN_HITS}))"
    )


def route_method(h: str, body_path: str) -> str:
    return (
        f"case when ends_with({h}, {q(C.AGGREGATOR_HOST_SUFFIX)}) and coalesce({strip(body_path)}, '') <> '' then 'local_cached_body'"
        f" when {h} = {q(C.GITHUB_RAW_HOST)} then 'github_raw'"
        f" when {h} in ('github.com', 'www.github.com') and gh_raw is not null then 'github_raw'"
        f" else 'jina' end"
    )


def gh_raw(url_path: str) -> str:
    parts = f"list_filter(string_split({url_path}, '/'), lambda x: x <> '')"
    return (
        f"case when len({parts}) < 5 then null"
        f" when {parts}[3] = 'blob' then 'https://raw.githubusercontent.com/' || {parts}[1] || '/' || {parts}[2] || '/' || {parts}[4] || '/' || array_to_string({parts}[5:], '/')"
        f" when {parts}[3] = 'tree' then 'https://raw.githubusercontent.com/' || {parts}[1] || '/' || {parts}[2] || '/' || {parts}[4] || '/' || array_to_string({parts}[5:], '/') || '/README.md'"
        f" end"
    )


# Stage W: the transformed rows with parsed URL, method, cleaning steps.
W_BASE = f"""
ok as (
  select ord, coalesce(nullif(final_url, ''), '') as url, body_path, content
  from transformed_fx where transform_status = 'ok'
),
p0 as (select *, {host('url')} as host, {path('url')} as path from ok),
p1 as (select *, {gh_raw('path')} as gh_raw from p0),
p as (select *, {route_method('host', 'body_path')} as method from p1),
c1 as (select *, {strip('content')} as s0 from p),
c2 as (select *, case when method = 'local_cached_body' or {looks_html('s0')} then {html_text('s0')} else s0 end as s1 from c1),
c3 as (select *, {strip(f"case when position({q(C.PREAMBLE_MARKER)} in s1) > 0 then substring(s1, position({q(C.PREAMBLE_MARKER)} in s1) + {len(C.PREAMBLE_MARKER)}) else s1 end")} as s2 from c2),
c4 as (select *, {strip(rx('s2', r'\n{3,}', f'{NL}||{NL}'))} as cleaned from c3),
c5 as (select *, {strip(f"substring({redact('cleaned')}, 1, {C.MAX_ASSISTANT_CHARS})")} as final_text from c4),
links as (
  select {strip('original_url')} as original_url, arg_max({strip('ctftime_writeup_url')}, ord) as agg_url
  from enumeration_fx
  where coalesce({strip('ctftime_writeup_url')}, '') <> '' and coalesce({strip('original_url')}, '') <> ''
  group by 1
),
g as (
  select c5.*, coalesce(l.agg_url, c5.url) as group_key,
         case when ends_with(host, {q(C.AGGREGATOR_HOST_SUFFIX)}) then 0 else 1 end as prio,
         length(content) as raw_len
  from c5 left join links l on c5.url = l.original_url
),
grp as (select group_key, count(*) as group_rows from g group by group_key),
w as (select * from g qualify row_number() over (partition by group_key order by prio desc, raw_len desc, ord asc) = 1),
d as (
  select w.*, grp.group_rows,
    case when length(final_text) < {C.MIN_CONTENT_CHARS} then 'short'
         when not ({keep('host', 'path', 'final_text')}) then 'low_signal' end as drop_reason
  from w join grp using (group_key)
),
k as (
  select *, {category(f"lower(url || {NL} || final_text)")} as category,
         case when {bucket('group_key')} = 0 then 'eval' else 'train' end as split
  from d where drop_reason is null
)
"""


def prompt_case(cat: str) -> str:
    whens = " ".join(f"when {q(k)} then {q(v)}" for k, v in C.USER_PROMPT_BY_CATEGORY.items())
    return f"case {cat} {whens} else {q(C.USER_PROMPT_BY_CATEGORY['misc'])} end"


def w_query(select: str) -> str:
    return with_ctes("", "transformed_fx", "enumeration_fx") + ",\n" + W_BASE.strip() + "\n" + select


ORACLE["writeup_flagship"] = w_query(f"""
select category || '_' || {short_hash('group_key')} as id, category, split, 'unknown' as difficulty,
  {q(C.WRITEUP_SAMPLE_SOURCE)} as source, {q(C.WRITEUP_SAMPLE_LICENSE)} as license, category as challenge_family,
  {prompt_case('category')} as user_prompt, final_text as content, {has_code('final_text')} as has_code, url as source_url
from k
""")

ORACLE["build_samples"] = w_query(f"""
select category || '_' || {short_hash('group_key')} as id, cast(0 as bigint) as pos, 'system' as role, {q(C.DEFAULT_SYSTEM_PROMPT)} as content from k
union all
select category || '_' || {short_hash('group_key')}, cast(1 as bigint), 'user', {prompt_case('category')} from k
union all
select category || '_' || {short_hash('group_key')}, cast(2 as bigint), 'assistant', final_text from k
""")

ORACLE["curation_summary"] = w_query("""
select 'input_ok_rows' as metric, cast((select count(*) from ok) as bigint) as value
union all select 'selected_rows', cast(count(*) as bigint) from d
union all select 'dropped_short', cast(count(*) as bigint) from d where drop_reason = 'short'
union all select 'dropped_low_signal', cast(count(*) as bigint) from d where drop_reason = 'low_signal'
union all select 'train_rows', cast(count(*) as bigint) from k where split = 'train'
union all select 'eval_rows', cast(count(*) as bigint) from k where split = 'eval'
union all select 'category:' || category, cast(count(*) as bigint) from k group by category
""")

ORACLE["select_preferred"] = w_query("select ord, group_key, cast(group_rows as bigint) as group_rows from w join grp using (group_key)")

ORACLE["link_groups"] = w_query("select ord, url, group_key from g")

ORACLE["clean_content"] = w_query("select ord, method as transform_method, cleaned as content from c4")

ORACLE["truncate_min_length"] = w_query(
    f"select ord, final_text as content, cast(length(final_text) as bigint) as n_chars, length(final_text) < {C.MIN_CONTENT_CHARS} as too_short from c5")

ORACLE["low_signal_filter"] = w_query(f"select ord, url, {keep('host', 'path', 'final_text')} as keep from c5")

ORACLE["html_to_text"] = f"select page_id, {html_text('html')} as text from pages"

ORACLE["looks_like_html"] = (
    f"select 'page' as kind, page_id as id, {looks_html(strip('html'))} as is_html from pages "
    f"union all select 'doc', doc_id, {looks_html(strip('text'))} from documents"
)

ORACLE["strip_preamble"] = with_ctes(
    f"select ord, {strip(f'case when position({q(C.PREAMBLE_MARKER)} in content) > 0 then substring(content, position({q(C.PREAMBLE_MARKER)} in content) + {len(C.PREAMBLE_MARKER)}) else content end')} as content from transformed_fx",
    "transformed_fx")

ORACLE["redact_flags"] = with_ctes(
    f"select ord, {redact('content')} as content, contains({redact('content')}, '<FLAG>') as has_flag from transformed_fx",
    "transformed_fx")

ORACLE["infer_category"] = with_ctes(
    f"select ord, {category(f'lower(final_url || {NL} || content)')} as category from transformed_fx", "transformed_fx")

ORACLE["hash_split"] = with_ctes(
    f"select ord, {short_hash('final_url')} as short_hash, {bucket('final_url')} as bucket, "
    f"case when {bucket('final_url')} = 0 then 'eval' else 'train' end as split from transformed_fx", "transformed_fx")

ORACLE["has_code"] = with_ctes(f"select ord, {has_code('content')} as has_code from transformed_fx", "transformed_fx")

ORACLE["url_parts"] = with_ctes(f"""
select id, url, {netloc('url')} as netloc, {host('url')} as host, {path('url')} as path from (
  select page_id as id, url from pages
  union all select ord + 1000000, final_url from transformed_fx) u
""", "transformed_fx")

ORACLE["route_targets"] = with_ctes(f"""
select ord, method as transform_method,
  case when method = 'local_cached_body' then body_path
       when host = {q(C.GITHUB_RAW_HOST)} then final_url
       when method = 'github_raw' then gh_raw
       else {q(C.READER_PROXY_PREFIX)} || regexp_replace(regexp_replace(final_url, '^https://', ''), '^http://', '') end as transform_url
from (select *, {route_method('host', 'body_path')} as method from (
  select *, {gh_raw('path')} as gh_raw from (
    select *, {host('final_url')} as host, {path('final_url')} as path from transformed_fx) a) b) c
""", "transformed_fx")

ORACLE["github_raw_url"] = with_ctes(f"""
select ord, final_url, {gh_raw(path('final_url'))} as raw_url from transformed_fx
where {host('final_url')} in ('github.com', 'www.github.com')
""", "transformed_fx")


# ---------------------------------------------------------------------------
# Stages L, F, R, T
# ---------------------------------------------------------------------------

WS_CLASS_BODY = r"\x09-\x0d\x1c-\x20\x{85}\p{Z}"

ORACLE["url_list"] = with_ctes(f"""
select url, min(ord) as ord from (select ltrim({strip('line')}, chr(65279)) as url, ord from urls_fx) t
where url <> '' and not starts_with(url, '#') group by url
""", "urls_fx")

ORACLE["extract_links"] = f"""
select url, page_ord, pos from (
  select case when regexp_matches(rel, '^[a-zA-Z][a-zA-Z0-9+.-]*:') then rel
              when starts_with(rel, '//') then 'https:' || rel
              when starts_with(rel, '/') then 'https://ctftime.org' || rel
              else 'https://ctftime.org/' || rel end as url, page_ord, pos
  from (select page_id as page_ord, unnest(m) as rel, cast(generate_subscripts(m, 1) - 1 as bigint) as pos
        from (select page_id, regexp_extract_all(html, 'href="(/[^"]+)"', 1) as m from pages) a) b
) c qualify row_number() over (partition by url order by page_ord, pos) = 1
"""

ORIG_RE = r'(?i)Original writeup(?:</a>)?' + WS_RE + r'*\((?:<a[^>]+href=")?(https?://[^")<' + WS_CLASS_BODY + r']+)'


def original_expr(html: str) -> str:
    o = f"regexp_extract({html}, {q(ORIG_RE)}, 1)"
    c = f"regexp_extract({html}, {q(C.CANONICAL_LINK_PATTERN)}, 1)"
    return f"case when {o} <> '' and not ({c} <> '' and {o} = {c}) then {o} end"


ORACLE["original_link"] = with_ctes(f"select page_id, {original_expr('html')} as original_url from detail_fx", "detail_fx")

LINK_ROWS = f"""lr as (select page_id + 1 as idx, 'https://ctftime.org/writeup/' || cast(page_id as varchar) as agg,
  {original_expr('html')} as orig from detail_fx),
tg as (select agg as url, idx, 0 as pos from lr union all select orig, idx, 1 from lr where orig is not null and orig <> ''),
td as (select * from tg qualify row_number() over (partition by url order by idx, pos) = 1)"""

ORACLE["target_urls"] = with_ctes("", "detail_fx") + ",\n" + LINK_ROWS + """
select url, cast(idx as bigint) as "index", cast(pos as bigint) as pos from td"""

ORACLE["enumeration_summary"] = with_ctes("", "detail_fx") + ",\n" + LINK_ROWS + """
select 'writeup_pages' as metric, cast(count(*) as bigint) as value from lr
union all select 'target_urls', cast(count(*) as bigint) from td
union all select 'original_errors', cast(0 as bigint)"""


def ext_case(ct: str) -> str:
    whens = " ".join(f"when {q(k)} then {q(v)}" for k, v in C.EXTENSION_BY_CONTENT_TYPE.items())
    return f"case {ct} {whens} else {q(C.DEFAULT_EXTENSION)} end"


def filename(idx: str, url: str, ct: str) -> str:
    last = f"regexp_extract({path(url)}, '([^/]*)(?:/\\.?)*$', 1)"
    base = f"coalesce(nullif({last}, ''), nullif({netloc(url)}, ''), 'page')"
    san0 = f"trim(regexp_replace({base}, '[^A-Za-z0-9._-]+', '_', 'g'), '._-')"
    san = f"(case when {san0} = '' then 'file' else {san0} end)"
    return f"printf('%03d', {idx}) || '_' || (case when contains({san}, '.') then {san} else {san} || {ext_case(ct)} end)"


_CT_MAIN = strip("split_part(content_type_raw, ';', 1)")
CT = f"(case when coalesce(content_type_raw, '') = '' then {q(C.DEFAULT_CONTENT_TYPE)} else lower({_CT_MAIN}) end)"

FETCH_LOG = f"""fl as (
  select cast(idx as bigint) as "index", url, status, ok,
    case when ok then final_url end as final_url, case when ok then ct end as content_type,
    case when ok then cast(strlen(body) as bigint) end as content_length, case when ok then sha256(body) end as sha256,
    case when ok then {filename('idx', 'final_url', 'ct')} end as filename
  from (select *, status <> 'error' as ok, {CT} as ct from fetch_fx) a
)"""

ORACLE["fetch_log"] = with_ctes("", "fetch_fx") + ",\n" + FETCH_LOG + """
select "index", url, status, final_url, content_type, content_length, sha256, filename from fl"""

SLUG_BATCH = "trim(regexp_replace(trim('ctftime batch/01'), '[^a-zA-Z0-9._-]+', '_', 'g'), '._-')"


def ledger_sql(approve_training: bool, approve_redistribution: bool, review_status: str | None, basis: str) -> str:
    okst = "coalesce(nullif(status, ''), 'error') in ('ok', 'cached')"
    rs = f"case when {okst} then {q(review_status) if review_status else q('pending_review')} else 'fetch_error' end"
    return f"""led as (
  select {SLUG_BATCH} || '_' || printf('%04d', "index") as review_id, 'ctftime batch/01' as batch_name,
    url as source_url, coalesce(nullif(final_url, ''), nullif(url, '')) as final_url,
    '2026-01-01T00:00:00+00:00' as fetched_at, case when ok then 200 end as http_status,
    coalesce(nullif(status, ''), 'error') as fetch_status,
    case when not ok then 'ConnectError: connection failed' end as fetch_error,
    content_type, sha256, case when ok then 'data/raw/scraped/batch/files/' || filename end as body_path,
    cast(null as varchar) as author_if_known, '' as license_if_known, {q(basis.strip())} as permission_basis,
    {rs} as review_status, {okst} and {str(approve_training).lower()} as allowed_for_training,
    {okst} and {str(approve_redistribution).lower()} as allowed_for_redistribution,
    'review_required' as redistribution_status, 'not_started' as transformation_status, '' as notes, "index" as ord
  from fl
)"""


LEDGER_COLS = ", ".join(C.LEDGER_COLUMNS)

ORACLE["review_ledger"] = with_ctes("", "fetch_fx") + ",\n" + FETCH_LOG + ",\n" + ledger_sql(
    True, False, "approved_for_training", "  explicit permission ") + f"\nselect {LEDGER_COLS} from led"

ORACLE["review_summary"] = with_ctes("", "fetch_fx") + ",\n" + FETCH_LOG + ",\n" + ledger_sql(False, True, None, "") + """
select 'records' as metric, cast(count(*) as bigint) as value from led
union all select 'pending_reviews', cast(count(*) filter (where review_status = 'pending_review') as bigint) from led
union all select 'approved_for_training', cast(count(*) filter (where allowed_for_training) as bigint) from led
union all select 'approved_for_redistribution', cast(count(*) filter (where allowed_for_redistribution) as bigint) from led"""

REVIEWED = with_ctes("", "fetch_fx") + ",\n" + FETCH_LOG + ",\n" + ledger_sql(
    True, False, "approved_for_training", "  explicit permission ") + """,
rv as (select *, case when ord % 5 = 0 then false else allowed_for_training end as allowed2 from led)"""

ORACLE["approved_rows"] = REVIEWED + """
select review_id, source_url, fetch_status from rv where fetch_status in ('ok', 'cached') and allowed2 is not distinct from true"""

ORACLE["approved_rows_limited"] = REVIEWED + """
select review_id, source_url, fetch_status from rv where fetch_status in ('ok', 'cached') and allowed2 is not distinct from true
order by ord limit 25"""

ORACLE["cache_lookup"] = with_ctes(f"""
select f.idx, f.url, l.k is not null as hit, l.body_hash
from fetch_fx f left join (
  select * from (select {strip('url')} as k, arg_max(status, ord) as status, arg_max(body_hash, ord) as body_hash
                 from cache_fx group by 1) x where status = 'ok') l
  on {strip('f.url')} = l.k
""", "fetch_fx", "cache_fx")

ORACLE["cache_upsert"] = with_ctes(f"""
select {strip('url')} as cache_key, arg_max(status, ord) as status, arg_max(body_hash, ord) as body_hash, cast(max(ord) as bigint) as ord
from (select url, status, body_hash, ord from cache_fx
      union all select url, 'ok', sha1(body), idx + 2000000 from fetch_fx where status = 'ok') u
group by 1
""", "fetch_fx", "cache_fx")

ORACLE["normalize_text"] = with_ctes(f"""
select doc_id, c as content, sha256(c) as content_sha256
from (select doc_id, {strip(rx('content', r'\r\n?', NL))} as c from crlf_fx) t
""", "crlf_fx")

ORACLE["transform_summary"] = with_ctes("", "transformed_fx") + f""",
m as (select transform_status, {route_method('h', 'body_path')} as method
        from (select *, {gh_raw('p')} as gh_raw from (select *, {host('final_url')} as h, {path('final_url')} as p from transformed_fx) a) b)
select 'input_rows' as metric, cast(count(*) as bigint) as value from transformed_fx
union all select 'selected_rows', cast(count(*) as bigint) from m
union all select 'successes', cast(count(*) filter (where transform_status = 'ok') as bigint) from m
union all select 'errors', cast(count(*) filter (where transform_status = 'error') as bigint) from m
union all select 'method:' || method, cast(count(*) as bigint) from m group by method
"""


# ---------------------------------------------------------------------------
# Stage D: dataset build
# ---------------------------------------------------------------------------

def slug(x: str, fallback: str = "sample") -> str:
    s = f"trim(regexp_replace({strip(x)}, '[^a-zA-Z0-9._-]+', '_', 'g'), '._-')"
    return f"(case when {s} = '' then {q(fallback)} else {s} end)"


QA_BASE = with_ctes("", "qa_fx") + """,
qa as (select *, conv_id * 100 + turn + 1 as line,
         coalesce(nullif(id, ''), 'qa_source_qa_0_' || cast(conv_id * 100 + turn + 1 as varchar)) as raw_id,
         coalesce(prompt, question, user_text) as p, coalesce(answer, assistant, completion) as a from qa_fx)"""

ORACLE["qa_to_messages"] = QA_BASE + f""",
s as (select *, {slug('raw_id')} as sid from qa)
select sid as id, cast(0 as bigint) as pos, 'system' as role, {q(C.DEFAULT_SYSTEM_PROMPT)} as content from s
union all select sid, cast(1 as bigint), 'user', {strip('p')} from s
union all select sid, cast(2 as bigint), 'assistant', {strip('a')} from s"""

ORACLE["default_ids"] = QA_BASE + "\nselect conv_id, turn, raw_id as id from qa"

ORACLE["slugify_ids"] = QA_BASE + f"\nselect conv_id, turn, {slug('raw_id')} as id from qa"

ORACLE["anonymize_ids"] = QA_BASE + f"""
select conv_id, turn, {slug("lower(coalesce(category, 'sample'))")} || '_' || {short_hash('raw_id')} as id_strict,
  {slug(rx('raw_id', '(?i)qa', q('item')))} || '_' || {short_hash('raw_id')} as id_policy from qa"""


def role_norm(r: str) -> str:
    base = f"lower({strip(f'coalesce({r}, {q("None")})')})"
    whens = " ".join(f"when {q(k)} then {q(v)}" for k, v in C.ROLE_ALIASES.items())
    return f"(case {base} {whens} else {base} end)"


ALLOWED = ", ".join(q(r) for r in C.ALLOWED_ROLES)

MSG_BASE = with_ctes("", "messages_fx") + f""",
m0 as (select conv_id, turn as pos, {role_norm('role')} as role, content as raw, {strip('content')} as content from messages_fx),
m as (select *, case when role not in ({ALLOWED}) then 'unsupported_role'
                     when raw is null or {strip('raw')} = '' then 'blank_content' end as err from m0),
per as (select conv_id, cast(count(*) as bigint) as n_messages, arg_min(role, pos) as first_role,
          arg_min(err, pos) filter (where err is not null) as first_err,
          count(*) filter (where role = 'assistant') as n_assistant from m group by conv_id),
smp as (select conv_id, n_messages, first_role <> 'system' as injected,
          coalesce(first_err, case when n_assistant = 0 then 'no_assistant' end) as error_reason from per)"""

ORACLE["messages_normalize"] = MSG_BASE + f"""
select m.conv_id, cast(m.pos + cast(s.injected as integer) as bigint) as pos, m.role, m.content
from m join smp s using (conv_id) where s.error_reason is null
union all
select conv_id, cast(0 as bigint), 'system', {q(C.DEFAULT_SYSTEM_PROMPT)} from smp where error_reason is null and injected"""

ORACLE["message_quarantine"] = MSG_BASE + "\nselect conv_id, n_messages, error_reason from smp where error_reason is not null"

ORACLE["system_injection"] = MSG_BASE + "\nselect conv_id, injected from smp where error_reason is null"

MERGED = QA_BASE + """,
ctl as (select record_index,
  case record_index when 0 then 'rev' when 1 then 'pwn' end as d_category,
  case record_index when 0 then 'easy' when 1 then 'hard' else 'medium' end as d_difficulty,
  case record_index when 0 then 'warmup' when 2 then 'heap' end as d_challenge_family,
  case record_index when 0 then 'train' when 1 then 'eval' end as d_split,
  'self_authored' as d_source,
  case when record_index = 2 then 'internal_or_permitted' end as d_license,
  case when record_index < 2 then 'python' end as d_language, record_index = 0 as d_has_code
  from (select distinct conv_id % 3 as record_index from qa_fx) r),
mg as (select qa.conv_id, qa.raw_id as id, coalesce(qa.category, d_category, 'unknown') as category,
  coalesce(d_difficulty, 'unknown') as difficulty, coalesce(d_challenge_family, 'unknown') as challenge_family,
  d_split as split, coalesce(d_source, 'unknown') as source, coalesce(d_license, 'unknown') as license,
  d_language as language, d_has_code as has_code
  from qa left join ctl on qa.conv_id % 3 = ctl.record_index)"""

ORACLE["defaults_merge"] = MERGED + "\nselect id, category, difficulty, challenge_family, split, source, license, language, has_code from mg"

ORACLE["dataset_summary"] = MERGED + """
select 'total_samples' as metric, cast(count(*) as bigint) as value from mg
union all select 'split:' || coalesce(nullif(split, ''), 'dataset'), cast(count(*) as bigint) from mg group by 1
union all select 'category:' || category, cast(count(*) as bigint) from mg group by 1
union all select 'source:' || source, cast(count(*) as bigint) from mg group by 1
union all select 'manifest:m' || cast(conv_id % 2 as varchar) || '.json', cast(count(*) as bigint) from mg group by 1"""

ORACLE["duplicate_ids"] = f"""
select 'doc_' || {short_hash('text')} as id, cast(count(*) as bigint) as n from documents group by 1 having count(*) > 1"""

ORACLE["manifest_records"] = with_ctes("""
select manifest_id, cast(0 as bigint) as record_index, cast(0 as bigint) as path_index,
  'data/m' || cast(manifest_id as varchar) || '/a.jsonl' as path, 'jsonl_messages' as format
from manifest_fx where manifest_id % 10 <> 9 and manifest_id % 2 = 0
union all select manifest_id, 0, 1, 'data/m' || cast(manifest_id as varchar) || '/b.jsonl', 'jsonl_messages'
from manifest_fx where manifest_id % 10 <> 9 and manifest_id % 2 = 0
union all select manifest_id, 1, 0, 'data/m' || cast(manifest_id as varchar) || '/qa.json', 'json_qa'
from manifest_fx where manifest_id % 10 <> 9 and manifest_id % 2 = 0
union all select manifest_id, 0, 0, 'data/m' || cast(manifest_id as varchar) || '/qa.jsonl', 'jsonl_qa'
from manifest_fx where manifest_id % 10 <> 9 and manifest_id % 2 = 1
""", "manifest_fx")


# ---------------------------------------------------------------------------
# Redaction and the review gate
# ---------------------------------------------------------------------------

def doc_redact(x: str) -> str:
    x = rx(x, 'token = "[0-9a-f]{40}"', q("<TOKEN>"))
    return rx(x, r"(?i)[A-Za-z0-9._]+@[A-Za-z0-9.]+", q("<EMAIL>"))


ORACLE["redact_rules"] = (
    f"select doc_id, {doc_redact('text')} as text, {doc_redact('lang')} as lang, {doc_redact('source')} as source from documents")

ORACLE["drop_metadata"] = QA_BASE + """
select raw_id as id, to_json(struct_pack(category := category,
  artifacts := struct_pack(language := 'python', meta := struct_pack(state := 'ok')),
  tags := [struct_pack(tag := 't1')])) as doc
from qa"""

ORACLE["review_gate"] = with_ctes("", "manifest_fx") + f""",
r as (select manifest_id, source, source_bucket, allowed_for_training, allowed_for_redistribution, review_status,
        redistribution_status,
        case when manifest_id % 17 = 0 then 'old/' || source_ledger_path else source_ledger_path end as ledger
      from manifest_fx),
listing as (select distinct source_ledger_path as p from manifest_fx where source_ledger_path is not null),
g as (select r.*, {strip("coalesce(source, '')")} in ('transformed_scraped')
          or max({strip("coalesce(source_bucket, '')")} in ('scraped_derivative')) over (partition by manifest_id) as requires_review,
        l.p is not null as ledger_exists,
        array_to_string(list_filter([case when allowed_for_training is null then 'allowed_for_training' end,
          case when allowed_for_redistribution is null then 'allowed_for_redistribution' end,
          case when review_status is null then 'review_status' end,
          case when redistribution_status is null then 'redistribution_status' end,
          case when ledger is null then 'source_ledger_path' end], lambda x: x is not null), ',') as missing
      from r left join listing l on r.ledger = l.p)
select manifest_id, requires_review, case when requires_review then
  case when missing <> '' then 'missing:' || missing
       when {strip('review_status')} = '' then 'review_status_blank'
       when {strip('redistribution_status')} = '' then 'redistribution_status_blank'
       when {strip('ledger')} = '' then 'source_ledger_path_blank'
       when not ledger_exists then 'ledger_missing'
       when allowed_for_training is distinct from true then 'not_allowed_for_training'
       when lower({strip('review_status')}) in ('pending', 'review_required', 'unreviewed') then 'blocked_review_status'
  end end as gate_error
from g"""


# ---------------------------------------------------------------------------
# Stages C and E
# ---------------------------------------------------------------------------

def chat(role: str, content: str) -> str:
    return f"'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


GEN = "'<|im_start|>assistant' || chr(10)"

CASES = with_ctes("", "cases_fx", "responses_fx") + f""",
cs as (select *, coalesce(id, printf('case_%04d', item_id + 1)) as cid from cases_fx),
chk as (
  select cid, item_id, 0 as pos, 'exact' as type, exact_v as expected from cs where exact_v is not null
  union all select cid, item_id, 1, 'contains', contains_v from cs where contains_v is not null
  union all select cid, item_id, 2, 'regex', regex_v from cs where regex_v is not null),
res as (
  select chk.*, r.response,
    coalesce(case type when 'exact' then {strip('r.response')} = {strip('expected')}
                       when 'contains' then contains(r.response, expected)
                       when 'regex' then regexp_matches(r.response, expected) end, false) as passed,
    case type when 'exact' then 'exact match' when 'contains' then 'substring match' else 'regex match' end as detail
  from chk join responses_fx r using (item_id)),
cres as (select cid, item_id, bool_and(passed) as passed, count(*) as n from res group by cid, item_id)"""

ORACLE["eval_default_ids"] = with_ctes("select item_id, coalesce(id, printf('case_%04d', item_id + 1)) as id from cases_fx", "cases_fx")

ORACLE["eval_checks"] = CASES + """
select cid as id, cast(row_number() over (partition by cid, item_id order by pos) - 1 as bigint) as pos,
  type, expected, passed, detail from res"""

ORACLE["eval_cases"] = CASES + """
select cs.cid as id, cs.category, cres.passed, cast(cres.n as bigint) as n_checks, r.response
from cs join cres using (item_id) join responses_fx r using (item_id)"""

ORACLE["eval_report"] = CASES + """,
rep as (select coalesce(nullif(cs.category, ''), 'uncategorized') as category, cres.passed from cs join cres using (item_id))
select category, cast(count(*) as bigint) as total, cast(count(*) filter (where passed) as bigint) as passed,
  cast(count(*) filter (where not passed) as bigint) as failed,
  round_even(count(*) filter (where passed) / count(*), 4) as pass_rate
from rep group by category
union all
select '__total__', cast(count(*) as bigint), cast(count(*) filter (where passed) as bigint),
  cast(count(*) filter (where not passed) as bigint), round_even(count(*) filter (where passed) / count(*), 4) from rep"""

ORACLE["render_chat_text"] = w_query(f"""
select category || '_' || {short_hash('group_key')} as id,
  {chat("'system'", q(C.DEFAULT_SYSTEM_PROMPT))} || {chat("'user'", prompt_case('category'))} || {chat("'assistant'", 'final_text')} as text
from k""")

ORACLE["render_eval_prompt"] = with_ctes(f"""
select coalesce(id, printf('case_%04d', item_id + 1)) as id,
  case when item_id % 7 = 3 then {chat("'user'", 'prompt')} || {GEN}
       else {chat("'system'", q(C.DEFAULT_SYSTEM_PROMPT))} || {chat("'user'", 'prompt')} || {GEN} end as text,
  case when item_id % 7 = 3 then {chat("'user'", 'prompt')} || {GEN} else prompt end as text_no_system
from cases_fx""", "cases_fx")
