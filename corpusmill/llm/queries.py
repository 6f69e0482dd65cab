"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from corpusmill.llm.alignment import align_documents
from corpusmill.llm.common import table
from corpusmill.llm.decontaminate import contamination
from corpusmill.llm.linkgraph import judge_sql, judge_urls
from corpusmill.llm.mixing import mix
from corpusmill.llm.ngram_join import jaccard_components
from corpusmill.llm.prefix_trie import conversation_trie
from corpusmill.llm.quality import score_documents
from corpusmill.llm.secrets import scan_secrets
from corpusmill.llm.sharding import shard_documents
from corpusmill.llm.site_style import main_texts
from corpusmill.llm.topk import top_k
from corpusmill.llm.warc import archive_round_trip
from corpusmill.llm.windows import repeated_passages

QUERIES: dict = {}
ORACLE: dict = {}


def op10_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), 5, 80)


QUERIES["op10_ngram_jaccard_join"] = op10_ngram_jaccard_join


def op7_quality_classifier(spark, sf_dir):
    return score_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "labels").select("doc_id", "quality"),
    )


QUERIES["op7_quality_classifier"] = op7_quality_classifier


def op6_benchmark_decontamination(spark, sf_dir):
    return contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )


QUERIES["op6_benchmark_decontamination"] = op6_benchmark_decontamination


def op8_virtual_slot_sharding(spark, sf_dir):
    out = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


QUERIES["op8_virtual_slot_sharding"] = op8_virtual_slot_sharding


def op9_pivotal_mixing(spark, sf_dir):
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


QUERIES["op9_pivotal_mixing"] = op9_pivotal_mixing


def op1_exact_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), 5, 50)


QUERIES["op1_exact_top_k"] = op1_exact_top_k
ORACLE["op1_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


#: (host, path, verdict)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op2_secret_scan(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op2_secret_scan"] = op2_secret_scan


def op3_link_graph_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)


QUERIES["op3_link_graph_filter"] = op3_link_graph_filter
ORACLE["op3_link_graph_filter"] = judge_sql(URL_RULES)


def op4_warc_normaliser(spark, sf_dir):
    return archive_round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES["op4_warc_normaliser"] = op4_warc_normaliser
ORACLE["op4_warc_normaliser"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), g AS (
  SELECT digest, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY digest HAVING count(*) > 1
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN last IS NOT NULL AND (page_id IS NULL OR page_id < last) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last IS NOT NULL AND (page_id IS NULL OR page_id < last) THEN last END AS refers_to
FROM p LEFT JOIN g ON p.digest = g.digest
"""


def op5_compact_windows(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op5_compact_windows"] = op5_compact_windows


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op6_benchmark_decontamination"] = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
       FROM benchmark WHERE item_id IS NOT NULL),
bi AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS p FROM bi),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw JOIN (SELECT DISTINCT n FROM win) l ON len(w) >= n),
hits AS (SELECT DISTINCT doc_id, i, di.n, item FROM di JOIN win ON win.n = di.n AND win.p = array_to_string(w[i : i + di.n - 1], ' ')),
spots AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN spots USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

ORACLE["op10_ngram_jaccard_join"] = rf"""
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
di AS (SELECT doc_id, w, least(5, len(w)) AS n, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM dw WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, n || ' ' || array_to_string(w[i : i + n - 1], ' ') AS s FROM di),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT x AS node, x AS other FROM edge UNION SELECT node, y FROM reach JOIN edge ON other = x),
comp AS (SELECT node, min(other) AS c FROM reach GROUP BY node)
SELECT dw.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, dw.doc_id) AS component_id
FROM dw LEFT JOIN size ON size.doc_id = dw.doc_id LEFT JOIN comp ON comp.node = dw.doc_id
"""


def op11_token_alignment(spark, sf_dir):
    out = align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES["op11_token_alignment"] = op11_token_alignment


def op12_site_style_text(spark, sf_dir):
    return main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES["op12_site_style_text"] = op12_site_style_text


def op13_conversation_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES["op13_conversation_trie"] = op13_conversation_trie

# crc32 of a conv_id's decimal digits, bit by bit (polynomial 0xEDB88320)
_CRC = """
list_reduce(list_transform(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                lambda ch: [CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])), lambda v: CAST(v AS BIGINT)),
            lambda acc, v: CASE WHEN xor(acc, v) % 2 = 1 THEN xor(xor(acc, v) >> 1, 3988292384) ELSE xor(acc, v) >> 1 END,
            CAST(4294967295 AS BIGINT))
"""
ORACLE["op13_conversation_trie"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(CAST(length(role) AS VARCHAR) || ':' || role || text
                       ORDER BY turn NULLS FIRST, md5(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS s,
         list(CAST(len(regexp_extract_all(text, '[^ 	-]+')) AS BIGINT)
              ORDER BY turn NULLS FIRST, md5(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS w
  FROM t GROUP BY conv_id
), h AS (SELECT *, xor({_CRC}, 4294967295) % 4 AS h FROM c),
r AS (
  SELECT a.conv_id, list_concat(coalesce(b.s[1 : a.h], []), a.s[a.h + 1 :]) AS s,
         list_concat(coalesce(b.w[1 : a.h], []), a.w[a.h + 1 :]) AS w
  FROM h a LEFT JOIN c b ON b.conv_id = a.conv_id - a.conv_id % 20
), p AS (
  SELECT conv_id, len(s) AS n, unnest(range(0, len(s) + 1)) AS depth, s, w FROM r
), nodes AS (
  SELECT s[1 : depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(max(w[depth]), 0) * (count(*) - 1) AS own,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM p GROUP BY s[1 : depth], depth
), kids AS (
  SELECT path[1 : depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), up AS (
  SELECT path[1 : d] AS path, d AS depth, sum(leaf) AS n_leaves, sum(own) AS saved
  FROM (SELECT n.path, n.own, CASE WHEN k.path IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, n.depth + 1)) AS d
        FROM nodes n LEFT JOIN kids k ON k.path = n.path AND k.depth = n.depth)
  GROUP BY ALL
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN up ON up.path = n.path AND up.depth = n.depth
LEFT JOIN kids k ON k.path = n.path AND k.depth = n.depth
LEFT JOIN nodes q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.path = n.path[1 : n.depth - 1]
"""
