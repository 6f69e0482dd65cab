"""URL filter: host and path rules, and trust spread over the link graph.

A rule (host, path, verdict) fits its host and all subdomains if the url's path
starts with the rule's path; of the fitting rules the longest decides. Urls that
no rule fits get their host's verdict: hosts are seeded with the share of their
pages that rules allow (trust) or block (distrust). Trust follows links forward
as a personalised PageRank; distrust follows them backward, from a blocked host
to those that link to it. What a host receives is measured against what it would
receive if every host were a full seed, so a host that links to blocked hosts alone
has full distrust whether they have two links or millions. The host's own rules
count for the pages they fit, the received shares for the rest; a host whose
distrust exceeds its trust by more than ``THRESHOLD`` is blocked.

DataFrame functions only. Edges are counted per host pair before the shuffle,
ranks are staged every round, so a hub's edges can be split in the joins, and
the driver sees one number a round.

Defined results: null urls and urls without ``://`` have empty host and path, no
rule, and are allowed. Null html has no links. Repeated rows count as pages of
their own and return a row each; null page_ids come back as null. Links without
a host, and links to the own host, carry nothing. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

DAMPING, ROUNDS, THRESHOLD, SLACK = 0.85, 10, 0.5, 1e-6
#: Rules are configuration, written into the plan; beyond this many use a table.
MAX_RULES = 2000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src|action)[ \t\r\n\f]*=[ \t\r\n\f]*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'> \t\r\n\f]*)"""


def _lower(c):
    return F.translate(c, UPPER, LOWER)


def url_parts(url):
    """(host, path) columns of a url column."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    pattern = "://([^/?#]*)([^?#]*)"
    return _lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def fitting_rule(host: str, path: str, rules):
    """(rule, verdict) columns of the longest fitting rule, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError("too many rules for a plan")
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r)):  # the longest is asked first
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): number of pages of host src with a link to host dst."""
    links = F.regexp_extract_all(F.coalesce(F.col(html).cast("string"), F.lit("")), F.lit(LINK), F.lit(1))
    hosts = F.array_distinct(F.transform(links, lambda x: _lower(F.regexp_extract(x, "//([^/?#]*)", 1))))
    out = pages.select(url_parts(url)[0].alias("src"), F.explode(hosts).alias("dst"))
    return out.filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust), both from 0 to 1, for seeds (host, t0, d0) with
    t0 + d0 <= 1: the seed, and for the rest of the host the share of received rank
    that comes from seeds. ``u`` and ``v`` are the ranks with every host a seed."""
    edges = stage(edges, "edges")
    outs = edges.groupBy("src").agg(F.sum("n").alias("so"))
    ins = edges.groupBy("dst").agg(F.sum("n").alias("si"))
    edges = stage(
        edges.join(stage(outs, "outs"), "src").join(stage(ins, "ins"), "dst")
        .select("src", "dst", (F.col("n") / F.col("so")).alias("forward"), (F.col("n") / F.col("si")).alias("back")), "weights")
    none = F.lit(0.0)
    linked = edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct().select("host", none.alias("t0"), none.alias("d0"))
    seeds = stage(seeds.select("host", "t0", "d0").unionByName(linked).groupBy("host").agg(F.max("t0").alias("t0"), F.max("d0").alias("d0")), "seeds")
    start = seeds.select("host", F.col("t0").alias("t"), F.col("d0").alias("d"), F.lit(1.0).alias("u"), F.lit(1.0).alias("v"))
    rank, names = start, ("t", "d", "u", "v")
    moved = sum((F.sum(c) for c in names), F.lit(0.0))
    for _ in range(rounds):
        def passed(c, weight):
            return (F.lit(damping) * F.col(c) * F.col(weight)).alias(c)
        trust = edges.join(rank, edges["src"] == rank["host"]).select(
            F.col("dst").alias("host"), passed("t", "forward"), none.alias("d"), passed("u", "forward"), none.alias("v"))
        distrust = edges.join(rank, edges["dst"] == rank["host"]).select(
            F.col("src").alias("host"), none.alias("t"), passed("d", "back"), none.alias("u"), passed("v", "back"))
        new = stage(start.unionByName(trust).unionByName(distrust).groupBy("host").agg(*[F.sum(c).alias(c) for c in names]), "ranks")
        still = new.agg(moved).first()[0] == rank.agg(moved).first()[0]
        rank = new
        if still:
            break  # mass only grows from round to round: nothing moved
    own = seeds.select(F.col("host").alias("h"), "t0", "d0")
    rest = 1 - F.col("t0") - F.col("d0")

    def share(c, every, seed):
        got = F.when(F.col(every) > 1, (F.col(c) - F.col(seed)) / (F.col(every) - 1)).otherwise(0.0)
        return F.col(seed) + rest * got
    return rank.join(own, rank["host"] == own["h"]).select("host", share("t", "u", "t0").alias("trust"), share("d", "v", "d0").alias("distrust"))


def judge_urls(pages: DataFrame, rules, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row for each page."""
    host, path = url_parts("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule("host", "path", rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    share = lambda v: F.avg(F.when(F.col("by_rule") == v, 1.0).otherwise(0.0))
    seeds = rows.filter("host <> ''").groupBy("host").agg(share("allow").alias("t0"), share("block").alias("d0"))
    rank = propagate(seeds, host_edges(pages))
    blocked = stage(rank.filter(F.col("trust") - F.col("distrust") < -(threshold + SLACK)).select(F.col("host").alias("h")), "blocked")
    out = rows.join(blocked, rows["host"] == blocked["h"], "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("by_rule", F.when(F.col("h").isNotNull(), "block").otherwise("allow")).alias("verdict"))


def judge_sql(rules, rounds: int = ROUNDS, damping: float = DAMPING, threshold: float = THRESHOLD) -> str:
    """The same over ``pages`` as DuckDB SQL, the rounds written out."""
    low = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    ranked = sorted(rules, key=lambda r: (-(len(r[0]) + len(r[1])), -len(r[0]), r))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in ranked]
    case = lambda i: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[i]}'" for f in fits) + " END"
    link = LINK.replace("'", "''")
    parts = [
        f"p AS (SELECT page_id, html, {low("regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1)")} AS host, "
        "regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages)",
        f"r AS (SELECT page_id, host, path, {case(1)} AS rule, {case(2)} AS v FROM p)",
        f"l AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1), "
        f"lambda x: {low("regexp_extract(x, '//([^/?#]*)', 1)")}))) AS dst FROM p)",
        "e AS (SELECT src, dst, count(*) AS n FROM l WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL)",
        "w AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS f, n / sum(n) OVER (PARTITION BY dst) AS b FROM e)",
        "s0 AS (SELECT host, avg(CASE WHEN v = 'allow' THEN 1.0 ELSE 0.0 END) AS t, avg(CASE WHEN v = 'block' THEN 1.0 ELSE 0.0 END) AS d "
        "FROM (SELECT host, v FROM r UNION ALL SELECT DISTINCT h, 'none' FROM (SELECT src AS h FROM e UNION SELECT dst FROM e) "
        "WHERE h NOT IN (SELECT host FROM r)) WHERE host <> '' GROUP BY host)",
        "q0 AS (SELECT host, t, d, 1.0::DOUBLE AS u, 1.0::DOUBLE AS v FROM s0)",
    ]
    for k in range(rounds):
        parts.append(
            f"q{k + 1} AS (SELECT host, sum(t) AS t, sum(d) AS d, sum(u) AS u, sum(v) AS v FROM (SELECT host, t, d, u, v FROM q0 UNION ALL "
            f"SELECT dst, {damping} * t * f, 0.0, {damping} * u * f, 0.0 FROM w JOIN q{k} ON src = host UNION ALL "
            f"SELECT src, 0.0, {damping} * d * b, 0.0, {damping} * v * b FROM w JOIN q{k} ON dst = host) GROUP BY host)")
    share = lambda c, every: f"(s0.{c} + (1 - s0.t - s0.d) * CASE WHEN q.{every} > 1 THEN (q.{c} - s0.{c}) / (q.{every} - 1) ELSE 0 END)"
    parts.append(f"j AS (SELECT s0.host, {share('t', 'u')} - {share('d', 'v')} AS balance FROM s0 JOIN q{rounds} q ON q.host = s0.host)")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT page_id, r.host, path, rule, coalesce(v, CASE WHEN balance < {-(threshold + SLACK)!r} "
        "THEN 'block' ELSE 'allow' END) AS verdict FROM r LEFT JOIN j ON r.host = j.host"
    )
