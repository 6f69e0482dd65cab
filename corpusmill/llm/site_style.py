"""Main text of web pages, by site style trees.

All pages of a host are merged into one style tree. An element node of the tree
is a path of (tag, class) from the root, told apart by the child sequences passed
on the way, as in the pages' own DOMs. Two entropies say how much a node matters,
with M the pages of the host:

* presentation: how evenly the pages that hold an element spread over its child
  sequences (logarithm to the base M + ``PRIOR_PAGES``); a frame that always looks
  the same has 0;
* content: 1 minus the same-based logarithm of the number of the host's pages that
  hold this very text (or link target) under the same tag and class. A text of its
  own has 1, one that every page repeats has about 0.

``1 - DECAY^l`` of a node's importance is its own presentation (l child sequences),
the rest is the mean of its children's, bottom-up in each page; a text's importance
is its content's. A branch goes if it and everything in it lie below the threshold.
Merging is a grouped count over (host, node, child sequence) and (host, text), so a
host of any size is never gathered. What reaches the pages is every text below the
threshold and every element with two child sequences or more: other texts keep
their branches whatever the exact value, other elements always look the same. These
nodes are broadcast below a checked size; beyond it each page is joined with its own.

A style tree says nothing about hosts with one or two pages and little about
adverts that change with each page, so markup that names its role goes first:
script, style, nav, footer, aside, form and the like; ARIA landmark roles; hidden
elements; class and id words such as ``ad``, ``menu``, ``cookie``, ``comments``.
No such word takes away a branch that holds most of the page's text. If a page
marks its article (``article``, ``main``, ``itemprop=articleBody``), only that is
read, and text inside it goes only below a much lower threshold, because passages
and whole articles may repeat on a site. A branch with more than half of a page's
remaining text is never removed by its importance: copies of a page stay whole.

Blocks are block-level elements; ``br`` and table cells count as white space.
White space is what ``str.split`` takes for it (no-break spaces included).

Defined results: null or empty html gives '' and 0; so does a page without article
text. A null url, or one without a host, is a page of the nameless host. Repeated
rows give repeated rows. Pages of any length are parsed whole, in one task each.
Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from hashlib import blake2b
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import discard, stage

PRIOR_PAGES = 8
DECAY = 0.9
#: Importance below which a branch goes, outside and inside a marked article.
THRESHOLD, THRESHOLD_INSIDE = 0.3, 0.1
#: Without a marked article, a branch of so many links that hold this share of its text is a menu.
MENU_LINKS, MENU_SHARE = 3, 0.8
#: Nodes sent to every worker at most; more are joined by page.
BROADCAST_NODES = 1 << 20

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody tfoot thead title tr ul".split()
)
NOISE_TAGS = frozenset(
    "script style noscript template head title nav aside footer form button select option optgroup textarea input "
    "iframe object embed svg canvas math audio video map dialog menu search".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status".split()
)
ARTICLE_ROLES = frozenset(("main", "article"))
#: Tags whose start ends an open element of these tags (nearest block only).
CLOSES = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option",)),
    "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
    "tbody": frozenset(("tbody", "thead", "tfoot", "tr", "td", "th")),
}
SCOPES = frozenset(("table", "ul", "ol", "dl", "select", "td", "th", "article", "body", "main", "section", "div"))

# Words of class and id attributes that name a part outside the article.
NOISE_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising adunit sponsor sponsored promo promotion "
    "menu nav navbar navigation topnav breadcrumb breadcrumbs sidebar sidebars aside footer bottombar topbar toolbar "
    "masthead cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay paywall "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations trending "
    "teaser comment comments commentlist disqus respond replies reply pagination pager skip copyright legal disclaimer "
    "widget widgets banner search searchform".split()
)
#: Words that name a page's header, unless inside the article.
HEADER_WORDS = frozenset(("header", "siteheader", "pageheader", "head"))

_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "chars", "link_chars", "links", "noise", "inside")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.chars = self.link_chars = self.links = 0
        self.noise = self.inside = False


class _Builder(HTMLParser):
    """A tolerant tree: unknown end tags are ignored, elements left open end with
    their parents, and the optional end tags of HTML may be missing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)
        self.open: dict[str, int] = {}

    def _pop(self):
        self.open[self.at.tag] -= 1
        self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS and self.open.get("p"):
            self._end("p", frozenset(("table", "td", "th", "button", "object")))
        if tag in CLOSES:
            node, stop = self.at, SCOPES - CLOSES[tag]
            while node is not self.root and node.tag not in stop:
                if node.tag in CLOSES[tag]:
                    while self.at is not node.parent:
                        self._pop()
                node = node.parent
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.open[tag] = self.open.get(tag, 0) + 1
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML knows no self-closing elements

    def _end(self, tag, stop=frozenset()):
        if not self.open.get(tag):
            return
        node = self.at
        while node is not self.root and node.tag != tag:
            if node.tag in stop:
                return
            node = node.parent
        if node is self.root:
            return
        while self.at is not node.parent:
            self._pop()

    def handle_endtag(self, tag):
        # an inline end tag does not end the block around it
        self._end(tag, frozenset() if tag in BLOCKS or tag in ("td", "th") else BLOCKS)

    def handle_data(self, data):
        if data:
            self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _words_of(node: Node) -> set[str]:
    named = f"{node.attrs.get('class') or ''} {node.attrs.get('id') or ''}"
    return {w.lower() for w in _NAME.findall(named)} if named != " " else set()


def _walk(root: Node):
    """Elements in page order, parents first (no recursion: pages may nest deeply)."""
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))


def _marks_article(node: Node) -> int:
    """2 for an article, 1 for a main part, 0 for others."""
    if node.tag == "article" or node.attrs.get("itemprop") == "articleBody" or node.attrs.get("role") == "article":
        return 2
    return int(node.tag == "main" or node.attrs.get("role") == "main")


def _plain_noise(node: Node) -> bool:
    a = node.attrs
    return (
        node.tag in NOISE_TAGS
        or (a.get("role") or "").lower() in NOISE_ROLES
        or "hidden" in a
        or a.get("aria-hidden") == "true"
        or bool(_HIDDEN.search(a.get("style") or ""))
    )


class Page:
    """A page without its plainly named noise: the branches that may hold text,
    their keys in the host's style tree, and the text blocks."""

    def __init__(self, html: str):
        root = parse(html)
        nodes = list(_walk(root))
        for n in nodes:
            n.noise = n.parent is not None and (n.parent.noise or _plain_noise(n))
        self._measure(nodes)
        total = max(root.chars, 1)
        marked = [n for n in nodes if not n.noise and _marks_article(n)]
        holders = set()
        for n in marked:
            while n is not None and n not in holders:
                holders.add(n)
                n = n.parent
        for n in nodes:  # parents first
            if n.parent is None or n.noise:
                continue
            n.inside = n.parent.inside or _marks_article(n.parent) == 2
            if n.parent.noise:
                n.noise = True
                continue
            words = _words_of(n)
            # the part that holds the article, or most of the text, is not noise by its name
            if 2 * n.chars > total or (n in holders and not _marks_article(n)):
                continue
            n.noise = bool(words & NOISE_WORDS) or (not n.inside and (n.tag == "header" or bool(words & HEADER_WORDS)))
            # a list of links is a menu
            n.noise |= not marked and n.links >= MENU_LINKS and n.link_chars >= MENU_SHARE * n.chars
        best = max((_marks_article(n) for n in marked if not n.noise), default=0)
        self.tops, inner = [], set()
        for n in nodes:  # the outermost of the best marks
            if n.parent in inner:
                inner.add(n)
            elif best and not n.noise and n.chars and _marks_article(n) == best:
                self.tops.append(n)
                inner.add(n)
        self.marked = bool(self.tops)
        if not self.tops:
            self.tops = [root]
        self._measure(nodes)

    @staticmethod
    def _measure(nodes) -> None:
        for n in nodes:
            n.chars = n.link_chars = n.links = 0
        for n in reversed(nodes):
            if n.noise:
                n.chars = n.link_chars = n.links = 0
                continue
            n.chars += sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
            if n.tag == "a":
                n.link_chars, n.links = n.chars, 1
            if n.parent is not None:
                n.parent.chars += n.chars
                n.parent.link_chars += n.link_chars
                n.parent.links += n.links

    def styled(self):
        """(node, key, child sequence, presentation or text) of every kept element:
        ``key`` names the element in the style tree, ``text`` is (key, digest) of an
        element's own text."""
        for top in self.tops:
            todo = [(top, _digest(top.tag, top.attrs.get("class") or ""))]
            while todo:
                node, key = todo.pop()
                kids = [c for c in node.children if isinstance(c, Node) and not c.noise]
                sequence = _digest(*(f"{c.tag}.{c.attrs.get('class') or ''}" for c in kids)) if kids else b""
                own = " ".join(" ".join(c for c in node.children if isinstance(c, str)).split())
                if own:
                    # a text is the same wherever it stands: only tag, class and link target count
                    own = _digest("#text", node.tag, node.attrs.get("class") or "", node.attrs.get("href") or "", own)
                yield node, key, sequence, own or b"", kids
                todo.extend(
                    (c, _digest(key, sequence, str(i), c.tag, c.attrs.get("class") or "")) for i, c in enumerate(kids)
                )

    def drop_unimportant(self, known) -> None:
        """Marks branches below the threshold as noise; ``known(digest)`` is a text's
        (importance, 0), an element's (presentation, child sequences), or None for a
        text that is not low and for an element with one child sequence."""
        threshold = THRESHOLD_INSIDE if self.marked else THRESHOLD
        rows = list(self.styled())
        value, worst = {}, {}
        for node, key, sequence, own, kids in reversed(rows):  # children first
            parts = [value[c] for c in kids]
            if own:
                found = known(own)
                parts.append(1.0 if found is None else found[0])
            if not parts:
                value[node] = worst[node] = 0.0 if not node.chars else 1.0
                continue
            mean = sum(parts) / len(parts)
            value[node] = mean
            if kids:
                shown, shapes = known(key) or (0.0, 1)
                share = DECAY**shapes
                value[node] = (1 - share) * shown + share * mean
            worst[node] = max([worst[c] for c in kids] + ([parts[-1]] if own else []) + [value[node] if kids else 0.0])
        total = sum(t.chars for t in self.tops)
        gone = 0
        picked = []
        for node, *_ in rows:
            if node.noise or (node.parent is not None and node.parent.noise):
                node.noise = True
            elif worst[node] < threshold and 2 * node.chars <= total and node.chars:
                node.noise = True
                gone += node.chars
                picked.append(node)
        if 2 * gone > total:  # most of the page repeats elsewhere: a copy, not a frame
            for node in picked:
                node.noise = False

    def text(self) -> str:
        blocks: list[str] = []
        line: list[str] = []

        def close():
            joined = " ".join("".join(line).split())
            line.clear()
            if joined:
                blocks.append(joined)

        for top in self.tops:
            todo: list = [top]
            while todo:
                x = todo.pop()
                if x is None:
                    close()
                elif isinstance(x, str):
                    line.append(x)
                elif not x.noise:
                    if x.tag in BLOCKS or x.tag == "#root":
                        close()
                        todo.append(None)
                    elif x.tag in ("br", "td", "th"):
                        line.append(" ")
                    todo.extend(reversed(x.children))
            close()
        return "\n".join(blocks)


def _digest(*parts) -> bytes:
    h = blake2b(digest_size=8)
    for p in parts:
        h.update(p if isinstance(p, bytes) else p.encode("utf-8", "surrogatepass"))
        h.update(b"\x00")
    return h.digest()


def _site_key(host: str, digest: bytes) -> int:
    return int.from_bytes(_digest(host, digest), "little", signed=True)


def page_host(url):
    """Host of a url: after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; '' without one."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _style_rows(batches):
    """(host, node, shape): shape is the child sequence of an element, null for a text."""
    schema = pa.schema([("host", pa.string()), ("node", pa.int64()), ("shape", pa.int64())])
    for b in batches:
        hosts, nodes, shapes = [], [], []
        for host, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            seen = set()
            for _, key, sequence, own, kids in Page(html).styled() if html else ():
                if kids:
                    seen.add((_site_key(host, key), int.from_bytes(sequence, "little", signed=True)))
                if own:
                    seen.add((_site_key(host, own), None))
            hosts.extend([host] * len(seen))
            nodes.extend(n for n, _ in seen)
            shapes.extend(s for _, s in seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(nodes, pa.int64()), pa.array(shapes, pa.int64())], schema=schema
        )


def low_nodes(pages: DataFrame) -> DataFrame:
    """(host, node, importance, shapes) of the style tree's nodes that decide about
    branches: texts below ``THRESHOLD`` with 0 shapes, and elements with their
    presentation entropy and number of child sequences, two or more. Hosts without
    such a text are left out.

    Nothing that could change a page is missing. A branch stays if any text in it is
    not low, so neither such a text's value nor, on a host of such texts alone, an
    element's matters. An element with one child sequence has entropy 0 everywhere."""
    rows = pages.select("host", "html").mapInArrow(_style_rows, "host string, node long, shape long")
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).withColumnRenamed("host", "site")
    # one count for each text and each child sequence, then one row for each node
    counts = rows.groupBy("host", "node", "shape").agg(F.count(F.lit(1)).alias("k"))
    k = F.col("k").cast("double")
    nodes = counts.groupBy("host", "node").agg(
        F.sum("k").alias("n"), F.sum(k * F.log(k)).alias("klogk"), F.count("shape").alias("shapes")
    )
    # a text on n pages is below the threshold on a host of n pages if on any
    lowest = 1 - F.log("n") / F.log(F.col("n") + F.lit(float(PRIOR_PAGES)))
    nodes = nodes.filter((F.col("shapes") > 1) | ((F.col("shapes") == 0) & (lowest < THRESHOLD)))
    met = nodes.join(sizes, F.col("host") == F.col("site"))
    base = F.log(F.col("pages") + F.lit(float(PRIOR_PAGES)))
    spread = F.greatest(F.lit(0.0), F.log("n") - F.col("klogk") / F.col("n")) / base
    content = 1 - F.log("n") / base
    value = F.when(F.col("shapes") == 0, content).otherwise(spread)
    met = met.select("host", "node", value.alias("importance"), F.col("shapes").cast("int").alias("shapes"))
    met = stage(met.filter((F.col("shapes") > 0) | (F.col("importance") < THRESHOLD)), "nodes")
    framed = met.filter("shapes = 0").select("host").distinct()
    low = stage(met.join(framed, "host", "left_semi"), "style")
    discard(met)
    return low


_RESULT = "page_id long, url string, text string, n_chars long"
_RESULT_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(lookup):
    """``lookup(batch)`` gives for each row a function from a site key to a node's
    (importance, shapes) or None."""

    def run(batches):
        for b in batches:
            known = lookup(b)
            texts = []
            for i, (host, html) in enumerate(zip(b.column("host").to_pylist(), b.column("html").to_pylist())):
                if not html:
                    texts.append("")
                    continue
                page = Page(html)
                at = known(i)
                if at is not None:
                    page.drop_unimportant(lambda d, at=at, host=host: at(_site_key(host, d)))
                texts.append(page.text())
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                schema=_RESULT_ARROW,
            )

    return run


def _page_nodes(batches):
    """(page, node): the nodes that a page holds."""
    schema = pa.schema([("page", pa.string()), ("node", pa.int64())])
    for b in batches:
        pages, nodes = [], []
        for page, host, html in zip(*(b.column(c).to_pylist() for c in ("page", "host", "html"))):
            held = set()
            for _, key, _, own, kids in Page(html).styled() if html else ():
                held.update(_site_key(host, d) for d, there in ((key, kids), (own, own)) if there)
            pages.extend([page] * len(held))
            nodes.extend(held)
        yield pa.RecordBatch.from_arrays([pa.array(pages, pa.string()), pa.array(nodes, pa.int64())], schema=schema)


def main_texts(pages: DataFrame, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        page_host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"),
    )
    low = low_nodes(pages)
    if low.count() <= broadcast_nodes:
        rows = low.select("node", "importance", "shapes").toArrow()
        order = np.argsort(rows.column("node").to_numpy())
        sent = spark.sparkContext.broadcast(tuple(rows.column(c).to_numpy()[order] for c in ("node", "importance", "shapes")))

        def shared(batch):
            nodes, values, shapes = sent.value

            def low_at(key):
                i = int(np.searchsorted(nodes, key))
                return (float(values[i]), int(shapes[i])) if i < nodes.size and nodes[i] == key else None

            return lambda i: low_at if nodes.size else None

        return pages.mapInArrow(_extract(shared), _RESULT)

    # too many for every worker: a page travels with the nodes it holds
    named = pages.withColumn("page", F.sha2(F.concat(F.length("host").cast("string"), F.lit(" "), F.col("host"), F.coalesce("html", F.lit(""))), 256))
    held = named.select("page", "host", "html").mapInArrow(_page_nodes, "page string, node long").distinct()
    lists = held.join(low.drop("host"), "node").groupBy(F.col("page").alias("of")).agg(
        F.map_from_entries(F.collect_list(F.struct("node", F.struct("importance", "shapes")))).alias("low")
    )
    met = named.join(lists, F.col("page") == F.col("of"), "left").select("page_id", "url", "host", "html", "low")

    def joined(batch):
        maps = batch.column("low")
        return lambda i: {k: (v["importance"], v["shapes"]) for k, v in maps[i].as_py()}.get if maps[i].is_valid else None

    return met.mapInArrow(_extract(joined), _RESULT)
