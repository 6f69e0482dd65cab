"""Main texts: exact on the given pages, frames of sites, odd markup."""

import collections
import html as H
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import site_style as SS


def texts(spark, rows, **kw):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in SS.main_texts(df, **kw).collect()}


def one(spark, page, url="http://one.example/x"):
    return texts(spark, [(1, url, page)])[1]


def test_given_pages_exactly(spark):
    """Their articles hold h1 and p blocks only; everything else is frame."""
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in SS.main_texts(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(H.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        want = "\n".join(x for x in blocks if x)
        assert got[r["page_id"]] == (r["url"], want, len(want))


SITE = """<html><body><div class="x1"><span><a href="/a">Start</a></span><span><a href="/b">Orders</a></span></div>
<div class="q7">We store data on this device to serve you better.</div>
<div class="c"><h2>{title}</h2><p>{one}</p><p>{two}</p></div><div class="z">All rights with the house of Example.</div></body></html>"""


def _words(n, k=12):
    return " ".join(f"w{n}x{i}" for i in range(k))


def test_frames_without_telling_names_go_by_importance(spark):
    rows = [(i, f"http://S.Example/{i}", SITE.format(title=_words(i, 3), one=_words(i + 1000), two=_words(i + 2000))) for i in range(40)]
    want = {i: "\n".join([_words(i, 3), _words(i + 1000), _words(i + 2000)]) for i in range(40)}
    assert texts(spark, rows) == want
    assert texts(spark, rows, broadcast_nodes=0) == want  # the way of large tables


def test_copies_of_an_article_stay_whole(spark):
    page = SITE.format(title="T", one=_words(1), two=_words(2))
    rows = [(i, "http://s.example/", page) for i in range(30)] + [(99, "http://s.example/9", SITE.format(title="U", one=_words(3), two=_words(4)))]
    got = texts(spark, rows)
    assert all(_words(1) in got[i] and _words(2) in got[i] for i in range(30)) and got[99] == f"U\n{_words(3)}\n{_words(4)}"


def test_passages_repeated_in_marked_articles_stay(spark):
    shared = _words(7, 60)
    rows = [(i, f"http://s.example/{i}", f"<nav>menu</nav><article><p>{_words(i + 10)}</p><p>{shared if i % 3 == 0 else _words(i + 500)}</p></article>") for i in range(60)]
    got = texts(spark, rows)
    assert all((shared in got[i]) == (i % 3 == 0) for i in range(60)) and all("menu" not in t for t in got.values())


PARTS = {
    "header": "<header>Site</header>", "nav": "<nav>N</nav>", "menu": "<ul class='main-menu'><li>M</li></ul>", "aside": "<aside>A</aside>",
    "side": "<div id='sidebar'>S</div>", "cookie": "<div class='cookie-notice'>C</div>", "ad": "<div class='ad'>AD</div>",
    "form": "<form><label>Mail</label><input><button>Go</button></form>", "script": "<script>var a='<p>x</p>';</script>",
    "style": "<style>p{}</style>", "footer": "<footer>F</footer>", "role": "<div role='navigation'>R</div>", "hidden": "<p hidden>H</p>",
    "none": "<div style='display: none'>D</div>", "comments": "<section id='comments'><article class='comment'><p>me too</p></article></section>",
    "noscript": "<noscript>JS</noscript>", "template": "<template>T</template>", "comment": "<!-- <p>c</p> -->", "svg": "<svg><text>v</text></svg>",
}


@pytest.mark.parametrize("part", sorted(PARTS))
@pytest.mark.parametrize("frame", ["{x}<article>{a}</article>", "<article>{a}</article>{x}", "<main>{x}{a}</main>", "{x}<div class='post has-sidebar'>{a}</div>"])
def test_named_noise(part, frame):
    body = f"<h1>Title</h1><p>{_words(1)}</p>"
    assert SS.Page("<body>" + frame.format(x=PARTS[part], a=body) + "</body>").text() == f"Title\n{_words(1)}"


@pytest.mark.parametrize("page, want", [
    ("<article><p>a&nbsp;b\n\t c&amp;amp; &#233;<br>d</p>  e <ul><li>f<li>g</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a b c&amp; é d\ne\nf\ng\n1 2\n3"),
    ("<article><p>one<p>two<div>three</article>", "one\ntwo\nthree"), ("<article><b>x<p>y</b>z</p></article>", "x\nyz"),
    ("<p>5 < 6 & 7 > 2</p>", "5 < 6 & 7 > 2"), ("plain", "plain"), ("</p></div>x</article>", "x"), ("<article></article><p>out</p>", "out"),
    ("<article><pre>a\n  b</pre><blockquote>c</blockquote></article>", "a b\nc"), ("<article>a<article>b</article>c</article>", "a\nb\nc"),
    ("<article><p>w<i>or</i>d</p></article>", "word"), ("<nav>only a menu</nav>", ""), ("<article>\x00�</article>", "\x00�"),
])
def test_odd_markup(spark, page, want):
    assert one(spark, page) == want


def test_odd_rows(spark):
    rows = [(1, None, "<article>a</article>"), (None, "no host", "<article>b</article>"), (2, "http://h/", None), (3, "http://h/", ""), (1, None, "<article>a</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(3))
    got = sorted((str(r["page_id"]), str(r["url"]), r["text"], r["n_chars"]) for r in SS.main_texts(df).collect())
    assert got == [("1", "None", "a", 1), ("1", "None", "a", 1), ("2", "http://h/", "", 0), ("3", "http://h/", "", 0), ("None", "no host", "b", 1)]
    assert SS.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_deep_and_long_pages():
    deep = "<article>" + "<div>" * 30_000 + "core" + "</div>" * 30_000 + "</article>"
    assert SS.Page(deep).text() == "core"
    long = "<article>" + "".join(f"<p><b>{i}" for i in range(50_000)) + "</article>"
    assert SS.Page(long).text().count("\n") == 49_999


def test_the_own_text_of_a_varied_element_stays(spark):
    """The boxes' heading and lines repeat, but hardly two boxes look the same."""
    r = random.Random(8)
    rows, want = [], {}
    for i in range(40):
        box = "".join(f"<p class='k{j}'>Fact {j} of six</p>" for j in r.sample(range(6), 4))
        page = f"<div class='q7'>We store data on this device.</div><div class='c'><p>{_words(i, 40)}</p></div><div class='z'>At a glance{box}</div>"
        rows.append((i, f"http://s.example/{i}", page))
        want[i] = f"{_words(i, 40)}\nAt a glance"
    for nodes in (SS.BROADCAST_NODES, 0):
        assert texts(spark, rows, broadcast_nodes=nodes) == want


def _plainly(rows):
    """The defined result, with every node's importance kept and none sorted out."""
    pages = {i: (url.split("/")[2], SS.Page(html)) for i, url, html in rows}
    size, shown, held = collections.Counter(h for h, _ in pages.values()), collections.defaultdict(collections.Counter), collections.Counter()
    for h, p in pages.values():
        at = list(p.styled())
        for key, sequence in {(key, sequence) for _, key, sequence, _, kids in at if kids}:
            shown[h, key][sequence] += 1
        held.update({(h, own) for *_, own, _ in at if own})
    out = {}
    for i, (h, p) in pages.items():
        base, limit = math.log(size[h] + SS.PRIOR_PAGES), SS.THRESHOLD_INSIDE if p.marked else SS.THRESHOLD
        below = {}  # a node's importance, and whether all in it is low
        at = list(p.styled())
        for node, key, _, own, kids in reversed(at):
            parts = [below[k][0] for k in kids] + ([1 - math.log(held[h, own]) / base] if own else [])
            all_low = all(below[k][1] for k in kids) and (not own or parts[-1] < limit)
            value = sum(parts) / len(parts) if parts else float(node.chars > 0)
            if kids:
                k = list(shown[h, key].values())
                spread = -sum(x / sum(k) * math.log(x / sum(k)) for x in k) / base
                value = (1 - SS.DECAY ** len(k)) * spread + SS.DECAY ** len(k) * value
            below[node] = value, all_low and value < limit
        total, gone, picked = sum(t.chars for t in p.tops), 0, []
        for node, *_ in at:
            if node.parent is not None and node.parent.noise:
                node.noise = True
            elif below[node][1] and 0 < 2 * node.chars <= total:
                node.noise, gone = True, gone + node.chars
                picked.append(node)
        for node in picked if 2 * gone > total else ():
            node.noise = False
        out[i] = p.text()
    return out


@pytest.mark.parametrize("seed", range(4))
def test_every_node_of_the_style_tree_counts(spark, seed):
    r = random.Random(seed)

    def box(host, deep):
        kinds = [f"<p class='k{k}'>{host} line {r.randrange(2)} {k}</p>" for k in range(r.choice((2, 3, 6)))] + ["<hr>"]
        inner = "".join(r.choice(kinds) for _ in range(r.randrange(1, 4)))
        own = r.choice(("", f"{host} box {r.randrange(2)}"))
        return f"<div class='b{r.randrange(2)}'>{own}{inner}{box(host, deep - 1) if deep and r.random() < 0.6 else ''}</div>"

    rows = []
    for host, n in (("one", 3), ("few", 7), ("some", 20), ("many", 60)):
        for _ in range(n):
            text = f"<p>{_words(r.randrange(10**6), 30)}</p>" if r.random() < 0.9 else f"<p>{host} {'same ' * 60}</p>"
            body = "".join(box(host, 2) for _ in range(r.randrange(4))) + f"<div>{text}</div>" + box(host, 1)
            rows.append((len(rows), f"http://{host}/{len(rows)}", f"<article>{body}</article>" if r.random() < 0.2 else body))
    want = _plainly(rows)
    assert texts(spark, rows) == want == texts(spark, rows, broadcast_nodes=0)
    assert any(SS.Page(h).text() != want[i] for i, _, h in rows)
