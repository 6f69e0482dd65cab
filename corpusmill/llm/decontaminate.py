"""Benchmark decontamination through a distributed positional inverted index.

Benchmark items become windows of consecutive words. Corpus counts over all
documents rank each window's terms; the training side is indexed as postings
(term, document, position) for the rarest terms of the windows. A window's
possible starts are the postings of its rarest term less the term's offset;
they are intersected with the offset-adjusted lists of the next rarest terms by
equi-joins on (term, document, position). What is left is checked exactly: the
documents that hold candidates are read once more and the whole phrase at the
candidate's start must have the window's 64-bit phrase hash.

``proximity_matches`` returns, from the same index, places where a window's two
rarest terms stand within ``slop`` words of their distance in the window.

Defined results: null or wordless texts have no words and are clean; null
item_ids take no part, an item_id in several rows has the windows of all of
them. A document is a (doc_id, text) pair: rows that repeat it all return its
result, and doc_id may be null. Extra columns are ignored, or kept where
documents are filtered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.llm.bytewords import ALNUM, WordHasher, shingle_hashes, slices
from corpusmill.llm.common import drop_by_id, maybe_member, member_bitmap, stage

WINDOW = 10
DEPTH = 3  # rarest terms of a window whose lists are intersected
_FLUSH = 1_000_000


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64), pa.int64())


def item_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, wid, terms): each item's windows; wid is the phrase hash."""

    def run(batches):
        hasher = WordHasher(ALNUM)
        for b in slices(batches):
            words, offs = hasher.words(b.column("text"))
            ids, wids, terms = [], [], []
            for i in range(b.num_rows):
                w = words[offs[i] : offs[i + 1]]
                h = shingle_hashes(w, width)
                size = min(width, w.size)
                ids += b.column("item_id").slice(i, 1).to_pylist() * h.size
                wids.append(h)
                terms += [w[j : j + size].view(np.int64) for j in range(h.size)]
            wids = np.concatenate(wids) if wids else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), _long(wids), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "wid", "terms"]
            )

    return (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
        .filter("item_id IS NOT NULL")
        .mapInArrow(run, "item_id string, wid long, terms array<long>")
        .distinct()
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """(t, n): occurrences of every word hash in all documents."""

    def run(batches):
        hasher, held, size = WordHasher(ALNUM), [], 0

        def flush():
            t, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([_long(t), pa.array(n.astype(np.int64))], ["t", "n"])

        for b in slices(batches):
            w, _ = hasher.words(b.column("text"))
            held.append(w)
            size += w.size
            if size > _FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(F.col("doc_id").cast("long"), text).alias("k"))


def positional_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(doc_id, k, t, pos): postings of the words in ``terms`` (t), or of all.
    Each document row also gives one row with null t whose pos is its number of
    words. A bitmap of fixed size spares other words' rows; an exact join on t
    removes what it let through by chance."""
    bitmap = None if terms is None else member_bitmap(terms, "t", hashed=True)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        hasher = WordHasher(ALNUM)
        for b in slices(batches):
            words, offs = hasher.words(b.column("text"))
            at = np.arange(words.size)
            if sent.value is not None:
                at = at[maybe_member(sent.value, words.view(np.int64))]
            row = np.searchsorted(offs, at, "right") - 1
            cols = []
            for c in ("doc_id", "k"):
                cols.append(pa.concat_arrays([b.column(c), b.column(c).take(pa.array(row))]))
            n = b.num_rows
            t = pa.concat_arrays([pa.nulls(n, pa.int64()), _long(words[at])])
            pos = np.concatenate([np.diff(offs), at - offs[row]])
            yield pa.RecordBatch.from_arrays([*cols, t, pa.array(pos, pa.int64())], ["doc_id", "k", "t", "pos"])

    return _keyed(docs).mapInArrow(run, "doc_id long, k long, t long, pos long")


def rarest_terms(windows: DataFrame, counts: DataFrame, depth: int = DEPTH, whole: bool = True) -> DataFrame:
    """(wid, len, anchors): each window's ``depth`` rarest terms as (n, o, t)
    structs, rarest first. ``whole``: windows with a term that no document has are
    gone, as they occur nowhere; otherwise their other terms are ranked."""
    terms = windows.select("wid", F.size("terms").alias("len"), F.posexplode("terms").alias("o", "t")).distinct()
    ranked = terms.join(counts, "t").groupBy("wid", "len").agg(F.sort_array(F.collect_list(F.struct("n", "o", "t"))).alias("a"))
    ranked = ranked.filter(F.size("a") == F.col("len")) if whole else ranked
    return ranked.select("wid", "len", F.slice("a", 1, depth).alias("anchors"))


def _phrases(docs: DataFrame, hits: DataFrame, windows: DataFrame, width: int) -> DataFrame:
    """(wid, k, start) of phrases of documents that hold candidates and whose
    phrase hash may be a window's."""
    lens = [r[0] for r in windows.select(F.size("terms").alias("n")).distinct().collect()]  # at most ``width``
    sc = docs.sparkSession.sparkContext
    wanted = sc.broadcast((member_bitmap(hits, "k", hashed=True), member_bitmap(windows, "wid", hashed=True), sorted(lens)))

    def run(batches):
        hasher = WordHasher(ALNUM)
        for b in slices(batches):
            in_docs, in_wids, sizes = wanted.value
            b = b.filter(pa.array(maybe_member(in_docs, b.column("k").to_numpy())))
            words, offs = hasher.words(b.column("text"))
            for i in range(b.num_rows):
                w = words[offs[i] : offs[i + 1]]
                for size in sizes:
                    if size and w.size >= size:
                        h = shingle_hashes(w, size)
                        at = np.flatnonzero(maybe_member(in_wids, h.view(np.int64)))
                        if at.size:
                            k = pa.array([b.column("k")[i].as_py()] * at.size, pa.int64())
                            yield pa.RecordBatch.from_arrays([_long(h[at]), k, pa.array(at, pa.int64())], ["wid", "k", "start"])

    return _keyed(docs).select("k", "text").mapInArrow(run, "wid long, k long, start long")


def _candidates(index: DataFrame, ranked: DataFrame, depth: int) -> DataFrame:
    """(wid, len, k, start) after intersecting the lists of the rarest terms."""
    lists = index.filter("t IS NOT NULL").select("t", "k", "pos")
    first = ranked.select("wid", "len", "anchors", F.col("anchors")[0]["o"].alias("o"), F.col("anchors")[0]["t"].alias("t"))
    found = first.join(lists, "t").select("wid", "len", "anchors", "k", (F.col("pos") - F.col("o")).alias("start"))
    found = stage(found.filter("start >= 0"), "starts")
    for d in range(1, depth):
        a = F.try_element_at("anchors", F.lit(d + 1))
        found = found.withColumn("t", a["t"]).withColumn("pos", F.col("start") + a["o"])
        done, more = found.filter(F.size("anchors") <= d), found.filter(F.size("anchors") > d)
        found = more.join(lists, ["t", "k", "pos"], "left_semi").unionByName(done).drop("t", "pos")
    return found.select("wid", "len", "k", "start").distinct()


def find_passages(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, depth: int = DEPTH):
    """(rows, hits): rows (doc_id, k, n_words), one for each document row; hits
    (wid, k, start, len), every place of a window in a document; and the items'
    windows (item_id, wid)."""
    windows = stage(item_windows(benchmark, width), "windows")
    counts = stage(term_counts(docs).join(windows.select(F.explode("terms").alias("t")).distinct(), "t", "left_semi"), "counts")
    ranked = stage(rarest_terms(windows.select("wid", "terms").distinct(), counts, depth), "ranked")
    terms = stage(ranked.select(F.explode("anchors.t").alias("t")).distinct(), "terms")
    raw = positional_index(docs, terms)
    index = stage(raw, "index")
    rows = index.filter("t IS NULL").select("doc_id", "k", F.col("pos").alias("n_words"))
    found = stage(_candidates(index.join(terms, "t", "left_semi"), ranked, depth), "candidates")
    exact = _phrases(docs, found, windows, width)
    hits = stage(found.join(exact, ["wid", "k", "start"], "left_semi"), "hits")
    return rows, hits, windows.select("item_id", "wid")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, depth: int = DEPTH) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for
    each document row."""
    rows, hits, items = find_passages(docs, benchmark, width, depth)
    # words inside occurrences: each adds what reaches beyond all that start before it
    order = W.partitionBy("k").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    spans = hits.groupBy("k", "start").agg((F.col("start") + F.max("len")).alias("end"))
    spans = spans.withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(order), F.lit(0))))
    hit = spans.groupBy("k").agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit"))
    named = hits.select("k", "wid").distinct().join(items, "wid").groupBy("k").agg(
        F.sort_array(F.collect_set("item_id")).alias("ids"))  # at most the benchmark's items
    found = stage(hit.join(named, "k"), "found")
    ids = F.concat_ws(",", F.coalesce("ids", F.array().cast("array<string>")))
    return rows.join(found, "k", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int, width: int = WINDOW) -> DataFrame:
    """(item_id, wid, doc_id, pos1, pos2): the window's two rarest terms that the
    corpus has, within ``slop`` words of their distance in the window, in either
    direction. A window with fewer than two such terms matches nowhere."""
    windows = stage(item_windows(benchmark, width), "windows")
    counts = term_counts(docs).join(windows.select(F.explode("terms").alias("t")).distinct(), "t", "left_semi")
    pair = stage(rarest_terms(windows.select("wid", "terms").distinct(), counts, 2, whole=False).filter("size(anchors) = 2"), "pairs")
    terms = stage(pair.select(F.explode("anchors.t").alias("t")).distinct(), "terms")
    lists = stage(positional_index(docs, terms).join(terms, "t", "left_semi"), "lists")
    cell = slop + 1  # a match is in the same cell of width slop + 1 or a neighbour
    first = pair.selectExpr("wid", "anchors[0].t AS t", "anchors[1].t AS t2", "anchors[1].o - anchors[0].o AS gap").join(lists, "t")
    first = first.select("wid", "doc_id", "k", "t2", F.col("pos").alias("pos1"), (F.col("pos") + F.col("gap")).alias("due"))
    first = first.withColumn("c", F.explode(F.array(*[F.floor(F.col("due") / cell) + d for d in (-1, 0, 1)])))
    second = lists.select(F.col("t").alias("t2"), "k", F.col("pos").alias("pos2"), F.floor(F.col("pos") / cell).alias("c"))
    near = first.join(second, ["t2", "k", "c"]).filter((F.abs(F.col("pos2") - F.col("due")) <= slop) & (F.col("pos1") != F.col("pos2")))
    return near.join(windows.select("item_id", "wid"), "wid").select("item_id", "wid", "doc_id", "pos1", "pos2").distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, all columns as they came."""
    rows, hits, _ = find_passages(docs, benchmark)
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return drop_by_id(docs, key, stage(hits.select("k").distinct(), "contaminated"), "k")
