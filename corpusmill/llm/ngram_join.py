"""N-gram Jaccard join by grouped prefixes.

Two documents link when the Jaccard similarity of their sets of distinct word
shingles reaches ``percent``. Every document's shingles are put in one global
order, the corpus's frequent shingles last. A linked pair must share a shingle
among the first ``n - ceil(t n) + 1`` of each (the prefix). Steps:

1. Documents with equal shingle sets collapse to a class (smallest doc_id).
2. Classes with equal prefix and equal size collapse to a group; one posting
   per group and prefix shingle finds candidate group pairs.
3. Group pairs are filtered by size, expanded to class pairs, filtered by an
   upper bound of the overlap, and verified on whole sets. The bound comes from
   bitmaps of ``BITS`` parities of the set's hashes: the number of bits in which
   two differ is never more than the number of shingles in which the sets do.
   For sets larger than that, the overlap of the prefixes gives a second bound.
   Where the shared shingle is the first that both have, what follows it in either
   set bounds the overlap too (places in the prefix); a linked pair meets that bound
   in the list of its first common shingle.
4. Links form components.

Candidates come in two passes, so that a large group of near copies does not
make all its pairs. The first links every group of a posting list with two
representatives of the list. The second takes *every* remaining pair of a list
whose members are in different components after the first. A pair that neither
pass verifies has its ends in one component already, so components are exact.

Defined results: null text, empty text or text without words has no shingles
and links with nothing (its component is its own doc_id); fewer words than the
width make one shingle of the whole sequence. Rows that repeat a doc_id are one
document, which links when any of its rows links, and each row returns its own
n_shingles. Rows with null doc_id keep a null component and link with nothing.
Extra columns are ignored. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.bytewords import SPACED, WordHasher, shingle_hashes, slices
from corpusmill.llm.common import discard, maybe_member, member_bitmap, split_by_membership, stage
from corpusmill.llm.components import components

#: Frequent shingles moved to the end of the order: those seen this often, and
#: at most so many. Both bound a broadcast and change speed only, never links.
FREQUENT = 20
ORDER_LIMIT = 1_000_000
BITS = 512
_FLUSH = 1_000_000
SHARED_BITS = 27


def _sets(batch, hasher, width):
    for part in slices([batch]):
        words, offs = hasher.words(part.column("text"))
        every = shingle_hashes(words, width)  # also across texts; those are left out below
        for start, end in zip(offs[:-1], offs[1:], strict=True):
            whole = end - start >= width
            yield np.unique(every[start : end - width + 1] if whole else shingle_hashes(words[start:end], width))


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles of many documents, sorted. Every task counts all its documents
    and passes on what it saw more than once; the sums are ranked in Spark."""

    def count(batches):
        hasher, held, size = WordHasher(SPACED), [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n > 1
            return pa.RecordBatch.from_pydict({"s": keys[keep].view(np.int64), "n": n[keep].astype(np.int64)})

        for b in batches:
            for s in _sets(b, hasher, width):
                held.append(s)
                size += s.size
                if size > _FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    top = (
        docs.select("text")
        .mapInArrow(count, "s long, n long")
        .groupBy("s")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "s")
        .limit(ORDER_LIMIT)
    )
    return np.sort(np.array([r[0] for r in top.select("s").collect()], dtype=np.int64).view(np.uint64))


def _parities(s: np.ndarray) -> np.ndarray:
    """BITS parity bits of a set of hashes, as int64 words."""
    bits = np.bincount((s >> np.uint64(7)).astype(np.int64) & (BITS - 1), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _only(b: pa.RecordBatch, wanted: np.ndarray | None) -> pa.RecordBatch:
    """The rows whose hash ``h`` may be in the bitmap, or all. Done in the worker that
    goes on with them: a filter before it would need a second worker for each task."""
    return b if wanted is None else b.filter(pa.array(maybe_member(wanted, b.column("h").to_numpy())))


def _signatures(docs, width, percent, frequent, wanted: np.ndarray | None = None):
    """doc_id, n, s1/s2 (128-bit set digest), bm (parities), prefix (hashes,
    rare first), of all documents or of those whose id may be ``wanted``."""
    sent = docs.sparkSession.sparkContext.broadcast((frequent, wanted))

    def arrays(parts):
        offsets = np.zeros(len(parts) + 1, np.int32)
        np.cumsum([p.size for p in parts], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))

    def run(batches):
        hasher, (late, some) = WordHasher(SPACED), sent.value
        for b in slices(_only(x, some) for x in batches):
            ns, s1, s2, bm, pref = [], [], [], [], []
            for s in _sets(b, hasher, width):
                n = s.size
                ns.append(n)
                s1.append(int(np.bitwise_xor.reduce(s)) if n else 0)
                s2.append(int(np.sum(s * (s >> np.uint64(29) | np.uint64(1)))) if n else 0)
                bm.append(_parities(s))
                if late.size and n:
                    at = np.minimum(np.searchsorted(late, s), late.size - 1)
                    common = late[at] == s
                    s = np.concatenate([s[~common], s[common]])
                pref.append(s[: n - -(-percent * n // 100) + 1].view(np.int64) if n else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array(ns, pa.int64()),
                    pa.array(np.array(s1, np.uint64).view(np.int64)),
                    pa.array(np.array(s2, np.uint64).view(np.int64)),
                    arrays(bm),
                    arrays(pref),
                ],
                ["doc_id", "n", "s1", "s2", "bm", "prefix"],
            )

    ids = F.col("doc_id").cast("long")
    out = docs.select(ids.alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(ids).alias("h")).mapInArrow(
        run, "doc_id long, n long, s1 long, s2 long, bm array<long>, prefix array<long>"
    )
    return out.withColumn("p1", F.xxhash64("prefix")).withColumn("p2", F.hash("prefix"))


def _full_sets(docs, width, wanted: np.ndarray):
    """(id, items) of the documents whose id may be wanted; other texts are
    neither shuffled nor shingled."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        hasher = WordHasher(SPACED)
        for b in batches:
            b = _only(b, sent.value)
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                sets = [s.view(np.int64) for s in _sets(part, hasher, width)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.list_(pa.int64()))], ["id", "items"])

    return docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("doc_id").cast("long")).alias("h"),
    ).filter("id IS NOT NULL").mapInArrow(run, "id long, items array<long>")


def _packed(x: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as compressed differences, low bytes first."""
    raw = np.diff(x, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[4:], decompressed_size=int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel(), dtype=np.uint32)


def _tokens_of(b):
    """(tokens of a batch's prefixes, row of each, place of each)."""
    lists = b.column("prefix")
    offs = lists.offsets.to_numpy().astype(np.int64)
    t = lists.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]]
    sizes = np.diff(offs)
    return t, np.repeat(np.arange(sizes.size), sizes), np.arange(t.size) - np.repeat(offs[:-1] - offs[0], sizes)


def _bin(t: np.ndarray) -> np.ndarray:
    return t.view(np.uint64) >> np.uint64(64 - SHARED_BITS)


def _shared_bins(rows: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """Bitmap of fixed size over the tokens' high bits: set where two rows' prefixes
    hold a token with the same 32 high bits, of the rows whose ``h`` may be ``wanted``. Tasks send sorted packed numbers, each
    at most twice, by ranges of about ``_FLUSH`` of them."""
    total = rows.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    log_parts = min(16, max(4, (int(total) // (2 * _FLUSH)).bit_length()))
    some = rows.sparkSession.sparkContext.broadcast(wanted)

    def send(batches):
        held, size = [], 0

        def flush():
            x = np.sort(np.concatenate(held))
            x = x[np.concatenate([[True, True], x[2:] != x[:-2]])[: x.size]]
            cuts = np.searchsorted(x, np.arange(1, 1 << log_parts, dtype=np.uint64) << np.uint64(32 - log_parts))
            parts = [(k, p) for k, p in enumerate(np.split(x, cuts)) if p.size]
            return pa.RecordBatch.from_pydict({"part": pa.array([k for k, _ in parts], pa.int32()), "data": [_packed(p) for _, p in parts]})

        for b in batches:
            t, _, _ = _tokens_of(_only(b, some.value))
            held.append((t.view(np.uint64) >> np.uint64(32)).astype(np.uint32))
            size += t.size
            if size > _FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    width = SHARED_BITS - log_parts  # bins of a part, as a power of two

    def mark(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        x = np.sort(np.concatenate([_unpacked(d) for d in table.column("data").to_pylist()]))
        twice = x[1:][x[1:] == x[:-1]].astype(np.int64) >> (32 - SHARED_BITS)
        bits = np.zeros(1 << width, bool)
        bits[twice - (part << width)] = True
        return pa.table({"part": pa.array([part], pa.int32()), "data": [pa.compress(np.packbits(bits, bitorder="little"), codec="zstd", asbytes=True)]})

    sent = rows.select("prefix", "h").mapInArrow(send, "part int, data binary")
    out = np.zeros((1 << SHARED_BITS) // 8, np.uint8)
    size = (1 << width) // 8
    for part, data in sent.groupBy("part").applyInArrow(mark, "part int, data binary").collect():  # 2^log_parts rows
        out[part * size : (part + 1) * size] = np.frombuffer(pa.decompress(bytes(data), decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    return out


def _postings(rows: DataFrame, shared: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """(t, i, g, n, s1, s2): prefix tokens, with their places, that may be shared, of
    the rows whose ``h`` may be ``wanted``."""
    sent = rows.sparkSession.sparkContext.broadcast((shared, wanted))

    def run(batches):
        bins, some = sent.value
        for b in batches:
            b = _only(b, some)
            t, row, place = _tokens_of(b)
            at = _bin(t)
            keep = (bins[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            row = pa.array(row[keep])
            columns = [pa.array(t[keep]), pa.array(place[keep].astype(np.int32)), *[b.column(c).take(row) for c in ("doc_id", "n", "s1", "s2")]]
            yield pa.RecordBatch.from_arrays(columns, ["t", "i", "g", "n", "s1", "s2"])

    return rows.select("doc_id", "n", "s1", "s2", "prefix", "h").mapInArrow(run, "t long, i int, g long, n long, s1 long, s2 long")


def _ids(pairs):
    return pairs.select(F.explode(F.array("a", "b")).alias("id"))


def _enough(shared, na, nb, percent):
    return F.lit(100) * shared >= F.lit(percent) * (na + nb - shared)


def _bounded(na, nb, ba, bb, percent):
    """Size filter and bitmap filter: false only if the pair cannot link."""
    differ = sum((F.bit_count(F.col(ba)[i].bitwiseXOR(F.col(bb)[i])) for i in range(BITS // 64)), F.lit(0))
    a, b = F.col(na), F.col(nb)
    return _enough(F.least(F.floor((a + b - differ) / 2), a, b), a, b, percent)


def _prefix_bounded(pairs, docs, width, percent, frequent):
    """Pairs whose prefixes leave room for a link: beyond what the prefixes
    share, the set whose prefix ends first can add at most its own rest. The
    prefixes of these few documents are made anew, so that none are kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    some = _signatures(docs, width, percent, frequent, member_bitmap(_ids(pairs), "id"))
    some = stage(some.select(F.col("doc_id").alias("id"), "n", "prefix"), "prefixes")
    left = some.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("pa"))
    right = some.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("pb"))
    shared = F.size(F.array_intersect("pa", "pb"))
    most = shared + F.greatest(F.col("na") - F.size("pa"), F.col("nb") - F.size("pb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", F.least(most, "na", "nb").alias("most"))
    return stage(both.filter(_enough(F.col("most"), F.col("na"), F.col("nb"), percent)).select("a", "b"), "large"), some


def _verify(pairs, docs, frequent, facts, width, percent):
    """Pairs (a, b) of class ids that link. ``facts``: (id, n, bm). The bitmaps
    of sets much larger than BITS say little: these meet by their prefixes first."""
    left = facts.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("bm").alias("ba"))
    right = facts.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("bm").alias("bb"))
    near = pairs.join(left, "a").join(right, "b").filter(_bounded("na", "nb", "ba", "bb", percent))
    bounded = stage(near.select("a", "b", (F.least("na", "nb") > BITS).alias("large")), "bounded")
    large, prefixes = _prefix_bounded(bounded.filter("large").select("a", "b").distinct(), docs, width, percent, frequent)
    near = stage(bounded.filter("NOT large").select("a", "b").unionByName(large).distinct(), "near")
    discard(bounded, large, prefixes)
    sets = stage(_full_sets(docs, width, member_bitmap(_ids(near), "id")), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("ia"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("ib"))
    both = near.join(left, "a").join(right, "b")
    both = both.select("a", "b", F.size("ia").alias("na"), F.size("ib").alias("nb"),
                       F.size(F.array_intersect("ia", "ib")).alias("s"))
    links = stage(both.filter(_enough(F.col("s"), F.col("na"), F.col("nb"), percent)).select("a", "b").distinct(), "links")
    discard(near, sets)
    return links


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row; see the
    module's text for the method and for defined results."""
    frequent = frequent_shingles(docs, width)
    rows = stage(_signatures(docs, width, percent, frequent), "signatures")
    has = rows.filter("n > 0 AND doc_id IS NOT NULL")

    # 1: one class for each set, one group for each (prefix, size)
    same = [F.min(c).alias(c) for c in ("p1", "p2", "bm")]  # equal in a class
    classes = stage(has.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("id"), *same), "classes")
    facts = classes.select("id", "n", "bm")
    groups = stage(classes.groupBy("p1", "p2", "n").agg(F.min("id").alias("g"), (F.count("*") > 1).alias("several")), "groups")
    member = stage(classes.select("id", "s1", "s2", "n", "p1", "p2").join(groups, ["p1", "p2", "n"]).drop("p1", "p2"), "members")

    # 2: postings of group representatives; a list with one group makes no pair
    # only tokens of two groups' prefixes are shuffled; bitmaps spare the others, joins are exact
    leads = member.filter("id = g").select(F.col("id").alias("g"), "s1", "s2")
    keyed = has.withColumn("h", F.xxhash64("doc_id", "s1", "s2"))
    wanted = member_bitmap(leads.select(F.xxhash64("g", "s1", "s2").alias("lead")), "lead", hashed=True)
    open_tokens = _postings(keyed, _shared_bins(keyed, wanted), wanted).join(leads, ["g", "s1", "s2"], "left_semi")
    postings = open_tokens.select("t", "g", "n", "i").repartition("t").dropDuplicates(["t", "g"])
    e = F.struct("g", "n", "i")  # both uses of the postings read the same columns: one exchange serves them
    lists = postings.groupBy("t").agg(F.min(e).alias("r1"), F.max("g").alias("last"), F.min_by(e, F.xxhash64("t", "g")).alias("r2"))
    shared = stage(postings.join(lists.filter("r1.g <> last").drop("last"), "t"), "postings")
    ids = stage(rows.select("doc_id", "n", "s1", "s2"), "ids")
    has = ids.filter("n > 0 AND doc_id IS NOT NULL")
    discard(rows)

    # 3a: representatives of lists and of groups
    sized = lambda a, b: F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)
    first = shared.select("g", "n", F.explode(F.array("r1", "r2")).alias("r")).filter((F.col("g") != F.col("r.g")) & sized(F.col("n"), F.col("r.n")))
    first = first.select(F.least("g", "r.g").alias("a"), F.greatest("g", "r.g").alias("b"))
    inner = member.filter("id <> g").select(F.least("id", "g").alias("a"), F.greatest("id", "g").alias("b"))
    links = _verify(first.unionByName(inner).distinct(), docs, frequent, facts, width, percent)

    # 3b: every pair of a list that is still in two components. The first pass
    # has met all pairs of lists of two groups, and of three with two representatives
    comp = stage(components(links), "components")
    placed = stage(
        member.join(comp, F.col("id") == F.col("node"), "left").select("id", "g", F.coalesce("comp", "id").alias("comp"), "several"), "placed")
    state = stage(placed.groupBy("g").agg(F.min("comp").alias("c"), (F.min("comp") != F.max("comp")).alias("mixed"), F.max("several").alias("several")), "state")
    met = F.when(F.col("r1.g") == F.col("r2.g"), 2).otherwise(3)
    lists = stage(shared.select("t", "g", "n", "i", met.alias("met")).join(state, "g"), "lists")
    discard(shared)
    votes = lists.groupBy("t", "c").agg(F.count("*").alias("k"), F.max("mixed").alias("mixed"), F.max("several").alias("several"), F.max("met").alias("met"))
    votes = votes.groupBy("t").agg(F.max_by("c", F.struct("k", "c")).alias("main"), F.count("*").alias("cs"), F.max("mixed").alias("mixed"),
                                   F.max("several").alias("several"), F.sum("k").alias("k"), F.max("met").alias("met"))
    votes = stage(votes.filter("(cs > 1 OR mixed) AND (k > met OR several)").select("t", "main"), "votes")
    bits = facts.select(F.col("id").alias("g"), "bm")
    open_lists = stage(lists.drop("met").join(votes, "t").join(bits, "g"), "open-lists")
    discard(lists, votes)
    few = open_lists.filter("c <> main OR mixed").select("t", *[F.col(c).alias(c + "1") for c in ("g", "n", "i", "c", "mixed", "several", "bm")])
    every = open_lists.select("t", "main", *[F.col(c).alias(c + "2") for c in ("g", "n", "i", "c", "mixed", "several", "bm")])
    apart = (F.col("c1") != F.col("c2")) | F.col("mixed1") | F.col("mixed2")
    once = (F.col("g1") < F.col("g2")) | ((F.col("c2") == F.col("main")) & ~F.col("mixed2"))  # the other is not among the few
    bound = F.when(F.col("several1") | F.col("several2"), sized(F.col("n1"), F.col("n2"))).otherwise(_bounded("n1", "n2", "bm1", "bm2", percent))
    bound &= _enough(F.least(F.col("n1") - F.col("i1"), F.col("n2") - F.col("i2")), F.col("n1"), F.col("n2"), percent)
    cross = few.join(every, (few["t"] == every["t"]) & (F.col("g1") != F.col("g2")) & apart & once & bound)
    cross = cross.select(F.least("g1", "g2").alias("ga"), F.greatest("g1", "g2").alias("gb")).distinct()
    inside = state.filter("mixed").select(F.col("g").alias("ga"), F.col("g").alias("gb"))
    cross = stage(cross.unionByName(inside), "group-pairs")
    left = placed.select(F.col("id").alias("x"), F.col("g").alias("ga"), F.col("comp").alias("cx"))
    right = placed.select(F.col("id").alias("y"), F.col("g").alias("gb"), F.col("comp").alias("cy"))
    second = cross.join(left, "ga").join(right, "gb").filter("cx <> cy").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    more = _verify(second.distinct(), docs, frequent, facts, width, percent)
    # rows that repeat an id with other sets are one document: its classes belong together
    texts = has.groupBy("doc_id").agg(*[(F.min(c) != F.max(c)).alias(c) for c in ("s1", "s2", "n")]).filter("s1 OR s2 OR n")
    own = has.join(texts.select("doc_id"), "doc_id", "left_semi").join(classes, ["s1", "s2", "n"]).select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    all_links = stage(links.unionByName(more).unionByName(own), "all-links")
    discard(open_lists, cross, placed, state, comp, links, more)

    # 4
    comp = stage(components(all_links), "components")
    final = stage(
        classes.join(comp, F.col("id") == F.col("node"), "left").select("s1", "s2", "n", F.coalesce("comp", "id").alias("comp")),
        "class-components",
    )
    discard(comp, all_links, classes, groups, member)
    out = ids.join(final, ["s1", "s2", "n"], "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"),
    )


def keep_one_per_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are their component's smallest id, all columns as
    they came; of rows that repeat such an id, one stays. Rows with null doc_id
    belong to no group and stay."""
    comps = stage(jaccard_components(docs, width, percent).filter("doc_id IS NOT NULL").select("doc_id", "component_id"), "doc-components")
    odd = comps.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("__join_keep"), F.count("*").alias("__join_n"))
    odd = stage(odd.filter("NOT __join_keep OR __join_n > 1").withColumnRenamed("doc_id", "__join_id"), "odd-ids")
    key = F.col("doc_id").cast("long")
    sure, rest = split_by_membership(docs, key, odd, "__join_id")
    rest = rest.join(odd, key == F.col("__join_id"), "left")
    plain = rest.filter("__join_id IS NULL")
    order = Window.partitionBy("__join_id").orderBy(F.col("text").asc_nulls_last(), *[F.xxhash64(F.col(c)) for c in docs.columns if c in ("lang", "source", "n_chars")])
    one = rest.filter("__join_keep").withColumn("__join_row", F.row_number().over(order)).filter("__join_row = 1")
    return sure.unionByName(plain.select(*docs.columns)).unionByName(one.select(*docs.columns))
