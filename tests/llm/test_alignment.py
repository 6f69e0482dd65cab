"""Token alignment against a walk over both token lists."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.llm import alignment as AL

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    """The library that owns the vocabulary file, for A; B as it is."""
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{AL.TOKENIZERS}/{AL.A_FILE}")
    a.encode_special_tokens = True
    return a, AL.ByteLevel(f"{AL.TOKENIZERS}/{AL.A_FILE}"), AL.Pieces(f"{AL.TOKENIZERS}/{AL.B_FILE}")


def brute(rows, tokenizers):
    plain, a, b = tokenizers
    per, held = [], Counter()
    for doc_id, text in rows:
        empty = (doc_id, 0, 0, 0, 0, "", Counter())
        if not text:
            per.append(empty)
            continue
        ia, ib = plain.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
        pa, pb = [a.pieces[i] for i in ia], [b.pieces[i] for i in ib]
        if b"".join(pa) != (" " + text).encode() or b"".join(pb) != (" " + text).encode():
            per.append(empty)
            continue
        ea, eb = np.cumsum([len(p) for p in pa]).tolist(), np.cumsum([len(p) for p in pb]).tolist()
        links, groups, i, j, gi, gj = Counter(), [], 0, 0, 0, 0
        while i < len(ia):
            links[ia[i], ib[j]] += 1
            x, y = ea[i], eb[j]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append(",".join(map(str, ia[gi:i])) + "|" + ",".join(map(str, ib[gj:j])))
                gi, gj = i, j
        held.update(links.keys())
        per.append((doc_id, len(ia), len(ib), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return sorted(((d, na, nb, ng, nl, sum(m for p, m in ls.items() if held[p] == top[p[0]]), sum(m * held[p] for p, m in ls.items()), sha)
                   for d, na, nb, ng, nl, sha, ls in per), key=str)


ODD = [(None, "x y"), (1, ""), (2, None), (3, "a▁b c"), (4, "   lead  trail  "), (5, "<|endoftext|> <s> <0x41>"),
       (6, "\U0001f600́ 中文 x" * 50), (7, "\n\t a  b"), (8, " "), (9, "a" * 5000), (10, "\x00 b"), (3, "repeat it"), (3, "repeat it"),
       (11, "so many words and  numbers 12345 here, there. " * 40)]


@pytest.mark.parametrize("block, piece", [(1 << 20, 1 << 19), (50, 3), (400, 40)])
def test_odd_texts_in_blocks_and_pieces_of_any_size(spark, tokenizers, block, piece):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("pairs", F.lit("clash")).withColumn("block", F.lit(1))
    got = AL.align_documents(df, block_bytes=block, piece_chars=piece).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(ODD, tokenizers)


def test_documents(spark, tokenizers):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    got = AL.align_documents(df, block_bytes=30_000).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, tokenizers)


def test_empty_table(spark):
    assert AL.align_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pair_counts_are_of_documents(spark):
    docs = spark.createDataFrame([(1, "b b b"), (2, "b c"), (2, "b c")], "doc_id long, text string")
    counts = AL.pair_counts(AL.align_blocks(docs, block_bytes=1)).collect()
    assert max(r["total"] for r in counts) == 3 and {r["best"] for r in counts if r["total"] == 3} == {True}


def test_ids_equal_the_vocabulary_owners(tokenizers):
    plain, a, _ = tokenizers
    texts = [" " + "".join(map(chr, [c, 65, c, 32, c, c, 10, 39, c, 48, c])) for c in [*range(1, 0x500), *range(0x2000, 0x2100), 0x3000, 0x1F600, 0x10FFFF]]
    assert a.encode(texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=150), st.data())
def test_shared_cuts_are_all_common_ends(lengths, data):
    a = np.cumsum(lengths)
    total, b, at = int(a[-1]), [], 0
    while at < total:
        at = min(total, at + data.draw(st.integers(1, 9)))
        b.append(at)
    b = np.array(b)
    zero = np.zeros(1, np.int64)
    ca, cb = AL.shared_cuts(a, b, zero, np.array([a.size]), zero, np.array([b.size]))
    common = sorted(set(a[:-1].tolist()) & set(b[:-1].tolist()))
    assert a[ca].tolist() == common == b[cb].tolist()


def test_long_intervals_without_a_cut():
    a, b = np.append(np.arange(2, 4000, 2), 4001), np.append(np.arange(3, 4000, 2), 4001)
    a2, b2 = np.concatenate([a, a + 4001]), np.concatenate([b, b + 4001])
    zero = np.zeros(1, np.int64)
    ca, cb = AL.shared_cuts(a2, b2, zero, np.array([a2.size]), zero, np.array([b2.size]))
    assert a2[ca].tolist() == [4001] == b2[cb].tolist()
