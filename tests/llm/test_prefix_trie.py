"""Conversation trie against a brute-force version, with and without a skeleton."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import prefix_trie as PT

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), key, role, text))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        paths[c] = tuple(convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, below = [], {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves = sum(below[k][0] for k in children[node]) or 1
        saved = (len(members[node]) - 1) * words + sum(below[k][1] for k in children[node])
        below[node] = leaves, saved
        ends = ",".join(str(c) for c in sorted(members[node]) if len(paths[c]) == len(node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def run(df, shards=None):
    return sorted((tuple(r) for r in PT.conversation_trie(df, shards).select(*COLUMNS).collect()), key=str)


def hot_rows():
    """A third of all conversations are equal, long ones share a deep path, some have one turn only."""
    rows = []
    for c in range(300):
        if c % 3 == 0:
            rows += [(c, t, "user", f"same {t}") for t in range(4)]
        elif c % 3 == 1:
            rows += [(c, t, "a" * (t % 2), f"deep {t}") for t in range(12)] + [(c, 99, "user", f"end {c % 7}")]
        else:
            rows += [(c, 0, None, f"one {c % 5}")]
    return rows


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_hot_paths_at_every_number_of_shards(spark, shards):
    rows = hot_rows()
    assert run(table(spark, rows), shards) == brute(rows)


def test_splitters_cut_short_stay_right(spark, monkeypatch):
    monkeypatch.setattr(PT, "SKELETON_NODES", 16)  # 2 turns a splitter
    monkeypatch.setattr(PT, "CHUNK_CHARS", 20)
    rows = hot_rows()
    assert run(table(spark, rows), 8) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (1, None, "user", "first"), (1, 0, "user", "second"), (1, 0, "user", "second"), (1, 0, None, None),
            (-3, 0, "u", "x y"), (0, 0, "u", "x y"), (23, 5, "u", "z"), (2**40, -1, "", ""), (2**40, -2, "ab", "c"), (41, 0, "a", "bc")]
    assert run(table(spark, rows)) == brute(rows)
    extra = table(spark, rows).withColumn("depth", F.lit(1)).withColumn("path", F.lit("x")).withColumn("sk", F.lit(0))
    assert run(extra) == brute(rows)


def test_empty_table(spark):
    assert run(table(spark, [])) == []


def test_own_turn_lists(spark):
    """The operator's own interface takes conversations as they are."""
    rows = hot_rows()[:200]
    got = PT.trie_nodes(PT.conversation_paths(table(spark, rows)), 3).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, rebuild=False)
