"""Quality classifier against plain numpy, and the pipeline's later stages against plain versions."""

import collections
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from corpusmill.llm import quality as Q

SF = "/root/testdata/sf0.001"


def _tables(spark):
    return (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels", "benchmark"))


def test_discriminant_equals_plain_numpy(spark):
    docs, labels, _ = _tables(spark)
    stats = {r["doc_id"]: np.array(r["x"]) for r in Q.document_statistics(docs.select("doc_id", "text"), ["doc_id"]).collect()}
    train = [(stats[r["doc_id"]], r["quality"]) for r in labels.collect()
             if r["doc_id"] in stats and r["quality"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    x, y = np.array([a for a, _ in train]), np.array([b for _, b in train])
    n = {c: (y == c).sum() for c in (0, 1)}
    mean = {c: x[y == c].mean(0) for c in n}
    cov = {c: np.cov(x[y == c].T, bias=True) for c in n}
    pooled = sum(n[c] * cov[c] for c in n) / len(y)
    d = x.shape[1]
    diagonal = np.diag(np.diag(pooled) + Q.RIDGE)

    def density(c, v):
        w = max(Q.SHRINK_POOLED, d / (d + n[c]))
        s = (1 - w - Q.SHRINK_DIAGONAL * (1 - w)) * cov[c] + w * pooled + Q.SHRINK_DIAGONAL * (1 - w) * diagonal + Q.RIDGE * np.eye(d)
        u = v - mean[c]
        return -0.5 * np.einsum("ij,ij->i", u, np.linalg.solve(s, u.T).T) - 0.5 * np.linalg.slogdet(s)[1]

    def difference(v):
        return Q.CLIP * np.arcsinh((density(1, v) - density(0, v)) / Q.CLIP)

    ids = sorted(stats)
    every = np.array([stats[i] for i in ids])
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in train], "x array<double>, y int")
    model = Q.fit(rows)
    assert np.allclose(model.difference(every), difference(every), atol=1e-6)
    # the calibration, on single rows instead of bins
    z, w = np.stack([difference(x) / Q.CLIP, np.ones(len(y))], 1), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (y - p) - 1e-3 * w)
        w = w + np.clip(step, -5, 5)
    want = dict(zip(ids, 1 / (1 + np.exp(-np.clip(w[0] / Q.CLIP * difference(every) + w[1], -500, 500)))))
    got = {r["doc_id"]: r for r in Q.score_documents(docs.select("doc_id", "text"), labels).collect()}
    assert max(abs(got[i]["score"] - want[i]) for i in ids) < 0.02
    assert all(r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_decontamination_stage(spark):
    docs, _, bench = _tables(spark)
    windows = collections.defaultdict(set)
    for r in bench.collect():
        w = _words(r["text"])
        size = min(10, len(w))
        if size:
            windows[size] |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    want = set()
    for r in docs.collect():
        w = _words(r["text"])
        if not any(tuple(w[i : i + n]) in found for n, found in windows.items() for i in range(len(w) - n + 1)):
            want.add(r["doc_id"])
    got = P.decontaminate(spark, docs, SF)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == want and len(want) < docs.count()


def test_mix_and_shard_stages(spark):
    from corpusmill.llm.mixing import mix

    docs, _, _ = _tables(spark)
    copies = {r["doc_id"]: r["copies"] for r in mix(docs).collect()}
    mixed = P.mix(spark, docs, SF)
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and times == collections.Counter({k: v for k, v in copies.items() if v})
    put = P.shard(spark, mixed, SF).collect()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert collections.Counter(r["doc_id"] for r in put) == times
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in put)
    load, places = collections.Counter(), collections.defaultdict(list)
    for r in put:
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    # no shard above the mean by more than the largest virtual slot
    slots = collections.Counter()
    for r in put:
        slots[r["vslot"]] += r["size"]
    assert max(load.values()) <= sum(load.values()) / 16 + max(slots.values())
