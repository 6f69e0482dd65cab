"""Document quality by regularised quadratic discriminant analysis.

Each text becomes a fixed vector of transformed statistics (lengths, byte
classes, repetition of words, shingles and lines). Spark sums counts, first and
second moments of every class over all training rows; the driver sees only
these sums (about 500 numbers a class). Each class covariance is shrunk towards
the pooled covariance and its diagonal, factored once by Cholesky, and the
factors go to the tasks, which score whole batches by triangular solves. The
log-density difference becomes a probability through a two-parameter logistic
fit on binned training differences (counts for each bin, from all rows).

Defined results: null text counts as empty, and empty texts get the score of
their statistics like any other. Labels that are null or whose doc_id has no
document teach nothing; a doc_id with several label rows teaches with each.
With no training rows of one class every score is the share of the other class
(0.5 without any labels). Rows with null doc_id are scored, count as not held
out (crc32 of null is null) and return held_out false. Extra columns are
ignored or, where documents are filtered, kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from corpusmill.llm.bytewords import SPACED, WordHasher, shingle_hashes
from corpusmill.llm.common import drop_by_id, stage

#: Weight of the pooled covariance, and of its diagonal, in a class covariance.
SHRINK_POOLED, SHRINK_DIAGONAL, RIDGE = 0.10, 0.05, 1e-4
CLIP = 60.0  # log-density differences are squashed beyond this scale
BINS = 400
THRESHOLD = 0.3

# byte classes: position in this list + 1; every other byte is class 0
_CLASSES = [
    bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)), b"0123456789", b" \t\x0b\x0c\r", b"\n", b".", b",", b"!?",
    b"#$%&*@^~=+<>\\/_`", b"|", b"()[]{}\"'", b"-:;", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100)),
]
_CLASS_OF = np.zeros(256, dtype=np.intp)
for _k, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _k + 1

FEATURES = (
    "log_words log_bytes log_word_bytes upper lower digit space log_line point comma shout symbol pipe quote dash "
    "non_ascii control distinct_words top_word word_entropy twin_words repeated_shingles repeated_lines capital_words"
).split()


def _line_repetition(text: bytes) -> float:
    lines = [x for x in text.split(b"\n") if x]
    total = sum(map(len, lines))
    return 1 - sum(map(len, set(lines))) / total if total else 0.0


def _statistics(text: bytes, words: np.ndarray) -> list[float]:
    n, size = words.size, len(text)
    data = np.frombuffer(text, dtype=np.uint8)
    k = np.bincount(_CLASS_OF[data], minlength=len(_CLASSES) + 1)
    chars = max(1, size - k[13])  # code points: bytes that continue none
    share = np.sqrt(k / chars)
    solid = max(1, size - k[4] - k[5])
    if n:
        _, counts = np.unique(words, return_counts=True)
        p = counts / n
        entropy = float(-(p * np.log(p)).sum()) / np.log(n + 1)
        distinct, top = np.log(counts.size + 1) / np.log(n + 1), np.sqrt(p.max())
        twins = np.sqrt(np.count_nonzero(words[1:] == words[:-1]) / n)
        sh = shingle_hashes(words, 5)
        repeated = np.sqrt(1 - np.unique(sh).size / sh.size)
    else:
        entropy = distinct = top = twins = repeated = 0.0
    after = np.concatenate([[True], _CLASS_OF[data[:-1]] == 4]) if size else np.zeros(0, bool)
    capital = np.count_nonzero(after & (_CLASS_OF[data] == 1)) / max(1, n)
    return [
        np.log1p(n), np.log1p(size), np.log(solid / max(1, n)), share[1], share[2], share[3], share[4],
        np.log(chars / (k[5] + 1)), share[6], share[7], share[8], share[9], share[10], share[11], share[12],
        share[14], share[0], distinct, top, entropy, twins, repeated, np.sqrt(_line_repetition(text)), np.sqrt(min(1.0, capital)),
    ]


def document_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and x array<double>: the transformed statistics."""
    schema = docs.select(*keep).schema.add("x", ArrayType(DoubleType()))

    def run(batches):
        hasher = WordHasher(SPACED)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                words, offs = hasher.words(part.column("text"))
                x = [
                    _statistics((t.as_py() or "").encode("utf-8"), words[offs[i] : offs[i + 1]])
                    for i, t in enumerate(part.column("text"))
                ]
                cols = [part.column(c) for c in keep] + [pa.array(x, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(cols, [*keep, "x"])

    return docs.select(*[F.col(c) for c in keep if c != "text"], F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _moments(rows: DataFrame) -> DataFrame:
    """(y, m): for each class the sums of 1, x and x x^T over its rows,
    summed in the tasks first."""
    d = len(FEATURES) + 1

    def run(batches):
        total = {}
        for b in batches:
            if b.num_rows:
                x = np.concatenate([np.ones((b.num_rows, 1)), np.array(b.column("x").to_pylist())], axis=1)
                y = b.column("y").to_numpy()
                for c in (0, 1):
                    part = x[y == c]
                    total[c] = total.get(c, 0) + part.T @ part
        if total:
            ys, ks, vs = [], [], []
            for c, m in total.items():
                ys += [c] * d * d
                ks += range(d * d)
                vs += m.ravel().tolist()
            yield pa.RecordBatch.from_pydict({"y": pa.array(ys, pa.int32()), "k": pa.array(ks, pa.int32()), "v": vs})

    return rows.mapInArrow(run, "y int, k int, v double").groupBy("y", "k").agg(F.sum("v").alias("v"))


class Discriminant:
    """Means, Cholesky factors and log determinants of the two classes."""

    def __init__(self, sums: dict[int, np.ndarray]):
        n = {c: m[0, 0] for c, m in sums.items()}
        mean = {c: m[0, 1:] / n[c] for c, m in sums.items()}
        cov = {c: m[1:, 1:] / n[c] - np.outer(mean[c], mean[c]) for c, m in sums.items()}
        pooled = sum(n[c] * cov[c] for c in cov) / sum(n.values())
        base = np.diag(np.diag(pooled) + RIDGE)
        self.rows, self.mean, self.inverse, self.logdet = n, mean, {}, {}
        self.slope, self.shift = 1.0, 0.0
        for c in cov:
            few = len(base) / (len(base) + n[c])  # a small class leans more on the pooled matrix
            w = max(SHRINK_POOLED, few)
            s = (1 - w - SHRINK_DIAGONAL * (1 - w)) * cov[c] + w * pooled + SHRINK_DIAGONAL * (1 - w) * base
            low = np.linalg.cholesky(s + RIDGE * np.eye(len(base)))
            self.inverse[c] = np.linalg.inv(low)
            self.logdet[c] = 2 * np.log(np.diag(low)).sum()

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Squashed log density of class 1 less that of class 0."""
        log = {c: -0.5 * (((x - self.mean[c]) @ self.inverse[c].T) ** 2).sum(1) - 0.5 * self.logdet[c] for c in (0, 1)}
        return CLIP * np.arcsinh((log[1] - log[0]) / CLIP)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.shift, -500, 500)))

    def calibrate(self, bins: list[tuple[float, int, int]]) -> None:
        """Logistic fit on (mean difference, rows, rows of class 1) by Newton steps."""
        z = np.array([[b[0] / CLIP, 1.0] for b in bins])
        n, k = (np.array([b[i] for b in bins], dtype=float) for i in (1, 2))
        w = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            g = z.T @ (k - n * p) - 1e-3 * w
            h = (z * (n * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
            step = np.linalg.solve(h, g)
            w = w + np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.shift = w[0] / CLIP, w[1]


def fit(rows: DataFrame) -> Discriminant | float:
    """``rows``: (x, y) of the training documents. A float if a class is missing."""
    d = len(FEATURES) + 1
    sums: dict[int, np.ndarray] = {}
    for y, k, v in _moments(rows).collect():  # 2 (d + 1)^2 numbers
        sums.setdefault(y, np.zeros(d * d))[k] = v
    sums = {c: m.reshape(d, d) for c, m in sums.items() if m[0] > 0}
    if len(sums) < 2:
        return 1.0 if 1 in sums else 0.0 if 0 in sums else 0.5
    model = Discriminant(sums)

    def run(batches):
        for b in batches:
            if b.num_rows:
                v = model.difference(np.array(b.column("x").to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(v), b.column("y")], ["d", "y"])

    bins = rows.mapInArrow(run, "d double, y int").groupBy(F.round(F.col("d") * (BINS / 1000.0)).alias("b"))
    model.calibrate(bins.agg(F.avg("d"), F.count("*"), F.sum("y")).orderBy("b").drop("b").collect())
    return model


def held_out(col="doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``. Learns
    from labelled documents that are not held out."""
    x = stage(document_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"]), "statistics")
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    train = x.filter(~held_out()).join(y.filter("y IN (0, 1) AND doc_id IS NOT NULL"), "doc_id").select("x", "y")
    model = fit(stage(train, "training"))

    def run(batches):
        for b in batches:
            if isinstance(model, float):
                s = np.full(b.num_rows, model)
            else:
                s = model.score(np.array(b.column("x").to_pylist()).reshape(b.num_rows, -1)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    out = x.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, all columns as they came. Rows that
    repeat a doc_id stay or go by the best score of the id; rows without doc_id stay."""
    bad = score_documents(docs, labels, threshold).groupBy("doc_id").agg(F.max("predicted").alias("p")).filter("p = 0 AND doc_id IS NOT NULL")
    return drop_by_id(docs, F.col("doc_id").cast("long"), stage(bad.select("doc_id"), "rejected"), "doc_id")
