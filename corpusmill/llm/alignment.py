"""Alignment of two tokenizers' tokens, by divide and conquer at shared cuts.

Tokenizer A sees a space and the text, tokenizer B the text (it adds the space
itself); both then spell the same bytes. The ends of A's and B's tokens are byte
offsets. An interval of both token lists is split at a common end near its
middle, found by bisecting B's ends for A's end there and then for A's ends
further and further from it; both halves are split again, and an interval
without an inner common end is a leaf group. All open intervals of a batch of
texts are split together, one round of numpy calls for all of them.

Inside a group every inner end belongs to one tokenizer alone, so a link (A and B
token with overlapping bytes) is one stretch between neighbouring ends.

Counts over the corpus: a block of texts (``BLOCK_BYTES``, or one long text)
becomes one row with a dictionary of its id pairs and, for each text, references
into it. The pairs of all blocks are counted and ranked by Spark; each block then
gets the counts of its own dictionary back. No text and no per-text pair list is
shuffled by pair, and no task holds more than one block's pairs.

Defined results: a null or empty text, or one whose tokens do not spell it, has no
tokens (zeros and ''). Repeated rows are documents of their own; a null doc_id
stays null. Long texts are tokenised in pieces of about ``PIECE_CHARS`` characters,
cut before a single space between two other characters, where both tokenizers
begin a new token whatever surrounds it; a stretch without such a place stays
whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 1 << 20
PIECE_CHARS = 1 << 19
#: Ends probed one by one on each side of an interval's middle, then all at once.
NEAR = 24
#: A pair of ids as one long: A's id times this plus B's.
B_IDS = 1 << 20

#: Pre-tokenisation of a byte-level vocabulary (fixed value of the format).
A_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """Letters of the byte-level alphabet: printable Latin-1 bytes stand for
    themselves, the others for code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """Tokenizer A. Its vocabulary lists merges in order, so a token's id is its
    rank and the rank-driven encoder gives the same ids (tested)."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        vocab = {bytes(letters[c] for c in k): i for k, i in spec["model"]["vocab"].items() if i not in special}
        self.pieces = [b""] * (max(vocab.values()) + 1)
        for k, i in vocab.items():
            self.pieces[i] = k
        self.encoding = tiktoken.Encoding("byte-level", pat_str=A_PATTERN, mergeable_ranks=vocab, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(t) for t in texts]


class Pieces:
    """Tokenizer B."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.pieces = []
        for i in range(self.model.get_piece_size()):
            p = self.model.id_to_piece(i)
            m = byte.fullmatch(p)
            self.pieces.append(bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


def pieces_of(text: str, chars: int = PIECE_CHARS) -> list[str]:
    """``text`` in pieces cut before a lone space, which is dropped (both
    tokenizers get it back in front of the next piece)."""
    out, at = [], 0
    while len(text) - at > chars:
        m = _CUT.search(text, at + chars)
        if m is None:
            break
        out.append(text[at : m.start()])
        at = m.end()
    out.append(text[at:])
    return out


def _flat(lists, lengths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all lists, tokens of each list, end byte of each token)."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = np.fromiter((i for x in lists for i in x), np.int64, int(counts.sum()))
    return ids, counts, np.cumsum(lengths[ids])


def shared_cuts(a_ends, b_ends, a_lo, a_hi, b_lo, b_hi) -> tuple[np.ndarray, np.ndarray]:
    """(A index, B index) of the last tokens before every common end inside the
    intervals [a_lo, a_hi) x [b_lo, b_hi) of token indexes, by divide and conquer.
    The intervals' own ends are not returned. No token may be empty."""
    found_a, found_b = [], []
    open_ = np.stack([a_lo, a_hi, b_lo, b_hi]).astype(np.int64)
    step = np.zeros(open_.shape[1], np.int64)
    while open_.shape[1]:
        lo, hi, blo, bhi = open_
        keep = (hi - lo > 1) & (bhi - blo > 1)
        middle = (lo + hi - 2) >> 1
        # steps 0, 1, 2, 3, 4 ... look at the middle, then +1, -1, +2, -2 ... of it
        at = middle + np.where(step & 1, (step + 1) >> 1, -(step >> 1))
        inside = (at >= lo) & (at < hi - 1)
        keep &= inside | (step <= hi - lo)
        open_, step, at, inside = open_[:, keep], step[keep], at[keep], inside[keep]
        if not open_.shape[1]:
            break
        probe = np.where(inside, at, open_[0])
        j = np.searchsorted(b_ends, a_ends[probe])
        hit = inside & (b_ends[np.minimum(j, b_ends.size - 1)] == a_ends[probe])
        far = ~hit & (step >= 2 * NEAR)
        parts, steps = [], []
        if far.any():  # few: look at all remaining ends of these intervals at once
            for lo1, hi1, blo1, bhi1 in open_[:, far].T:
                ends = a_ends[lo1 : hi1 - 1]
                k = np.searchsorted(b_ends[blo1 : bhi1 - 1], ends)
                same = np.flatnonzero(k < bhi1 - 1 - blo1)
                same = same[b_ends[blo1 + k[same]] == ends[same]]
                if same.size:
                    i = same[np.argmin(np.abs(same - (hi1 - lo1 - 2) / 2))]
                    parts.append([[lo1, lo1 + i + 1, blo1, blo1 + k[i] + 1], [lo1 + i + 1, hi1, blo1 + k[i] + 1, bhi1]])
                    found_a.append([lo1 + i])
                    found_b.append([blo1 + k[i]])
            parts = [np.array(parts, np.int64).reshape(-1, 4).T]
            steps = [np.zeros(parts[0].shape[1], np.int64)]
        lo, hi, blo, bhi = open_[:, hit]
        i, k = at[hit], j[hit]
        found_a.append(i)
        found_b.append(k)
        rest = ~hit & ~far
        left, right = np.stack([lo, i + 1, blo, k + 1]), np.stack([i + 1, hi, k + 1, bhi])
        open_ = np.concatenate([*parts, left, right, open_[:, rest]], axis=1)
        step = np.concatenate([*steps, np.zeros(2 * i.size, np.int64), step[rest] + 1])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = np.concatenate(found_a).astype(np.int64)
    b = np.concatenate(found_b).astype(np.int64)
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. n-1, left-aligned, and how many there are."""
    width = len(str(n))
    numbers = np.arange(n)
    count = np.ones(n, np.int64)
    for k in range(1, width):
        count += numbers >= 10**k
    out = np.zeros((n, width), np.uint8)
    for k in range(width):
        out[:, k] = 48 + (numbers // 10 ** np.maximum(count - 1 - k, 0)) % 10
    return out, count


class Aligner:
    """Tokenises and aligns texts; one for each task."""

    def __init__(self, folder: str):
        self.a, self.b = ByteLevel(f"{folder}/{A_FILE}"), Pieces(f"{folder}/{B_FILE}")
        self.a_len = np.array([len(p) for p in self.a.pieces], np.int64)
        self.b_len = np.array([len(p) for p in self.b.pieces], np.int64)
        self.digits, self.width = _digits(max(self.a_len.size, self.b_len.size))

    def _written(self, a_ids, b_ids, a_group, b_group, a_last, b_last):
        """Bytes of ``a,a|b,b;`` for all tokens, and the offset behind each group."""
        n_groups = a_last.size
        a_at = np.arange(a_ids.size) + np.concatenate([[0], b_last + 1])[a_group]
        b_at = np.arange(b_ids.size) + (a_last + 1)[b_group]
        ids = np.empty(a_ids.size + b_ids.size, np.int64)
        ids[a_at], ids[b_at] = a_ids, b_ids
        mark = np.full(ids.size, ord(","), np.uint8)
        mark[a_at[a_last]] = ord("|")
        mark[b_at[b_last]] = ord(";")
        width = self.width[ids]
        ends = np.cumsum(width + 1)
        out = np.empty(int(ends[-1]) if ids.size else 0, np.uint8)
        starts = ends - width - 1
        for k in range(int(width.max(initial=0))):
            some = width > k
            out[starts[some] + k] = self.digits[ids[some], k]
        out[ends - 1] = mark
        return out, (ends[b_at[b_last]] if n_groups else np.zeros(0, np.int64))

    def align(self, texts: list[str]) -> list[tuple | None]:
        """For each text, None if its tokens do not spell it, else (tokens of A,
        of B, groups, links, groups as bytes ending in ``;``, distinct pairs,
        links of each pair)."""
        spelt = [b" " + t.encode() for t in texts]
        a_lists, b_lists = self.a.encode([" " + t for t in texts]), self.b.encode(texts)
        good = [
            i for i, s in enumerate(spelt)
            if b"".join([self.a.pieces[k] for k in a_lists[i]]) == s
            and b"".join([self.b.pieces[k] for k in b_lists[i]]) == s
        ]
        out: list[tuple | None] = [None] * len(texts)
        if not good:
            return out
        a_ids, a_n, a_ends = _flat([a_lists[i] for i in good], self.a_len)
        b_ids, b_n, b_ends = _flat([b_lists[i] for i in good], self.b_len)
        a_hi, b_hi = np.cumsum(a_n), np.cumsum(b_n)
        cut_a, cut_b = shared_cuts(a_ends, b_ends, a_hi - a_n, a_hi, b_hi - b_n, b_hi)
        a_last = np.sort(np.concatenate([cut_a, a_hi - 1]))
        b_last = np.sort(np.concatenate([cut_b, b_hi - 1]))
        a_group = np.searchsorted(a_last, np.arange(a_ids.size))
        b_group = np.searchsorted(b_last, np.arange(b_ids.size))
        written, behind = self._written(a_ids, b_ids, a_group, b_group, a_last, b_last)
        # links: stretches between neighbouring ends, common ends once
        alone = np.ones(b_ends.size, bool)
        alone[b_last] = False
        ends = np.sort(np.concatenate([a_ends, b_ends[alone]]), kind="stable")
        link_a, link_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        text_of = np.searchsorted(a_hi, link_a, "right")
        pair = a_ids[link_a] * B_IDS + b_ids[link_b]
        groups = np.searchsorted(a_hi, a_last, "right")
        n_groups = np.bincount(groups, minlength=len(good))
        n_links = np.bincount(text_of, minlength=len(good))
        group_hi, link_hi = np.cumsum(n_groups), np.cumsum(n_links)
        byte_lo = 0
        for g, i in enumerate(good):
            byte_hi = int(behind[group_hi[g] - 1])
            pairs, times = np.unique(pair[link_hi[g] - n_links[g] : link_hi[g]], return_counts=True)
            out[i] = (int(a_n[g]), int(b_n[g]), int(n_groups[g]), int(n_links[g]), written[byte_lo:byte_hi].tobytes(),
                      pairs, times)
            byte_lo = byte_hi
        return out


class _Text:
    """Running result of one text over its pieces."""

    def __init__(self, doc_id):
        self.doc_id, self.ok, self.sums = doc_id, True, np.zeros(4, np.int64)
        self.sha, self.end, self.pairs, self.times = hashlib.sha256(), b"", [], []

    def add(self, piece) -> None:
        if piece is None:
            self.ok = False
        if not self.ok:
            return
        self.sums += np.array(piece[:4])
        self.sha.update(self.end + piece[4][:-1])
        self.end = b";"
        self.pairs.append(piece[5])
        self.times.append(piece[6])

    def done(self):
        if not self.ok or not self.pairs:
            return (self.doc_id, 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        pairs, times = self.pairs[0], self.times[0]
        if len(self.pairs) > 1:
            pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
            times = np.bincount(at, np.concatenate(self.times)).astype(np.int64)
        return (self.doc_id, *map(int, self.sums), self.sha.hexdigest(), pairs, times)


_DOC_FIELDS = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
               ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("docs", pa.list_(pa.struct([*_DOC_FIELDS, ("n_pairs", pa.int64())]))),
    ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32())), ("refs", pa.binary()), ("times", pa.binary()),
])
_BLOCK_SCHEMA = (
    "block long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, "
    "groups_sha256: string, n_pairs: long>>, pairs array<long>, holders array<int>, refs binary, times binary"
)


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, low bytes first; the size comes in front."""
    raw = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _block_row(number: int, texts: list) -> pa.RecordBatch:
    joined = np.concatenate([t[6] for t in texts])
    pairs, refs, holders = np.unique(joined, return_inverse=True, return_counts=True)
    # references ascend within a text; differences pack well
    lengths = np.array([t[6].size for t in texts])
    steps = np.diff(refs, prepend=0)
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    steps[first] = refs[first]
    docs = [dict(zip([n for n, _ in _DOC_FIELDS], t[:6]), n_pairs=int(t[6].size)) for t in texts]
    row = [[number], [docs], [pairs], [holders.astype(np.int32)], [_pack(steps)], [_pack(np.concatenate([t[7] for t in texts]))]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _BLOCK_ARROW)], schema=_BLOCK_ARROW)


def _make_blocks(folder: str, block_bytes: int, piece_chars: int):
    def run(batches):
        from pyspark import TaskContext

        aligner, number = None, TaskContext.get().partitionId() << 32
        waiting, open_, size, held = [], [], 0, 0

        def flush():
            nonlocal waiting, size, held
            results = aligner.align([p for _, p in waiting])
            for (text, _), r in zip(waiting, results):
                text.add(r)
                held += 0 if r is None else r[5].size
            waiting, size = [], 0

        def close():
            nonlocal open_, held, number
            row = _block_row(number, [t.done() for t in open_])
            open_, held, number = [], 0, number + 1
            return row

        for batch in batches:
            aligner = aligner or Aligner(folder)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now = _Text(doc_id)
                for piece in pieces_of(text, piece_chars) if text else ():
                    if now.ok:
                        waiting.append((now, piece))
                        size += len(piece) + 64
                    if size >= block_bytes:
                        flush()
                open_.append(now)
                if size >= block_bytes or held >= block_bytes // 4 or len(open_) >= 10_000:
                    if waiting:
                        flush()
                    yield close()
        if waiting:
            flush()
        if open_:
            yield close()

    return run


_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _score_block(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """Cogroup of one block with (place, holders in the corpus, best) of its pairs."""
    names = [n for n, _ in _DOC_FIELDS]
    out: dict[str, list] = {n: [] for n in [*names, "n_best", "count_sum"]}
    for row in blocks.to_pylist():
        n_pairs = np.array([d["n_pairs"] for d in row["docs"]], np.int64)
        total = int(n_pairs.sum())
        best = np.zeros(len(row["docs"]), np.int64)
        count_sum = np.zeros(len(row["docs"]), np.int64)
        if total:
            holders, is_best = np.zeros(row["size"], np.int64), np.zeros(row["size"], np.int64)
            place = counts.column("place").to_numpy()
            holders[place] = counts.column("total").to_numpy()
            is_best[place] = counts.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
            steps, times = _unpack(row["refs"]), _unpack(row["times"])
            text = np.repeat(np.arange(n_pairs.size), n_pairs)
            running = np.cumsum(steps)
            some = np.flatnonzero(n_pairs)
            first = (np.cumsum(n_pairs) - n_pairs)[some]
            base = np.zeros(n_pairs.size, np.int64)
            base[some] = running[first] - steps[first]
            refs = running - base[text]
            np.add.at(best, text, times * is_best[refs])
            np.add.at(count_sum, text, times * holders[refs])
        for n in names:
            out[n].extend(d[n] for d in row["docs"])
        out["n_best"].extend(best.tolist())
        out["count_sum"].extend(count_sum.tolist())
    types = dict(_DOC_FIELDS) | {"n_best": pa.int64(), "count_sum": pa.int64()}
    order = [c.split()[0] for c in _RESULT.split(", ")]
    return pa.table({n: pa.array(out[n], types[n]) for n in order})


def align_blocks(docs: DataFrame, folder: str = TOKENIZERS, block_bytes: int = BLOCK_BYTES,
                 piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Staged rows of blocks: the texts' own figures, the block's id pairs with
    the number of its texts that hold them, and the texts' references to them."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(ids.mapInArrow(_make_blocks(folder, block_bytes, piece_chars), _BLOCK_SCHEMA), "alignment")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a_id, b_id, total, best): how many documents hold the pair linked, and
    whether that is its A id's highest."""
    seen = (
        blocks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.holders").alias("total"))
    )
    a_id, b_id = F.floor(F.col("pair") / F.lit(B_IDS)).cast("long"), F.pmod(F.col("pair"), F.lit(B_IDS))
    top = seen.groupBy(a_id.alias("top_a")).agg(F.max("total").alias("highest"))
    met = seen.select("pair", a_id.alias("a_id"), b_id.alias("b_id"), "total").join(top, F.col("a_id") == F.col("top_a"))
    return met.select("pair", "a_id", "b_id", "total", (F.col("total") == F.col("highest")).alias("best"))


def align_documents(docs: DataFrame, folder: str = TOKENIZERS, block_bytes: int = BLOCK_BYTES,
                    piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    blocks = align_blocks(docs, folder, block_bytes, piece_chars)
    counts = pair_counts(blocks).select("pair", "total", "best")
    places = blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    own = places.join(counts, "pair").select("of", "place", "total", "best")
    texts = blocks.select("block", "docs", F.size("pairs").alias("size"), "refs", "times")
    return texts.groupBy("block").cogroup(own.groupBy("of")).applyInArrow(_score_block, _RESULT)
