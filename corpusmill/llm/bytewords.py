"""Words of UTF-8 texts as 64-bit hashes, a whole Arrow batch at a time.

Both word patterns used by the operators treat every non-ASCII character
alike, so words are maximal runs of allowed *bytes*; numpy finds them without
a Python loop over words. A word's hash depends only on its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEGMENT = 250_000  # bytes hashed at once; bounds the working arrays, 50 bytes for each

_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _lut(is_word):
    return np.array([bool(is_word(b)) for b in range(256)])


#: ``[^\x20\x09-\x0D]+``
SPACED = _lut(lambda b: b not in _SPACES)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = _lut(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint64)

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    a = np.full(n, base, dtype=np.uint64)
    a[0] = 1
    return np.multiply.accumulate(a)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (wraps modulo 2^64)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(batches, rows: int = 500):
    """Record batches of at most ``rows`` rows, so that a worker's arrays hold the
    words of a few hundred texts at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


class WordHasher:
    """Word hashes of string columns under one byte class."""

    def __init__(self, is_word: np.ndarray):
        self.is_word = is_word
        self.pow = self.inv = np.zeros(0, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if self.pow.size < n:
            self.pow, self.inv = _powers(_P, n), _powers(_PINV, n)

    def _segment(self, data: np.ndarray, doc_starts: np.ndarray):
        """(hashes, start byte) of the words of one segment; ``doc_starts``
        are positions inside it where a new text begins."""
        n = data.size
        word = self.is_word[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = doc_starts[(doc_starts > 0) & (doc_starts < n)]
        first[inner] = word[inner]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[inner - 1] = word[inner - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        self._grow(n + 1)
        acc = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((LOWER[data] + np.uint64(1)) * self.pow[:n], out=acc[1:])
        h = (acc[e] - acc[s]) * self.inv[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(h), s

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, offsets: words of row i are
        ``hashes[offsets[i]:offsets[i+1]]``). Null counts as empty."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if column.null_count:
            column = column.fill_null("")
        column = column.cast(pa.large_string())
        n = len(column)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(1, np.int64)
        bufs = column.buffers()
        offs = np.frombuffer(bufs[1], dtype=np.int64)[column.offset : column.offset + n + 1]
        base, total = int(offs[0]), int(offs[-1] - offs[0])
        if total == 0:
            return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
        data = np.frombuffer(bufs[2], dtype=np.uint8)[base : base + total]
        offs = offs - base
        hs, ss, lo = [], [], 0
        while lo < total:
            hi = min(total, lo + SEGMENT)
            if hi < total:  # end the segment where no word goes on
                hi = self._cut(data, offs, lo, hi, total)
            inside = offs[np.searchsorted(offs, lo, "left") : np.searchsorted(offs, hi, "right")] - lo
            h, s = self._segment(data[lo:hi], inside)
            hs.append(h)
            ss.append(s + lo)
            lo = hi
        h, s = np.concatenate(hs), np.concatenate(ss)
        return h, np.searchsorted(s, offs, "left")

    def _cut(self, data, offs, lo, hi, total):
        k = int(np.searchsorted(offs, hi, "right")) - 1
        if offs[k] > lo:
            return int(offs[k])  # a text begins here
        end = int(offs[k + 1]) if k + 1 < offs.size else total
        step = hi
        while step < end:  # inside one very long text: go on to its next gap
            nxt = min(end, step + SEGMENT)
            gap = np.flatnonzero(~self.is_word[data[step:nxt]])
            if gap.size:
                return step + int(gap[0]) + 1
            step = nxt
        return end


_Q = 0xA24BAED4963EE407 | 1
_QINV = pow(_Q, -1, 1 << 64)
_GRAM_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width``-word shingles of one text, in order. A text with
    fewer words has its whole sequence as one shingle; none without words.

    A shingle is a polynomial in its words' hashes, taken as a difference of
    running sums, so the cost does not depend on the width."""
    n = words.size
    if n == 0:
        return words
    if _GRAM_POWERS[0].size < n:
        _GRAM_POWERS[:] = _powers(_Q, 2 * n), _powers(_QINV, 2 * n)
    power, inverse = _GRAM_POWERS
    w = min(n, width)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power[:n], out=acc[1:])
    out = (acc[w:] - acc[: n - w + 1]) * inverse[: n - w + 1]
    return mix(out + np.uint64((w * 0xD6E8FEB86659FD93) & ((1 << 64) - 1)))
