"""Secret scan: three fixed patterns and a token-efficiency test.

A run of key-like characters is random when a byte-pair vocabulary trained on
ordinary text needs many tokens for it: few characters per token. The whole run
is judged, and if it is not random, each stretch of parts between separators
that have few characters per token themselves, so a path before a key does not
hide it. Numbers and what has the form of a known digest or UUID are left out.
Letters alone, with separators and up to four digits at the end, are identifiers
if the words that separators and capitals part have enough characters per token.
What lies inside a pattern's span is not reported twice.

Every text is scanned whole, in its own row; nothing is shuffled. The
vocabulary file is read once on the driver and broadcast (its size is that of
the file, checked against ``MAX_VOCABULARY``). Long runs are tokenised in pieces
of ``PIECE`` characters, since the merge is not linear in a piece's length.

Defined results: null text counts as empty; empty texts have no spans. Rows are
independent: repeated rows give repeated results, null ids come back as null.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY = 32 << 20
#: Letters, digits and the rest are tokenised apart.
PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+"
MIN_RUN, MAX_RATIO, PIECE = 16, 2.0, 128
KINDS = ("assign", "access", "hex", "random")

# fixed patterns and least lengths
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, ACCESS_MIN = r"AKIA[A-Z0-9]+", 20
HEX_MIN = 24
ASSIGN_MIN = 6

_RUN = rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"
#: Digests (MD5, SHA-1, SHA-2 in hex), UUIDs, numbers, dates.
_KNOWN = (
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})"
    r"|(?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[0-9+/_=-]+"
)
_IDENTIFIER = r"[-_/=+]*[A-Za-z]+(?:[-_/=+]+[A-Za-z]+)*[-_/=+]*(?:[0-9]{1,4})?"
_WORD = r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])"
_PART = r"[A-Za-z0-9]+"


class Scanner:
    """Spans of one text. ``count``: number of tokens of a string."""

    def __init__(self, count):
        self.count = count
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(rf"[0-9a-f]{{{HEX_MIN},}}")
        self.run = re.compile(_RUN)
        self.known = re.compile(_KNOWN)
        self.identifier = re.compile(_IDENTIFIER)
        self.word = re.compile(_WORD)
        self.part = re.compile(_PART)

    def base(self, text: str) -> list[tuple[int, int, int]]:
        found = [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if len(m[2]) >= ASSIGN_MIN]
        found += [(m.start(), 1, m.end()) for m in self.access.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
        found += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        return sorted(found)

    def few(self, run: str) -> bool:
        """True if the run has few characters per token."""
        return len(run) < MAX_RATIO * sum(self.count(run[i : i + PIECE]) for i in range(0, len(run), PIECE))

    def wordy(self, run: str) -> bool:
        """True of an identifier made of words; parts of one letter say nothing."""
        if not self.identifier.fullmatch(run):
            return False
        parts = [x for x in re.findall("[A-Za-z]+", run) if len(x) > 1]
        if len(parts) == 1 and not self.few(parts[0]):
            return True
        words = [w.lower()[i : i + PIECE] for x in parts for w in self.word.findall(x) for i in range(0, len(w), PIECE)]
        return sum(map(len, words)) >= MAX_RATIO * sum(map(self.count, words))

    def dealt(self, run: str) -> bool:
        return not self.known.fullmatch(run) and self.few(run) and not self.wordy(run)

    def random(self, text: str, base) -> list[tuple[int, int, int]]:
        out = []
        # of the base spans that begin no later, the one that reaches furthest
        starts, reach = [a for a, _, _ in base], [0, *accumulate((b for _, _, b in base), max)]
        for m in self.run.finditer(text):
            s, e = m.span()
            if self.known.fullmatch(m[0]):
                continue
            spans = [(s, e)] if self.dealt(m[0]) else self.stretches(m[0], s)
            out += [(i, 3, j) for i, j in spans if j > reach[bisect_right(starts, i)]]
        return out

    def stretches(self, run: str, at: int) -> list[tuple[int, int]]:
        """Spans of adjoining parts with few characters per token, if random."""
        found = []
        for m in self.part.finditer(run):
            if not self.few(m[0]) or self.wordy(m[0]):
                continue
            if found and not self.part.search(run, found[-1][1], m.start()):
                found[-1][1] = m.end()
            else:
                found.append([m.start(), m.end()])
        return [(at + i, at + j) for i, j in found if j - i >= MIN_RUN and self.dealt(run[i:j])]


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def token_counter(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    coder = tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda s: len(coder.encode_ordinary(s))


def scan_secrets(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random), one row
    for each input row."""
    if os.path.getsize(vocabulary) > MAX_VOCABULARY:
        raise ValueError(f"{vocabulary} is too large to broadcast")
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        counters = []

        def count(s):  # the vocabulary is loaded when a task meets its first candidate
            if not counters:
                counters.append(token_counter(sent.value))
            return counters[0](s)

        scanner = Scanner(count)
        for b in batches:
            cols = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": [], "n_random": []}
            for x in b.column("text"):
                text = x.as_py() or ""
                base = scanner.base(text)
                more = scanner.random(text, base)
                for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                    cols[name].append(sum(s[1] == k for s in base))
                cols["base_sha256"].append(hashlib.sha256(_written(base).encode()).hexdigest())
                cols["spans"].append(_written(sorted(base + more)))
                cols["n_random"].append(len(more))
            types = {"base_sha256": pa.string(), "spans": pa.string()}
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(v, types.get(k, pa.int64())) for k, v in cols.items()]], ["doc_id", *cols])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")
