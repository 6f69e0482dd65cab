"""WARC archives: writing, the monolithic-gzip normaliser, reading by index.

Some crawlers compress a whole WARC file as one gzip stream, which can only be
read from its start. The normaliser inflates each such file once, as a stream,
and writes every record as a gzip member of its own, together with a sidecar
index of (offset, length) so that any record can be read alone.

Files live in a folder that all executors reach by URI through Arrow's file
systems (the checkpoint folder by default). Every task writes files under names
of its own and returns them as rows; only rows of tasks that Spark commits are
staged, so what a lost or repeated task leaves behind is never read. A file ends
when it has ``FILE_BYTES``; streams are copied in pieces of ``PIECE`` bytes, so
memory does not depend on the size of a file or of a payload.

Records whose payloads of at least ``MIN_REVISIT`` bytes are equal are written
once, as the response with the largest page_id; the others become revisit
records that name it, its digest and the payload's length.

Defined results: null html is an empty payload; rows that repeat the largest
page_id of a group are all responses; rows with null page_id come back as null,
never serve as the response of others, and revisit it if there is one. Control
characters in a url are percent-encoded in its header. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stage
from corpusmill.session import checkpoint_dir

MIN_REVISIT = 1000
FILE_BYTES = 32 << 20
PIECE = 1 << 16
RUN = 4000  # index rows one reading task takes at a time
DATE = "2024-01-01T00:00:00Z"
LEVEL = 3


def file_system(uri: str):
    """(file system, path) of a folder URI; a plain path is a local one."""
    return pafs.FileSystem.from_uri(uri if re.match(r"[a-z0-9]+:", uri) else f"file://{uri}")


# --- records ---------------------------------------------------------------

def _safe(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def record_bytes(page_id, url, kind, refers, digest: str, payload: bytes) -> tuple[bytes, bytes, bytes]:
    """(head, payload, tail) of a response or revisit record; ``digest`` in hex."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = payload if kind == "response" else b""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_safe(url)}", f"WARC-Payload-Digest: sha1:{b32}", f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    lines.append(f"Content-Length: {len(http) + len(body)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http, body, b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:] if ":" in x)}


class _Inflated:
    """Bytes of a gzip stream (one member or several), read in pieces."""

    def __init__(self, source):
        self.source, self.buffer, self.z, self.ended = source, b"", zlib.decompressobj(31), False

    def _more(self) -> bool:
        while not self.ended:
            raw = self.z.unused_data or self.source.read(PIECE)
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            if not raw:
                self.ended = True
                return False
            got = self.z.decompress(raw)
            if got:
                self.buffer += got
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``; None at the end of the stream."""
        at = self.buffer.find(mark)
        while at < 0:
            start = max(0, len(self.buffer) - len(mark))
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("the archive ends inside a record")
                return None
            at = self.buffer.find(mark, start)
        out, self.buffer = self.buffer[: at + len(mark)], self.buffer[at + len(mark) :]
        return out

    def pieces(self, n: int):
        while n:
            if not self.buffer and not self._more():
                raise ValueError("the archive ends inside a record")
            out, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(out)
            yield out


def normalise_stream(source, sink):
    """Read a monolithic archive from ``source`` once and write each record as
    its own gzip member to ``sink``. Yields (offset, length, head fields)."""
    stream, offset = _Inflated(source), 0
    while (block := stream.until(b"\r\n\r\n")) is not None:
        block = block.lstrip(b"\r\n")
        if not block:
            continue
        head = headers(block[:-4])
        z, length = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
        for piece in _record_pieces(block, stream, head):
            out = z.compress(piece)
            length += len(out)
            sink.write(out)
        out = z.flush()
        sink.write(out)
        length += len(out)
        stream.until(b"\r\n\r\n")
        yield offset, length, head
        offset += length


def _record_pieces(block, stream, head):
    yield block
    yield from stream.pieces(int(head["content-length"]))
    yield b"\r\n\r\n"


# --- jobs ------------------------------------------------------------------

def record_plan(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers): refers is the response's page_id for
    revisits. Groups are found on digests and lengths alone; only groups of more
    than one come back to the pages, as a staged table, so that one payload held
    by very many pages can be split in the join."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body")).withColumn(
        "digest", F.sha1("body"))
    thin = rows.select("page_id", "digest", F.octet_length("body").alias("n")).filter(F.col("n") >= MIN_REVISIT)
    last = thin.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("k")).filter("k > 1 AND last IS NOT NULL")
    last = stage(last.select(F.col("digest").alias("of"), "last"), "repeats")
    rows = rows.join(last, rows["digest"] == last["of"], "left").drop("of")
    return rows.withColumn("refers", F.when(F.coalesce(F.col("page_id") < F.col("last"), F.col("last").isNotNull()), F.col("last"))).drop("last")


def write_monolithic(plan: DataFrame, folder: str) -> DataFrame:
    """(file, records): archives of one gzip stream each."""

    def run(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        out = z = name = None
        n = size = 0

        def close():
            out.write(z.flush())
            out.close()
            return pd.DataFrame({"file": [name], "records": [n]})

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, z = fs.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                page, refers = (None if pd.isna(x) else int(x) for x in (r.page_id, r.refers))
                for part in record_bytes(page, r.url, "response" if refers is None else "revisit", refers, r.digest, bytes(r.body)):
                    out.write(z.compress(part))
                    size += len(part)
                n += 1
                if size >= FILE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    # ids as text: with nulls pandas would make them doubles
    text = lambda c: F.col(c).cast("string").alias(c)
    rows = plan.select(text("page_id"), "url", "digest", "body", text("refers"))
    return stage(rows.mapInPandas(run, "file string, records long"), "archives")


def normalise(files: DataFrame, source: str, target: str) -> DataFrame:
    """The sidecar index (file, at, offset, length, record_id, type) of the
    normalised archives. A file is one task's work: its stream has one start."""

    def run(batches):
        src, a = file_system(source)
        dst, b = file_system(target)
        dst.create_dir(b, recursive=True)
        for pdf in batches:
            for name in pdf["file"]:
                new = f"{uuid.uuid4().hex}.warc.gz"
                rows, n = [], 0
                with src.open_input_stream(f"{a}/{name}", compression=None) as f, dst.open_output_stream(f"{b}/{new}", compression=None) as g:
                    for offset, length, head in normalise_stream(f, g):
                        rows.append((new, n, offset, length, head["warc-record-id"], head["warc-type"]))
                        n += 1
                        if len(rows) == RUN:
                            yield pd.DataFrame(rows, columns=cols)
                            rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=cols)

    cols = ["file", "at", "offset", "length", "record_id", "type"]
    n = files.count()
    dealt = files.repartition(max(1, n), "file") if n else files
    return stage(dealt.mapInPandas(run, "file string, at long, offset long, length long, record_id string, type string"), "index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the
    indexed records, each read alone by its offset. A response's payload is
    measured and must have the digest its header names."""

    def run(batches):
        fs, root = file_system(folder)
        for pdf in batches:
            out = []
            for name, rows in pdf.groupby("file", sort=False):
                with fs.open_input_file(f"{root}/{name}") as f:
                    for offset, length in zip(rows["offset"], rows["length"], strict=True):
                        out.append(_read_one(f, int(offset), int(length)))
            yield pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    runs = index.select("file", "offset", "length").repartition(F.col("file"), F.floor(F.col("at") / RUN)).sortWithinPartitions("file", "offset")
    out = runs.mapInPandas(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return out.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


def _read_one(f, offset: int, length: int):
    f.seek(offset)
    stream = _Inflated(_Window(f, length))
    head = headers(stream.until(b"\r\n\r\n")[:-4])
    left = int(head["content-length"])
    http = stream.until(b"\r\n\r\n")
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    size, refers = int(head["x-payload-length"]), None
    if head["warc-type"] == "response":
        sha, size = hashlib.sha1(), 0
        for piece in stream.pieces(left - len(http)):
            sha.update(piece)
            size += len(piece)
        if sha.hexdigest() != digest:
            raise ValueError(f"{head['warc-record-id']}: payload and digest differ")
    else:
        refers = re.search(r"<urn:page:(-?\d+)>", head["warc-refers-to"])[1]
    page = re.fullmatch(r"<urn:page:(-?\d*)>", head["warc-record-id"])[1]
    return page or None, size, digest, head["warc-type"], refers


class _Window:
    """The next ``n`` bytes of an open file."""

    def __init__(self, f, n):
        self.f, self.left = f, n

    def read(self, n):
        out = self.f.read(min(n, self.left))
        self.left -= len(out)
        return out


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them, and read every
    record back by the index."""
    folder = folder or f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/corpusmill-warc-{uuid.uuid4().hex}"
    files = write_monolithic(record_plan(pages), f"{folder}/monolithic")
    index = normalise(files, f"{folder}/monolithic", f"{folder}/normalised")
    return read_records(index, f"{folder}/normalised")
