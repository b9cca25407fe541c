"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

Writing. Pages are dealt out; each task writes archives of about ``ARCHIVE`` bytes to a shared folder, under names of its own attempt.
The manifest lists those of the attempts that Spark took, so what a lost or repeated task has left is never read. Of pages with equal payloads of ``LEAST`` bytes or
more, those with the largest page_id are response records; the others are revisit records without a body, which name it.

Reading. A task opens an archive as a stream and inflates it piece by piece with one zlib object per member. Header blocks end at the
first empty line; the body is framed by Content-Length, and two line ends close a record. Block and payload digests are
verified while the bytes pass; a mismatch, a truncated member or a malformed record raises an error that names the archive and offset.

Defined results. A null html is an empty payload. Pages without page_id are response records (``page_id`` null) and revisit nothing.
Rows repeated with the largest page_id are all responses. A null url leaves the target header out; line ends in a url are
percent-encoded. An empty table gives no archives and no rows. Other columns are not looked at.

At scale. Payloads are shuffled once. The largest page_id of a payload is found by partial aggregation on its digest, and joined back over
salted keys, so a payload that a third of the pages share is spread. Readers hold one header block and one piece. The manifest
(one row an archive) is a table, not a list on the driver.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import folder, small_batches, stored

ARCHIVE, LEAST, PIECE, SALTS = 32 << 20, 1000, 1 << 16, 16
READERS = 10_000  # tasks that read at most; more archives share them
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_OUT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _store(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder's address; a path without scheme is local."""
    if "://" not in uri and not uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    block = _HTTP % len(payload) + (payload if refers_to is None else b"")
    name = "none" if page_id is None else page_id
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: {_digest(payload)}", f"WARC-Block-Digest: {_digest(block)}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return deflate.compress(head) + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


class Malformed(ValueError):
    """An archive that breaks its format."""


class _Record:
    """Takes the inflated bytes of one record; keeps the header block and digests only."""

    def __init__(self) -> None:
        self.head, self.fields, self.left, self.tail = bytearray(), None, 0, bytearray()
        self.block, self.payload, self.http, self.size = hashlib.sha1(), hashlib.sha1(), bytearray(), None

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                return
            data = bytes(self.head[end + 4 :])
            version, *lines = self.head[:end].decode().split("\r\n")
            if not version.startswith("WARC/"):
                raise Malformed(f"version line {version[:40]!r}")
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            self.left = int(self.fields["content-length"])
        body, rest = data[: self.left], data[self.left :]
        self.left -= len(body)
        self.block.update(body)
        if self.size is None:
            self.http += body
            end = self.http.find(b"\r\n\r\n")
            if end >= 0:
                body, self.size = bytes(self.http[end + 4 :]), 0
        if self.size is not None:
            self.payload.update(body)
            self.size += len(body)
        self.tail += rest

    def close(self) -> dict[str, str]:
        if self.fields is None or self.left or bytes(self.tail) != b"\r\n\r\n":
            raise Malformed("a record does not fill its frame")
        checks = [("warc-block-digest", self.block)]
        if self.fields["warc-type"] == "response":
            checks.append(("warc-payload-digest", self.payload))
            if self.size != int(self.fields["x-payload-length"]):
                raise Malformed("payload length")
        for name, seen in checks:
            if self.fields[name] != "sha1:" + base64.b32encode(seen.digest()).decode():
                raise Malformed(f"{name} of {self.fields['warc-record-id']}")
        return self.fields


def records(read: Callable[[int], bytes], name: str = "archive") -> Iterator[dict[str, str]]:
    """Header fields of the verified records of an archive, read in pieces."""
    offset, data = 0, read(PIECE)
    while data:
        inflate, one, start = zlib.decompressobj(31), _Record(), offset
        try:
            while not inflate.eof:
                if not data:
                    raise Malformed("truncated member")
                before = len(data)
                one.feed(inflate.decompress(data, PIECE))
                data = inflate.unconsumed_tail or inflate.unused_data
                offset += before - len(data)
                if not data and not inflate.eof:
                    data = read(PIECE)
            fields = one.close()
        except (Malformed, zlib.error, KeyError, ValueError) as problem:
            raise Malformed(f"{name}, record at byte {start}: {problem!r}") from problem
        yield fields
        data = data or read(PIECE)


def _writing(where: str):
    """Archives of a partition; a row for each."""

    def run(batches):
        store, base = _store(where)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        out, size, count, number = None, 0, 0, 0

        def name() -> str:
            return f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{number:06d}.warc.gz"

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name()], "n": pa.array([count], pa.int64())})

        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns, strict=True):
                if out is None:
                    out, size, count = store.open_output_stream(f"{base}/{name()}", compression=None), 0, 0
                member = record(page_id.as_py(), url.as_py(), (html.as_py() or "").encode(), refers_to.as_py())
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= ARCHIVE:
                    yield closed()
                    out, number = None, number + 1
        if out is not None:
            yield closed()

    return run


def _page(urn: str | None) -> int | None:
    number = urn.rpartition(":")[2].rstrip(">") if urn else "none"
    return None if number == "none" else int(number)


def _reading(where: str):
    def run(batches):
        store, base = _store(where)
        for batch in batches:
            for archive, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, seen = [], 0
                with store.open_input_stream(f"{base}/{archive}", compression=None) as stream:
                    for f in records(stream.read, archive):
                        seen += 1
                        digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                        rows.append((_page(f["warc-record-id"]), int(f["x-payload-length"]), digest, f["warc-type"], _page(f.get("warc-refers-to"))))
                        if len(rows) >= 10_000:
                            yield _batch(rows)
                            rows = []
                if seen != expected:
                    raise Malformed(f"{archive}: {seen} records of {expected}")
                yield _batch(rows)

    def _batch(rows):
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
            names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return run


def with_references(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html and the page_id that a revisit refers to (null for responses)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = pages.withColumn("key", F.when(
        (F.octet_length("html") >= least) & F.col("page_id").isNotNull(), F.sha2(F.encode("html", "UTF-8"), 256)))
    repeated = keyed.where("key is not null").groupBy("key").agg(
        F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to").select("key", "refers_to")
    salted = repeated.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # rows without a key are spread by their ids
    left = keyed.withColumn("salt", F.expr(f"pmod(xxhash64(page_id), {SALTS})").cast("int")).withColumn(
        "key", F.coalesce("key", F.concat(F.lit("-"), F.xxhash64("page_id", "url", "html").cast("string"))))
    joined = left.join(salted, ["key", "salt"], "left")
    return joined.select("page_id", "url", "html", F.when(F.col("refers_to") > F.col("page_id"), F.col("refers_to")).alias("refers_to"))


def write_archives(pages: DataFrame, where: str, least: int = LEAST) -> DataFrame:
    """Write every page into archives under ``where``; archive and number of records of each."""
    manifest = with_references(pages, least).mapInArrow(_writing(where), "archive string, n long")
    return stored(manifest, "manifest", folder(pages.sparkSession))


def read_archives(manifest: DataFrame, where: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record of the archives."""
    # the number is given, as the few bytes of the manifest would else be merged into one task
    readers = max(min(manifest.count(), READERS), 1)
    return manifest.select("archive", "n").repartition(readers, "archive").mapInArrow(_reading(where), _OUT)


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write the pages into archives in the shared folder and read them back."""
    small_batches(pages.sparkSession)
    where = f"{folder(pages.sparkSession)}/archives"
    return read_archives(write_archives(pages, where, least), where)
