"""WARC archives: a writer that deduplicates payloads and a salvage reader.

*Writing.*  Every record is one gzip member (as the format recommends), so a
damaged one costs no other.  Of the records with equal payloads of at least
``least_bytes`` bytes that with the smallest id is a ``response``; the others are
``revisit`` records, which name it and carry only the HTTP head.  Each task
writes files of about ``FILE_BYTES`` in the shared folder under a temporary name
and renames them when whole; a repeated task writes the same names again.  The
list of finished files is a small Parquet table.

*Reading.*  A file is read from front to back in bounded pieces.  Where a record
fails a check (member checksum, version line, header block, Content-Length,
closing line ends, block digest) the reader searches on from the byte after its
start for the next valid member, or in plain archives for the next version line,
goes on from there, and reports the bytes between as a quarantined gap with the
reason.  Of a damaged member whose head still unpacks nothing is given out.

Files are dealt to tasks one by one; a task holds one record at a time (up to
``MOST_BYTES``, more than a column can hold, so all that is written is read), and
while it searches a few pieces of ``PIECE`` bytes.

Null html is an empty payload, null urls and ids stay null.  Repeated rows are
records of their own (those with the smallest id all are responses; rows
without id always are).  An empty table writes no files and reads no records.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm._shared import shared_dir

FILE_BYTES = 64 << 20
PIECE = 1 << 20
MOST_BYTES = (1 << 31) + (1 << 20)      # a record: any payload that a column can hold, and its headers
VERSION = b"WARC/1.1"
VERSION_LINE = re.compile(rb"WARC/1\.\d")
MARKS = (b"\x1f\x8b\x08", b"WARC/1.")  # how members and plain records start
REPEATED = "warc-concurrent-to"         # the only field that a header block may hold twice
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest_column(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column, in SQL functions: five bytes
    are eight digits to the base 32."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", ALPHABET)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def deduplicated(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int = 0) -> DataFrame:
    """(id, url, payload, digest, refers_to): ``refers_to`` is the smallest id
    with that payload where it is another one.  Only digests are grouped; the
    join on them is one that Spark splits where a digest is very frequent."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload")) \
        .withColumn("digest", digest_column(F.col("payload")))
    first = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"))
    return rows.join(first, "digest", "left").select(
        "id", "url", "payload", "digest", F.when(F.col("id") > F.col("first"), F.col("first")).alias("refers_to"))


def record(record_id: str, kind: str, url: str | None, block: bytes, payload_digest: str,
           refers_to: str | None = None) -> bytes:
    """One whole record, uncompressed."""
    head = [VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_urn(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def page_record(page_id, url, payload: bytes, payload_digest: str, refers_to) -> bytes:
    """The record of a page: an HTTP head with the payload's full length, and the
    payload unless it is a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        return record(page_urn(page_id), "revisit", url, head, payload_digest, page_urn(refers_to))
    return record(page_urn(page_id), "response", url, head + payload, payload_digest)


def member(data: bytes) -> bytes:
    """``data`` as one gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str):
    from pyspark import TaskContext

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        number, out, name, size, records = 0, None, "", 0, 0
        done: list[tuple[str, int, int]] = []

        def finish():
            out.close()
            store.move(f"{root}/.{name}-{attempt}", f"{root}/{name}")
            done.append((name, records, size))
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for r in range(batch.num_rows):
                data = member(page_record(*(c[r].as_py() for c in columns)))
                if out is None:
                    name, size, records = f"part-{part:06d}-{number:04d}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/.{name}-{attempt}", compression=None)
                    number += 1
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= FILE_BYTES:
                    finish()
                    out = None
        if out is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64()),
                 pa.array([d[2] for d in done], pa.int64())], ["file", "records", "bytes"])
    return run


def write_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html", least_bytes: int = 0) -> str:
    """Write a record per row; returns the folder, whose ``files`` table lists
    the archives."""
    folder = folder or shared_dir(pages.sparkSession) + "/warc"
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{root}", recursive=True)
    deduplicated(pages, id_col, url_col, html_col, least_bytes).select("id", "url", "payload", "digest", "refers_to") \
        .mapInArrow(_writer(folder), "file string, records long, bytes long").write.parquet(f"{folder}/files")
    return folder


class Salvage:
    """Iterates over the records of one archive and collects its gaps.

    ``read(n)`` gives the next bytes.  ``records()`` yields (offset, length,
    headers, block); ``gaps`` holds (offset, length, reason)."""

    def __init__(self, read, most_bytes: int = MOST_BYTES):
        self.read, self.most = read, most_bytes
        self.data, self.base, self.ended = bytearray(), 0, False
        self.gaps: list[tuple[int, int, str]] = []

    def fill(self, upto: int) -> bool:
        """Have the bytes up to file offset ``upto`` in hand, if there are so many."""
        while not self.ended and self.base + len(self.data) < upto:
            more = self.read(max(PIECE, upto - self.base - len(self.data)))
            self.ended = not more
            self.data += more
        return self.base + len(self.data) >= upto

    def forget(self, before: int) -> None:
        if before - self.base > PIECE or before - self.base == len(self.data):
            del self.data[:before - self.base]
            self.base = before

    def find(self, what: bytes, at: int, most: int) -> int:
        """File offset of the next ``what`` in the ``most`` bytes from ``at`` on, or -1."""
        end = at + most
        while True:
            spot = self.data.find(what, at - self.base, end - self.base)
            if spot >= 0:
                return self.base + spot
            have = self.base + len(self.data)
            if self.ended or have >= end:
                return -1
            at = max(at, have - len(what) + 1)
            self.fill(min(end, have + PIECE))

    def unpack(self, at: int) -> tuple[bytes, int] | str:
        """The member at ``at`` and the offset after it, or what is wrong."""
        opened, out, here, step = zlib.decompressobj(31), bytearray(), at, 4096
        try:
            while not opened.eof:
                if not self.fill(here + 1):
                    return "member ends early"
                self.fill(here + step)
                piece = bytes(self.data[here - self.base:here - self.base + step])
                out += opened.decompress(piece, self.most + 1 - len(out))
                here += len(piece) - len(opened.unconsumed_tail)
                step = PIECE
                if len(out) > self.most:
                    return "member too large"
                if len(out) >= 5 and not out.startswith(b"WARC/"):
                    return "member is no record"
        except zlib.error:
            return "member fails its check"
        return bytes(out), here - len(opened.unused_data)

    @staticmethod
    def headers(head: bytes) -> dict[str, str] | None:
        """Fields of a header block (names in lower case), None if malformed."""
        lines = head.split(b"\r\n")
        if not VERSION_LINE.fullmatch(lines[0]):
            return None
        found: dict[str, str] = {}
        last = None
        for line in lines[1:]:
            if line[:1] in (b" ", b"\t") and last:
                found[last] += " " + line.strip().decode("utf-8", "replace")
                continue
            name, colon, value = line.partition(b":")
            last = name.strip().lower().decode("ascii", "replace")
            # a cut-off head that runs into the next record has its version line or its fields again
            if not colon or line.startswith(b"WARC/1.") or (last in found and last != REPEATED):
                return None
            found[last] = value.strip().decode("utf-8", "replace")
        return found

    def checked(self, head: dict[str, str] | None, block_of) -> tuple[bytes, int] | str:
        """The block and the offset after the record, or what is wrong."""
        if head is None or not {"warc-type", "warc-record-id"} <= head.keys():
            return "bad header block"
        if not head.get("content-length", "").isdigit() or int(head["content-length"]) > self.most:
            return "bad Content-Length"
        found = block_of(int(head["content-length"]))
        if isinstance(found, str):
            return found
        method, _, value = head.get("warc-block-digest", "").partition(":")
        if method == "sha1" and value != digest(found[0]):
            return "block fails its digest"
        return found

    def packed(self, at: int):
        """The record in the member at ``at``."""
        got = self.unpack(at)
        if isinstance(got, str):
            return got
        data, after = got
        end = data.find(b"\r\n\r\n")
        head = self.headers(data[:end]) if end >= 0 else None

        def block_of(size: int):
            body = data[end + 4:end + 4 + size]
            if data[end + 4 + size:] != b"\r\n\r\n" or len(body) != size:
                return "record does not fill its member"
            return body, after
        found = self.checked(head, block_of)
        return found if isinstance(found, str) else (head, *found)

    def plain(self, at: int):
        """The uncompressed record at ``at``."""
        end = self.find(b"\r\n\r\n", at, PIECE)
        if end < 0:
            return "header block does not end"
        head = self.headers(bytes(self.data[at - self.base:end - self.base]))

        def block_of(size: int):
            if not self.fill(end + 8 + size):
                return "record ends early"
            lo = end + 4 - self.base
            if self.data[lo + size:lo + size + 4] != b"\r\n\r\n":
                return "record does not end where it says"
            return bytes(self.data[lo:lo + size]), end + 8 + size
        found = self.checked(head, block_of)
        return found if isinstance(found, str) else (head, *found)

    def at(self, at: int):
        """(headers, block, offset after) of the record that starts here, or what is wrong."""
        self.fill(at + 5)
        start = bytes(self.data[at - self.base:at - self.base + 5])
        if start[:3] == b"\x1f\x8b\x08":
            return self.packed(at)
        if start == b"WARC/":
            return self.plain(at)
        return "no member or version line"

    def next_start(self, at: int) -> int:
        """Where a member or a version line may start next, or -1."""
        while True:
            spots = [s for s in (self.data.find(mark, at - self.base) for mark in MARKS) if s >= 0]
            if spots:
                return self.base + min(spots)
            if self.ended:
                return -1
            at = max(at, self.base + len(self.data) - max(map(len, MARKS)) + 1)
            self.forget(at)                 # what was searched is not needed again
            self.fill(self.base + len(self.data) + PIECE)

    def records(self) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
        at = 0
        lost, reason = -1, ""
        while self.fill(at + 1):
            got = self.at(at)
            if not isinstance(got, str):
                if lost >= 0:
                    self.gaps.append((lost, at - lost, reason))
                    lost = -1
                head, block, after = got
                yield at, after - at, head, block
                at = after
                self.forget(at)
                continue
            if lost < 0:
                lost, reason = at, got
            at = self.next_start(at + 1)
            if at < 0:
                break
            self.forget(at)
        if lost >= 0:
            self.gaps.append((lost, self.base + len(self.data) - lost, reason))


def http_payload(block: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and body of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in fields}, body


RECORDS = ("file string, offset long, length long, record_type string, record_id string, target_uri string, "
           "refers_to string, payload_digest string, payload_bytes long, payload binary, gap_reason string")


def _reader(folder: str):
    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    found = Salvage(source.read)
                    rows, size = [], 0
                    for offset, length, head, block in found.records():
                        http, body = http_payload(block)
                        full = int(http["content-length"]) if http.get("content-length", "").isdigit() else len(body)
                        rows.append((name, offset, length, head["warc-type"], head["warc-record-id"].strip("<>"),
                                     head.get("warc-target-uri"), head.get("warc-refers-to", "").strip("<>") or None,
                                     head.get("warc-payload-digest", "").rpartition(":")[2] or None, full,
                                     body if head["warc-type"] != "revisit" else None, None))
                        size += len(body)
                        if size > 4 * PIECE:
                            yield _batch(rows)
                            rows, size = [], 0
                    rows += [(name, at, n, "gap", None, None, None, None, None, None, why) for at, n, why in found.gaps]
                    if rows:
                        yield _batch(rows)
    return run


_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(),
          pa.int64(), pa.binary(), pa.string()]


def _batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    names = [part.strip().split(" ")[0] for part in RECORDS.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives listed in the folder's ``files`` table, and a
    row of type ``gap`` for each quarantined range of bytes."""
    files = spark.read.schema("file string, records long, bytes long").parquet(f"{folder}/files")
    return files.select("file").repartition(max(1, files.count())).mapInArrow(_reader(folder), RECORDS)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Per page record: page_id, payload_bytes, payload_digest, record_type,
    refers_to (page id).  The digest of a response is taken from its payload."""
    def page(urn: str) -> Column:
        return F.nullif(F.regexp_extract(urn, r"^urn:page:(-?\d+)$", 1), F.lit("")).cast("long")
    found = read_archives(spark, folder).where("record_type <> 'gap'")
    own = F.when(F.col("record_type") == "response", digest_column(F.col("payload"))).otherwise(F.col("payload_digest"))
    size = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")) \
        .otherwise(F.col("payload_bytes"))
    return found.select(page("record_id").alias("page_id"), size.alias("payload_bytes"), own.alias("payload_digest"),
                        "record_type", page("refers_to").alias("refers_to"))
