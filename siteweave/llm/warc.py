"""WARC: a writer with one gzip member per record, and a sequential reader.

The reader takes bytes in pieces, decompresses member after member incrementally, frames each record by its Content-Length,
and verifies the digest of every full payload. Archives are pieces of about ``ARCHIVE_BYTES`` payload, kept as rows of a
table in the shared folder, so that neither writing nor reading needs a local file; archives in files are read through
Spark's binaryFile source.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes, the one with the smallest id is a response with its
payload; the others are revisits, which hold the HTTP header, the digest and the length of the payload, but not the payload.

Defined results: null html is an empty payload; empty and short payloads are always responses; rows that repeat the smallest
id are responses too; any text can be an id, as ids are percent-encoded in their URNs; null ids have a URN of their own, and
are revisits where an equal payload has an id; an empty table gives an empty archive table; other columns of the pages play
no part.
"""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.recovery import cut

#: Smaller payloads are never revisits.
LEAST_REVISIT = 100
#: An archive is closed after so many payload bytes.
ARCHIVE_BYTES = 4_000_000
#: An exported file is closed before it gets longer.
FILE_BYTES = 1_000_000_000
#: The reader's piece.
PIECE = 1 << 16


class WarcError(ValueError):
    """An archive that is cut short, wrongly framed, or whose payload doesn't have its digest."""


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    def http(self) -> tuple[dict[str, str], bytes]:
        """Headers and payload of the HTTP message in the block."""
        head, mark, payload = self.block.partition(b"\r\n\r\n")
        if not mark:
            raise WarcError("an HTTP header without end")
        return _fields(head.split(b"\r\n")[1:]), payload


def _fields(lines: Iterable[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise WarcError(f"not a header: {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def _clean(value: str) -> str:
    """A header value stays on its line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


#: The URN of a row without an id.
NO_ID = "<urn:no-page>"


def _urn(page_id: str | None) -> str:
    return NO_ID if page_id is None else f"<urn:page:{quote(page_id, safe='')}>"


def _page_id(urn: str | None) -> str | None:
    return None if urn is None or urn == NO_ID else unquote(urn.removeprefix("<urn:page:").removesuffix(">"))


def write_record(record_id: str | None, url: str | None, payload: bytes, refers_to: str | None = None, level: int = 3) -> bytes:
    """A gzip member: a response, or a revisit of ``refers_to`` with the same payload."""
    digest = hashlib.sha256(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {_urn(record_id)}", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http if refers_to is not None else http + payload
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    return gz.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + gz.flush()


def read_records(pieces: Iterable[bytes]) -> Iterator[Record]:
    """The records of an archive whose bytes come in pieces of any size; holds one record at a time."""
    member, data, frame = None, bytearray(), None
    for piece in pieces:
        while piece:
            if member is None:
                member, data, frame = zlib.decompressobj(31), bytearray(), None
            try:
                data += member.decompress(piece)
            except zlib.error as e:
                raise WarcError(f"not a gzip member: {e}") from e
            if frame is None:
                frame = _frame(data)
            if frame and len(data) > frame[2] + 4:
                raise WarcError("a record is longer than its Content-Length")
            piece = member.unused_data
            if member.eof:
                yield _record(data, frame)
                member = None
    if member is not None:
        raise WarcError("the archive ends inside a record")


def _frame(data: bytearray) -> tuple[dict[str, str], int, int] | None:
    """Headers, and where the block begins and ends, as soon as the headers are there."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    first, *lines = bytes(data[:end]).split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise WarcError(f"not a WARC record: {first[:40]!r}")
    headers = _fields(lines)
    try:
        return headers, end + 4, end + 4 + int(headers["content-length"])
    except (KeyError, ValueError) as e:
        raise WarcError("a record without Content-Length") from e


def _record(data: bytearray, frame: tuple[dict[str, str], int, int] | None) -> Record:
    if frame is None:
        raise WarcError("a record without end of headers")
    headers, start, end = frame
    if bytes(data[end:]) != b"\r\n\r\n":
        raise WarcError("a record is not framed by its Content-Length")
    record = Record(headers, bytes(data[start:end]))
    kind, _, wanted = headers.get("warc-payload-digest", "").partition(":")
    if record.kind == "response" and kind == "sha256" and hashlib.sha256(record.http()[1]).hexdigest() != wanted:
        raise WarcError(f"{headers.get('warc-record-id')}: the payload doesn't have its digest")
    return record


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, __refers_to): the id that each row revisits, as text, or null.

    Only digests that occur again are joined back; html moves once, and a digest with very many rows is a skewed join side
    that adaptive execution splits.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", "html", F.when(F.length(payload) >= LEAST_REVISIT, F.sha2(payload, 256)).alias("__digest"))
    first = pages.where("__digest IS NOT NULL").groupBy("__digest").agg(F.min("page_id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    first = first.where("__n > 1 AND __first IS NOT NULL").drop("__n")
    again = pages.where("__digest IS NOT NULL").join(first, "__digest", "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("__first")), F.col("__first").cast("string"))
    short = pages.where("__digest IS NULL").select("page_id", "url", "html", F.lit(None).cast("string").alias("__refers_to"))  # these meet nobody
    return again.select("page_id", "url", "html", refers_to.alias("__refers_to")).unionByName(short)


def write_archives(pages: DataFrame) -> DataFrame:
    """(n_records, archive): every row of ``pages`` as a record of some archive, one after the other."""

    def archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, count, size = [], 0, 0
        for rows in batches:
            for page_id, url, html, refers_to in zip(rows["page_id"], rows["url"], rows["html"], rows["__refers_to"], strict=True):
                payload = (html or "").encode()
                done.append(write_record(page_id, url, payload, refers_to))
                count, size = count + 1, size + len(payload)
                if size >= ARCHIVE_BYTES:
                    yield pd.DataFrame({"n_records": [count], "archive": [b"".join(done)]})
                    done, count, size = [], 0, 0
        if done:
            yield pd.DataFrame({"n_records": [count], "archive": [b"".join(done)]})

    held = with_revisits(pages).withColumn("page_id", F.col("page_id").cast("string"))
    return held.mapInPandas(archives, "n_records long, archive binary")


def read_archives(archives: DataFrame, column: str = "archive") -> DataFrame:
    """(record_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of all records; payload null for revisits."""
    names = ["record_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for archive in rows[column]:
                out, size = [], 0
                for record in read_records(archive[i : i + PIECE] for i in range(0, len(archive), PIECE)):
                    http, payload = record.http()
                    full = record.kind == "response"
                    if not full and payload:
                        raise WarcError("a revisit with a payload")
                    ids = [_page_id(record.headers.get(h)) for h in ("warc-record-id", "warc-refers-to")]
                    if full and len(payload) != int(http["content-length"]):
                        raise WarcError(f"{ids[0]}: the payload is not as long as its HTTP header says")
                    out.append((ids[0], record.headers.get("warc-target-uri"), record.kind, int(http["content-length"]), record.headers["warc-payload-digest"].partition(":")[2], ids[1], payload if full else None))
                    size += len(payload)
                    if size >= ARCHIVE_BYTES:
                        yield pd.DataFrame(out, columns=names)
                        out, size = [], 0
                if out:
                    yield pd.DataFrame(out, columns=names)

    schema = "record_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"
    return archives.select(column).mapInPandas(records, schema)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``read_archives`` over .warc.gz files of any store that Spark reads. Spark hands a file over as one value, of 2 GB at most."""
    return read_archives(spark.read.format("binaryFile").load(path).select("content"), "content")


def write_files(archives: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> int:
    """The archives (from ``write_archives``) as ``part-00000.warc.gz`` and so on, in any store; the number of files.

    Members may follow one another, so a file is some archives in a row. An export: Python workers can't write to a store,
    so the bytes go through the driver, one archive at a time.
    """
    jvm = archives.sparkSession.sparkContext._jvm
    conf = archives.sparkSession.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    count, rows = 0, archives.select("archive").toLocalIterator()
    row = next(rows, None)
    while row is not None:
        with tempfile.NamedTemporaryFile(suffix=".warc.gz") as local:
            while row is not None and (not local.tell() or local.tell() + len(row.archive) <= file_bytes):
                local.write(row.archive)
                row = next(rows, None)
            local.flush()
            place = path(f"{folder}/part-{count:05d}.warc.gz")
            place.getFileSystem(conf).copyFromLocalFile(False, True, path(f"file://{local.name}"), place)
            count += 1
    return count


def round_trip(pages: DataFrame) -> DataFrame:
    """The records of ``pages``, written to archives in the shared folder and read back from there."""
    return read_archives(cut(write_archives(pages)))
