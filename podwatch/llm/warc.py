"""WARC archives: writing with an index, and reading selected records back by byte ranges.

The index comes first: writing gives one row per record with its file, offset, length, URL and digest, and
that table is all that says which records exist. A task writes an archive of its own, named by its attempt;
only the attempt that Spark commits has its rows in the index, so what a lost executor half wrote is never
read. Reading starts from index rows: they are sorted by place, neighbours up to a gap are read as one
range, and the records are cut from it.

Archives lie wherever the folder's URL points and are opened through ``pyarrow.fs``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podwatch.llm.scratch import Scratch, partitions

LEVEL = 5
GAP_BYTES = 64 << 10
RANGE_BYTES = 4 << 20
TASK_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, record_type string, payload_digest string, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
_END = b"\r\n\r\n"


def digest_of(payload: bytes) -> str:
    """Upper-case base32 of the payload's SHA-1, without a label."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _field(text: str | None) -> str:
    """A header value is one line; what could end it is percent-encoded, and so is the percent sign."""
    return (text or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(field: str) -> str:
    return field.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One compressed record; a revisit has the HTTP head but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    raw = "\r\n".join(head).encode() + _END + block + _END
    return gzip.compress(raw, compresslevel=LEVEL, mtime=0)


def parsed(raw: bytes) -> tuple:
    """The columns of RECORD from one decompressed record; a response's digest is computed again and compared."""
    head, _, rest = raw.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(_END)
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page, url = _page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI")
    url = None if url is None else _plain(url)
    if fields["WARC-Type"] == "revisit":
        return page, url, "revisit", _page_of(fields["WARC-Refers-To"]), size, digest, None
    if len(payload) != size or digest_of(payload) != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    return page, url, "response", None, size, digest, payload


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [digest_of((x.as_py() or "").encode()) for x in batch.column("html")]
        yield batch.append_column("digest", pa.array(found, pa.string()))


def planned(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with digest, and with first: the page that the record repeats, if it does.

    Of equal payloads of at least ``least_bytes``, the one with the largest page_id is the response. The
    group's size does not matter: it is found by map-side maximum, and the join back is an ordinary one
    on the digest, whose large partitions adaptive execution splits.
    """
    kinds = "page_id long, url string, html string, digest string"
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    pages = pages.mapInArrow(_with_digest, kinds)
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes
    groups = pages.where(large).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    groups = groups.where("n > 1 and last is not null").select(F.col("digest").alias("same"), "last")
    joined = pages.join(groups, (F.col("digest") == F.col("same")) & large, "left")
    repeats = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "html", "digest", F.when(repeats, F.col("last")).alias("first"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str | None = None) -> DataFrame:
    """Writes every row of ``pages`` as a record under ``folder`` and returns the index, a table in that folder.

    A NULL html is an empty payload. A row with a NULL page_id is a response that no other row refers to,
    or a revisit. Rows that repeat the largest page_id of a payload are responses all. No page, no archive.
    """
    spark = pages.sparkSession
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    system, root = _opened(folder)
    system.create_dir(f"{root}/archives", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, at = None, 0
        name = f"{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            rows = []
            for page_id, url, html, digest, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first")), strict=True):
                data = record(page_id, url, (html or "").encode(), digest, first, first is not None, date)
                if sink is None:
                    disk, base = _opened(folder)
                    sink = disk.open_output_stream(f"{base}/archives/{name}", compression=None)
                sink.write(data)
                rows.append((page_id, url, "response" if first is None else "revisit", digest, name, at, len(data)))
                at += len(data)
            if rows:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in INDEX.split(", ")])
        if sink is not None:
            sink.close()

    planned(pages, least_bytes).mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(selected: DataFrame, folder: str) -> DataFrame:
    """The records (columns of RECORD) that the index rows ``selected`` name."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, base = _opened(folder)
        names = [f.split()[0] for f in RECORD.split(", ")]
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        source, opened = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            k = 0
            while k < len(places):
                name, begin, length = places[k]
                end, last = begin + length, k + 1
                while last < len(places) and places[last][0] == name and places[last][1] <= end + GAP_BYTES and places[last][1] + places[last][2] - begin <= RANGE_BYTES:
                    end = max(end, places[last][1] + places[last][2])
                    last += 1
                if name != opened:
                    if source is not None:
                        source.close()
                    source, opened = disk.open_input_file(f"{base}/archives/{name}"), name
                data = source.read_at(end - begin, begin)
                rows = [parsed(gzip.decompress(data[o - begin : o - begin + n])) for _, o, n in places[k:last]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                k = last
        if source is not None:
            source.close()

    places = selected.select("file", "offset", "length")
    # Index rows are tiny and what they stand for is not, so the number of tasks follows the bytes to read.
    total = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(partitions(selected.sparkSession), -(-total // TASK_BYTES))
    return places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` to fresh archives in the shared folder and reads all of them back."""
    folder = Scratch(pages.sparkSession, "warc").folder
    return read_records(write_archives(pages, folder, least_bytes), folder)
