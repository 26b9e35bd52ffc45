"""WARC archives: writing, normalising whole-file gzip, and reading through an index.

Crawlers often leave an archive as one gzip stream, in which no record can be reached without
inflating all before it. The normaliser inflates such a stream once, front to back, writes
every record as a gzip member of its own and notes each member's place in a sidecar index;
on the way it turns records whose payload another record holds into revisits. Afterwards any
record is one seek and one small inflation away.

Archives and sidecars lie in the shared folder. File names carry the task attempt, and only
files named in a finished job's rows are used, so tasks can fail and run again.
"""

from __future__ import annotations

import gzip
import io
import hashlib
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import durable, python_ready, quoted
from panelkit.session import work_folder

ARCHIVE_BYTES = 32 << 20  # payload after which a task begins another archive
ARCHIVE_RECORDS = 20_000
LEAST_REVISIT = 1_000  # bytes of payload from which equal payloads are stored once
DATE = "1970-01-01T00:00:00Z"  # the tables have no fetch time

_RECORDS = "path string, n bigint, page_id bigint, payload_bytes bigint, payload_digest string"
_FILES = "path string, index string, records bigint"
_PAGES = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _id_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(kind: str, page_id, url: str, size: int, digest: str, payload: bytes, refers_to=None) -> bytes:
    """One WARC record, with HTTP headers before the payload; a revisit has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', '', url or '')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(http) + len(payload)}",
    ]
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(refers_to)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def records_in(stream):
    """``(headers, HTTP headers, payload)`` of each record of an inflated stream."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            key, _, value = line.decode().partition(":")
            headers[key.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record has no end")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield headers, http, payload


# --- tasks -------------------------------------------------------------------


def _writer(folder: str):
    """Writes a task's pages as whole-file gzip archives and returns a row per record."""

    def run(batches):
        context = TaskContext.get()
        stem = f"{folder}/raw/{context.partitionId():06d}-{context.taskAttemptId()}"
        out = sink = None
        path, rows, size, files = "", [], 0, 0
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(i) for i in range(3))):
                if out is None:
                    path = f"{stem}-{files:04d}.warc.gz"
                    place, name = _place(path)
                    sink = place.open_output_stream(name, compression=None)
                    out = gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=1, mtime=0)
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                digest = hashlib.sha1(payload).hexdigest()
                out.write(record("response", page_id.as_py(), url.as_py(), len(payload), digest, payload))
                rows.append((path, len(rows), page_id.as_py(), len(payload), digest))
                size += len(payload)
                if size >= ARCHIVE_BYTES or len(rows) >= ARCHIVE_RECORDS:
                    out.close(), sink.close()
                    yield _rows(rows, _RECORDS)
                    out, rows, size, files = None, [], 0, files + 1
        if out is not None:
            out.close(), sink.close()
            yield _rows(rows, _RECORDS)

    return run


_ARROW = {"string": pa.string(), "bigint": pa.int64()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)], [f[0] for f in fields]
    )


def normalise(source: str, target: str, index: str, revisits: dict[int, int]) -> int:
    """Rewrite one whole-file gzip archive with a member per record, and its sidecar.

    ``revisits`` maps a record's number in the archive to the page that holds its payload.
    The sidecar has a line of JSON per record: place and length of its member, page,
    payload size. Memory is one record. Returns the number of records.
    """
    place, name = _place(source)
    to, to_name = _place(target)
    side, side_name = _place(index)
    at = n = 0
    with (
        place.open_input_stream(name, compression="gzip") as inflated,
        to.open_output_stream(to_name, compression=None) as out,
        side.open_output_stream(side_name, compression=None) as notes,
    ):
        stream = io.BufferedReader(inflated, 1 << 20)
        for n, (headers, _, payload) in enumerate(records_in(stream), 1):
            page = _id_of(headers["warc-record-id"])
            digest = headers["warc-payload-digest"].partition(":")[2]
            url = headers.get("warc-target-uri", "")
            if n - 1 in revisits:
                whole = record("revisit", page, url, len(payload), digest, b"", revisits[n - 1])
            else:
                whole = record("response", page, url, len(payload), digest, payload)
            member = gzip.compress(whole, compresslevel=5, mtime=0)
            out.write(member)
            notes.write((json.dumps([at, len(member), page, len(payload)]) + "\n").encode())
            at += len(member)
    return n


def _normaliser(folder: str):
    def run(batches):
        context = TaskContext.get()
        for batch in batches:
            for source, numbers, holders in zip(*(batch.column(i).to_pylist() for i in range(3))):
                stem = source.rpartition("/")[2].removesuffix(".warc.gz")
                target = f"{folder}/{stem}-{context.taskAttemptId()}.warc.gz"
                n = normalise(source, target, f"{target}.idx", dict(zip(numbers or [], holders or [])))
                yield _rows([(target, f"{target}.idx", n)], _FILES)

    return run


def _reader(batches):
    """Every record of the named archives, reached through the sidecars."""
    for batch in batches:
        for path, index in zip(*(batch.column(i).to_pylist() for i in range(2))):
            side, side_name = _place(index)
            with side.open_input_stream(side_name, compression=None) as notes:
                entries = [json.loads(x) for x in notes.read().decode().splitlines()]
            place, name = _place(path)
            rows = []
            with place.open_input_file(name) as archive:
                for at, length, _, size in entries:
                    rows.append(_page(archive.read_at(length, at), size))
            yield _rows(rows, _PAGES)


def _page(member: bytes, size: int) -> tuple:
    [(headers, http, payload)] = records_in(io.BytesIO(zlib.decompress(member, 31)))
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].partition(":")[2]
    told = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
    if told != size or kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a record differs from its headers or the index")
    return _id_of(headers["warc-record-id"]), size, digest, kind, _id_of(headers.get("warc-refers-to"))


# --- operator -----------------------------------------------------------------


def write_archives(
    df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``path, index, records``: normalised archives of all rows and their sidecars.

    Each task first leaves whole-file gzip archives; the normaliser rewrites them. Of records
    with equal payloads of ``LEAST_REVISIT`` bytes or more the one with the largest page
    id stays a response, and those with other ids become revisits of it. Payloads are never
    shuffled, only their digests, combined per digest before that. The first archives are
    deleted once the job that read them has finished.

    A NULL payload is empty. A row without an id is written, and may be a revisit. Rows that
    repeat the largest id are all responses. An empty table gives no archive; other columns
    are not read.
    """
    spark = df.sparkSession
    python_ready(spark)
    folder = f"{work_folder(spark)}/warc-{uuid.uuid4().hex}"
    place, name = _place(f"{folder}/raw")
    place.create_dir(name, recursive=True)
    slim = df.select(
        quoted(page_id).cast("long").alias("page_id"), quoted(url).alias("url"), quoted(html).alias("html")
    )
    records = durable(slim.mapInArrow(_writer(folder), _RECORDS))
    holders = records.filter(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest")
    holders = holders.agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    again = records.filter(F.col("payload_bytes") >= LEAST_REVISIT).join(holders, "payload_digest")
    again = again.filter(~F.col("page_id").eqNullSafe(F.col("holder")) & F.col("holder").isNotNull())
    listed = again.groupBy("path").agg(F.collect_list(F.struct("n", "holder")).alias("revisits"))
    work = records.select("path").distinct().join(listed, "path", "left")
    work = work.select("path", F.col("revisits.n").alias("n"), F.col("revisits.holder").alias("holder"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a given number is not coalesced
    # by another hash than that of the join before, which would count as this exchange already
    done = durable(work.repartition(parts, F.xxhash64("path")).mapInArrow(_normaliser(folder), _FILES))
    place.delete_dir(name)
    return done


def read_archives(files: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record.

    Payload sizes and digests are checked against the payloads on the way.
    """
    python_ready(files.sparkSession)
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = files.select("path", "index").repartition(parts, "path")
    return spread.mapInArrow(_reader, _PAGES)
