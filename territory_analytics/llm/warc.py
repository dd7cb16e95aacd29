"""WARC archives through a table of chunks.

A payload travels as rows (record, chunk number, bytes): no row, no batch and no buffer holds an
oversized payload as a whole once it is cut.  Every chunk that is read carries the digest of the payload
up to and with it, and the last chunk that of the whole.  A chunk that is written carries the digest of
the whole payload, which the writer compares with that of the chunks at the end.

Written archives are gzip files of one member per record.  Of records with equal payloads one is a
``response``; the others are ``revisit`` records, which repeat its digest and length and refer to it.
Reading turns an archive into the same table of chunks again, in one pass.
"""

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..storage import durable, scratch_path
from .common import small_batches, table
from .files import create, open_file

CHUNK_BYTES = 64 << 10
#: A task goes on with a new archive after so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Payloads of fewer bytes are always written out.
LEAST_REVISIT_BYTES = 0
DATE = "2026-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# --- Roles and chunks ----------------------------------------------------------------------------


def with_roles(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = LEAST_REVISIT_BYTES
) -> DataFrame:
    """``record``, ``url``, ``payload``, ``payload_bytes``, ``is_revisit``, ``refers_to``.

    Payloads are equal if length and SHA-256 agree.  Among equal ones of at least ``least_bytes`` the
    largest id is the response (every row with that id, if rows repeat); the others revisit it.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("record"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "content": F.unhex(F.sha2("payload", 256))})
    # Counted with copies combined before the shuffle; only payloads that occur more than once remain.
    groups = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("content", "payload_bytes").agg(
        F.max("record").alias("keep"), F.count("*").alias("copies")
    )
    shared = durable(groups.where("copies > 1").drop("copies").withColumn("is_shared", F.lit(True)))
    joined = rows.join(shared, ["content", "payload_bytes"], "left")
    is_revisit = F.coalesce("is_shared", F.lit(False)) & ~F.col("record").eqNullSafe(F.col("keep"))
    return joined.select(
        "record", "url", "payload", "payload_bytes", is_revisit.alias("is_revisit"),
        F.when(is_revisit, F.col("keep")).alias("refers_to"),
        F.sha1("payload").alias("sha1"),
    )


def chunked(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Records as chunk rows: ``chunk_no`` from 0, ``data``, and ``last`` on the final one.

    Every record has at least one row; a revisit has one row without data.  The rows of a record follow
    each other in one partition.
    """
    size = F.when(F.col("is_revisit"), 0).otherwise(F.col("payload_bytes"))
    count = F.greatest(F.lit(1), F.ceil(size / chunk_bytes)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda k: F.when(~F.col("is_revisit"), F.substring(F.col("payload"), k * chunk_bytes + 1, F.lit(chunk_bytes))),
    )
    others = [c for c in records.columns if c != "payload"]
    rows = records.select(*others, count.alias("chunks"), F.posexplode(pieces).alias("chunk_no", "data"))
    return rows.withColumn("last", F.col("chunk_no") == F.col("chunks") - 1).drop("chunks")


# --- Writing -------------------------------------------------------------------------------------


def _urn(record: int | None) -> str:
    return f"<urn:page:{'' if record is None else record}>"


def _record_of(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


class ArchiveWriter:
    """Writes records chunk by chunk; nothing of a record is kept but its running digest."""

    def __init__(self, path: str):
        self.path, self.out = path, create(path)
        self.written = self.records = 0
        self.pack = self.digest = None

    def _put(self, data: bytes) -> None:
        self.written += self.out.write(data) or len(data)

    def begin(self, record, url, payload_bytes: int, sha1: str, is_revisit: bool, refers_to) -> None:
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
        fields = {
            "WARC-Type": "revisit" if is_revisit else "response",
            "WARC-Record-ID": _urn(record),
            "WARC-Date": DATE,
            "WARC-Target-URI": quote(url or "", safe="%/:=&?~#+!$,;'@()*[]"),
            "WARC-Payload-Digest": "sha1:" + base32(bytes.fromhex(sha1)),
            "Content-Type": "application/http; msgtype=response",
            "Content-Length": str(len(http) + (0 if is_revisit else payload_bytes)),
        }
        if is_revisit:
            fields |= {"WARC-Profile": REVISIT, "WARC-Refers-To": _urn(refers_to)}
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n" + http
        self.pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.digest, self.expected = hashlib.sha1(), None if is_revisit else sha1
        self._put(self.pack.compress(head.encode()))

    def add(self, data: bytes) -> None:
        self.digest.update(data)
        self._put(self.pack.compress(data))

    def end(self) -> None:
        if self.expected is not None and self.digest.hexdigest() != self.expected:
            raise ValueError("chunks of a record are missing or out of order")
        self._put(self.pack.compress(b"\r\n\r\n") + self.pack.flush())
        self.records += 1

    def close(self) -> dict:
        self.out.close()
        return {"path": self.path, "records": self.records, "bytes": self.written}


_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write_archives(chunks: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives below ``folder``; the manifest: path, records, bytes.

    Files are named after the task attempt; only those the manifest lists count.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, writer, number, done = TaskContext.get(), None, 0, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                record, url, payload_bytes, is_revisit, refers_to, sha1, chunk_no, data, last = row
                if writer is None:
                    name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}"
                    writer, number = ArchiveWriter(f"{folder}/{name}.warc.gz"), number + 1
                if chunk_no == 0:
                    writer.begin(record, url, payload_bytes, sha1, is_revisit, refers_to)
                if data:
                    writer.add(data)
                if last:
                    writer.end()
                    if writer.written >= archive_bytes:
                        done.append(writer.close())
                        writer = None
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_pylist(done, _MANIFEST)

    columns = ["record", "url", "payload_bytes", "is_revisit", "refers_to", "sha1", "chunk_no", "data", "last"]
    return durable(chunks.select(*columns).mapInArrow(written, "path string, records long, bytes long"))


# --- Reading -------------------------------------------------------------------------------------


def archive_chunks(file, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """Chunk rows of an archive, read in one pass with a buffer of one chunk."""
    stream = gzip.GzipFile(fileobj=file)

    def fields() -> dict[str, str]:
        found = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(":")
            found[name.strip().lower()] = value.strip()
        return found

    while first := stream.readline():
        if not first.startswith(b"WARC/1."):
            raise ValueError("no WARC record where one should begin")
        head = fields()
        left = int(head["content-length"])
        at = stream.tell()
        stream.readline()
        http = fields()
        left -= stream.tell() - at
        declared = head["warc-payload-digest"].removeprefix("sha1:")
        row = {
            "record": _record_of(head["warc-record-id"]),
            "url": head["warc-target-uri"],
            "record_type": head["warc-type"],
            "refers_to": _record_of(head["warc-refers-to"]) if "warc-refers-to" in head else None,
        }
        if row["record_type"] == "revisit":
            yield row | {
                "chunk_no": 0, "data": None, "last": True,
                "bytes_so_far": int(http["content-length"]), "digest_so_far": declared,
            }
        else:
            digest, total, number = hashlib.sha1(), 0, 0
            while True:
                data = stream.read(min(chunk_bytes, left))
                if left and not data:
                    raise ValueError("the archive ends inside a record")
                digest.update(data)
                left, total = left - len(data), total + len(data)
                now = base32(digest.digest())
                if not left and now != declared:
                    raise ValueError(f"payload digest of {head['warc-record-id']} does not match")
                yield row | {
                    "chunk_no": number, "data": data, "last": not left,
                    "bytes_so_far": total, "digest_so_far": now,
                }
                if not left:
                    break
                number += 1
        stream.readline()
        stream.readline()


_CHUNK = pa.schema(
    [
        ("record", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("chunk_no", pa.int64()), ("data", pa.binary()), ("last", pa.bool_()),
        ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
    ]
)
_CHUNK_SQL = (
    "record long, url string, record_type string, refers_to long, chunk_no long, data binary, "
    "last boolean, bytes_so_far long, digest_so_far string"
)


def read_chunks(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk table of archives, a task per archive.

    Columns: record, url, record_type, refers_to, chunk_no, data, last, bytes_so_far, digest_so_far
    (base32 SHA-1 of the payload up to here).  A revisit has one row with what it says of the payload.
    ``with_data`` off leaves ``data`` NULL, for checks that only need the digests.
    """
    archives = max(1, manifest.count())

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_file(path) as file, io.BufferedReader(file, 1 << 20) as buffered:
                    for row in archive_chunks(buffered, chunk_bytes):
                        if not with_data:
                            row["data"] = None
                        rows.append(row)
                        held += len(row["data"] or b"")
                        if len(rows) == 1_000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _CHUNK)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _CHUNK)

    return manifest.select("path").repartition(archives).mapInArrow(chunks, _CHUNK_SQL)


def archive_pages(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = LEAST_REVISIT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write every page as a record; the manifest.  NULL payloads and URLs are empty."""
    small_batches(pages.sparkSession)
    records = with_roles(pages, id_col, url_col, payload_col, least_bytes)
    return write_archives(chunked(records, chunk_bytes), folder, archive_bytes)


def warc_round_trip(spark, sf_dir) -> DataFrame:
    """One row per page, as the archives have it."""
    manifest = archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    chunks = read_chunks(manifest, with_data=False)
    return chunks.where("last").select(
        F.col("record").alias("page_id"),
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE = """
WITH hashed AS (
  SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages),
fives AS (
  SELECT page_id, body, [CAST('0x' || substr(hex, CAST(k * 5 + 1 AS INTEGER), 5) AS INTEGER) for k in range(8)] AS parts FROM hashed),
coded AS (
  SELECT page_id, body, list_aggregate(list_transform(parts, lambda v: concat(
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) + 1, 1),
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1),
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1),
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1))), 'string_agg', '') AS payload_digest
  FROM fives),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS keep FROM coded)
SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM kept
"""
