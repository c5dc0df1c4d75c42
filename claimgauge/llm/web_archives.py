"""WARC archives of pages, with revisit records for payloads that were already archived.

Headers (digest, length, page id) are grouped by payload digest; the smallest
page id of a digest is the original. Pages are then joined with the originals
on their digest, which Spark splits where one digest has very many copies, and
are written as fresh records: a response with the payload, or a revisit that
names the original. Archives are read back by their lengths alone, so that a
payload may hold anything, a whole record included.

Archives are gzip files in a folder that Spark's own writers and readers reach,
of at most ``archive_mb`` of records each, or of one longer record; writing and
reading keep one archive in a task. An
archive that was lost half-way is written anew by its task's next attempt.

Defined results: a null payload counts as empty. Payloads of fewer than
``min_bytes`` bytes are always responses. Rows with an original's own page id
and payload are all responses. A null page id is never an original if the
digest has another; a null url gets a urn. An empty table gives an empty folder.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.sources.scratch import fresh_path, stage

BREAK = "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
#: the page id and the full payload's length, as extension fields
ID_FIELD, SIZE_FIELD, NO_ID = "X-Page-Id", "X-Payload-Length", "-"
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
    "refers_to_url string, payload string"
)
_NAMESPACE = uuid.UUID("5b0f4d0a-6f0e-4f5e-9a3c-6d2c51d4c0aa")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digests(payloads: pa.Array) -> pa.Array:
    return pa.array([payload_digest((x or "").encode()) for x in payloads.to_pylist()], pa.string())


def _address(url: str | None, page_id: int | None) -> str:
    return "urn:page:" + str(page_id) if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~")


def _record(page_id, url, payload, digest, size, original, original_url, date) -> str:
    """One record without its closing blank lines."""
    name = "null" if page_id is None else str(page_id)
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMESPACE, f'{name} {url} {digest}')}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_address(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"{ID_FIELD}: {NO_ID if page_id is None else page_id}",
        f"{SIZE_FIELD}: {size}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:  # as it was; the address is percent-encoded
        fields.append(f"X-Url: {quote(url, safe='')}")
    block = HTTP_HEAD.format(size)
    if original is None:
        block += payload
    else:
        fields += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To-Target-URI: {_address(original_url, original)}",
            f"WARC-Refers-To-Date: {date}",
            f"X-Refers-To-Page-Id: {original}",
        ]
    fields.append(f"Content-Length: {len(block.encode())}")
    return BREAK.join(fields) + END + block


def _archives(batches: Iterator[pa.RecordBatch], date: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """Each row is the text of one archive, records joined by blank lines; a record that is longer has one to itself."""

    def row(records: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([END.join(records)], pa.string())], names=["value"])

    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            for i, u, p, d, n, o, ou in zip(*(c.to_pylist() for c in batch.slice(at, 100).columns), strict=True):
                record = _record(i, u, p or "", d, n, o, ou, date)
                length = len(record) if record.isascii() else len(record.encode())
                if held and size + length > archive_bytes:
                    yield row(held)
                    held, size = [], 0
                held.append(record)
                size += length
    if held:
        yield row(held)


def resolve_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload with payload_digest, payload_bytes, refers_to and refers_to_url."""
    digest = F.arrow_udf(lambda payloads: _digests(payloads), "string")
    pages = pages.select(
        "page_id", "url", F.coalesce("payload", F.lit("")).alias("payload"),
        digest("payload").alias("payload_digest"), F.octet_length(F.coalesce("payload", F.lit(""))).cast("long").alias("payload_bytes"),
    )
    headers = pages.where(F.col("payload_bytes") >= min_bytes).where(F.col("page_id").isNotNull())
    first = headers.groupBy("payload_digest").agg(
        F.min("page_id").alias("original"), F.min_by("url", F.struct("page_id", "url")).alias("original_url"), F.count("*").alias("copies")
    )
    # written, so that both sides of the join come from a shuffle and a hot digest can be split
    first = stage(first.where("copies > 1").drop("copies"), "payload-originals")
    joined = pages.join(first, "payload_digest", "left")
    later = (F.col("payload_bytes") >= min_bytes) & (F.col("original") < F.coalesce("page_id", F.lit(2**63 - 1)))
    return joined.select(
        "page_id", "url", F.when(later, F.lit(None)).otherwise(F.col("payload")).alias("payload"), "payload_digest", "payload_bytes",
        F.when(later, F.col("original")).alias("refers_to"), F.when(later, F.col("original_url")).alias("refers_to_url"),
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", archive_mb: int = 32) -> None:
    """Writes page_id, url and payload as deduplicated archives into the new ``folder``."""
    archive_bytes = archive_mb << 20
    archives = resolve_revisits(pages, min_bytes).mapInArrow(lambda batches: _archives(batches, date, archive_bytes), "value string")
    (
        archives.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 1)
        .mode("errorifexists").text(folder)
    )


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, in lower case, and block of each record."""
    at = 0
    while at < len(archive):
        head_end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:head_end].decode().split(BREAK)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
        start = head_end + 4
        end = start + int(fields["content-length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, archive[start:end]
        at = end + 4


def _row(fields: dict[str, str], block: bytes) -> tuple:
    page = fields.get(ID_FIELD.lower(), NO_ID)
    url = fields.get("x-url")
    kind = fields["warc-type"]
    # of an archive that is written elsewhere, the address stands for the url
    if url is None and not fields.get("warc-target-uri", "urn:page:").startswith("urn:page:"):
        url = fields["warc-target-uri"]
    body = block[block.index(b"\r\n\r\n") + 4 :] if kind == "response" else None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if body is not None and (payload_digest(body) != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} does not have its digest")
    size = int(fields.get(SIZE_FIELD.lower(), len(body or b"")))
    refers = fields.get("x-refers-to-page-id")
    return (
        None if page == NO_ID else int(page), None if url is None else unquote(url), kind, digest, size,
        None if refers is None else int(refers), fields.get("warc-refers-to-target-uri"), None if body is None else body.decode(),
    )


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in ``folder``; payload is null for revisits or without ``payloads``."""
    schema = RECORD_SCHEMA if payloads else RECORD_SCHEMA.removesuffix(", payload string")
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = [f.split()[0] for f in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                found = []
                for fields, block in parse(gzip.decompress(raw.as_py())):
                    found.append(_row(fields, block)[: len(names)])
                    if len(found) == 500:
                        yield _batch(found)
                        found = []
                if found:
                    yield _batch(found)

    def _batch(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    # one file to a task at a time: an archive is read as a whole
    return files.mapInArrow(rows, schema)


def rewrite(spark: SparkSession, source: str, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Reads archives, resolves their revisits anew and writes them deduplicated.

    Records of revisits get their payload from the response with their digest.
    """
    records = stage(read_archives(spark, source), "archive-records")
    bodies = records.where("record_type = 'response'").groupBy("payload_digest").agg(F.first("payload").alias("body"))
    full = records.join(stage(bodies, "archive-bodies"), "payload_digest", "left")
    pages = full.select("page_id", "url", F.coalesce("payload", "body").alias("payload"))
    write_archives(pages, folder, min_bytes, date)


def archived(pages: DataFrame, payload: str = "html", min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Archives page_id, url and the payload column, and reads the archives back without payloads."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    write_archives(pages.select("page_id", "url", F.col(f"`{payload}`").alias("payload")), folder, min_bytes)
    return read_archives(spark, folder, payloads=False)
