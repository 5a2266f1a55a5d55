"""WARC archives with an index, and coalesced byte-range reads through it.

Every task writes its records to archives of its own (one gzip member per record, so each record
can be read alone) and gives back an index row per record: archive, offset, length, URL, digest.
The index is the only thing that says which archives count: a task that is run again writes new
archives, and those of the lost attempt are in no index row. Readers sort the index rows they want
by place, merge neighbours into one range, and read range by range.

Records with equal payloads of at least ``LEAST`` bytes are stored once: the one with the largest
page id is the response, the others are revisit records that refer to it.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import partitions, settle
from strata.workspace import scratch_folder

LEAST = 1000
ARCHIVE_BYTES = 64 << 20
GAP, RANGE = 64 << 10, 8 << 20

INDEX = (
    "page_id bigint, archive string, offset bigint, length bigint, url string, "
    "payload_digest string, payload_bytes bigint, record_type string, refers_to bigint"
)
_DATE = "2026-01-01T00:00:00Z"


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id``, ``digest`` and ``refers_to`` of the records that only refer to another."""
    html = _payload(F.col("html"))
    rows = pages.select(
        "page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("bytes")
    ).where(F.col("bytes") >= least)
    kept = rows.groupBy("digest", "bytes").agg(
        F.max("page_id").alias("refers_to"), F.count("*").alias("n")
    )
    kept = kept.where("n > 1 AND refers_to IS NOT NULL")
    rows = rows.join(kept, ["digest", "bytes"])
    rows = rows.where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return rows.select("page_id", "digest", "refers_to").distinct()


def _number(value: int | None) -> str:
    return "" if value is None else str(value)


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{_number(page_id)}>",
        f"WARC-Date: {_DATE}",
        "WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url or ""),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return head + body + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields in lower case, and the block, of one uncompressed record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not at the start of a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields, rest[: int(fields["content-length"])]


def write(
    pages: DataFrame, path: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) below ``path``; returns the index.

    NULL html is an empty payload, NULL urls are empty. Rows that share both page id and payload
    stay alike: all of them are responses if their id is the largest. Empty tables write nothing.
    """

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(path)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                payload = (row["html"] or "").encode()
                digest = hashlib.sha1(payload).hexdigest()
                record = _record(row["page_id"], row["url"], payload, digest, row["refers_to"])
                member = gzip.compress(record, 1, mtime=0)
                out.write(member)
                kind = "response" if row["refers_to"] is None else "revisit"
                rows.append(
                    {
                        "page_id": row["page_id"],
                        "archive": name,
                        "offset": at,
                        "length": len(member),
                        "url": row["url"],
                        "payload_digest": digest,
                        "payload_bytes": len(payload),
                        "record_type": kind,
                        "refers_to": row["refers_to"],
                    }
                )
                at += len(member)
                if at >= archive_bytes:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if out is not None:
            out.close()

    kinds = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in INDEX.split(", "))])
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    known = revisits(pages, least).withColumnRenamed("page_id", "again")
    same = F.col("page_id").eqNullSafe(F.col("again")) & (
        F.sha1(_payload(F.col("html"))) == F.col("digest")
    )
    rows = pages.join(known, same, "left").select("page_id", "url", "html", "refers_to")
    return settle(rows.mapInArrow(archives, INDEX), "warc-index")


def read(index: DataFrame, path: str, gap: int = GAP, longest: int = RANGE) -> DataFrame:
    """Records at the places ``index`` lists: ``page_id``, ``url``, ``payload`` (binary),
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Places are range-sorted by archive and offset; neighbours less than ``gap`` bytes apart are read
    as one range of at most ``longest`` bytes (or one record). Everything but the place is taken
    from the archives; a payload that contradicts its digest fails the job.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            at = 0
            while at < len(places):
                archive, start, length = places[at]
                stop, end = at + 1, start + length
                while stop < len(places):
                    name, offset, size = places[stop]
                    if name != archive or offset > end + gap or offset + size > start + longest:
                        break
                    stop, end = stop + 1, max(end, offset + size)
                with files.open_input_file(f"{root}/{archive}") as f:
                    block = f.read_at(end - start, start)
                rows = []
                for _, offset, size in places[at:stop]:
                    member = block[offset - start : offset - start + size]
                    rows.append(_row(*parse(gzip.decompress(member))))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                at = stop

    def _row(fields: dict[str, str], body: bytes) -> dict:
        def page(name: str) -> int | None:
            found = fields.get(name, "")[len("<urn:page:") : -1]
            return int(found) if found else None

        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "response" and hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"payload of page {page('warc-record-id')} contradicts its digest")
        return {
            "page_id": page("warc-record-id"),
            "url": fields["warc-target-uri"],
            "payload": body if fields["warc-type"] == "response" else None,
            "payload_bytes": int(fields["x-payload-length"]),
            "payload_digest": digest,
            "record_type": fields["warc-type"],
            "refers_to": page("warc-refers-to"),
        }

    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
        ]
    )
    places = index.select("archive", "offset", "length")
    places = places.repartitionByRange(partitions(index.sparkSession), "archive", "offset")
    return places.sortWithinPartitions("archive", "offset").mapInArrow(
        records,
        "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint",
    )


def through_archives(spark: SparkSession, pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Writes all pages to a fresh shared folder and reads every record back."""
    path = scratch_folder(spark, "warc")
    return read(write(pages, path, least), path)
