"""WARC archives without repeated payloads.

Headers (page, payload size, SHA-1) are grouped by payload digest. Of equal
payloads of at least ``least`` bytes the one with the largest page_id stays a
response; the others become revisit records that name it and carry no payload.
Smaller payloads are always responses. Every record gets headers of its own.

Archives hold one gzip member per record, so a record can be read by itself. A
task starts a new archive when one exceeds ``archive_bytes``. Archives appear under
their final name only when whole; the table that ``write`` returns lists those of
the tasks that succeeded, so a task that is run again adds nothing twice.

Null html is an empty payload, a null url becomes the page's own name. Page ids may
be null (never chosen before another id; a response if alone) and may repeat: rows
that carry the chosen id and payload are all responses. An empty table makes no
archive.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrow.llm.shards import shared_folder
from tallyrow.llm.words import blocks
from tallyrow.session import written

LEAST = 1000
ARCHIVE_BYTES = 256 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVES = "path string, records bigint"
RECORDS = "page_id bigint, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, url string"


def with_digest(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.withColumn("payload_bytes", F.octet_length(html).cast("long")).withColumn("payload_digest", F.sha1(html.cast("binary")))


def originals(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(digest, page that keeps the payload) of every payload that more than one page holds."""
    heads = with_digest(pages.select("page_id", "html")).where(F.col("payload_bytes") >= least)
    return (
        heads.groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) & F.col("original").isNotNull())
        .drop("_n")
    )


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    found = name.rpartition(":")[2].rstrip(">")
    return None if found == "null" else int(found)


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, revisit: bool, date: str) -> bytes:
    """One record as a gzip member. The block is the HTTP answer, of a revisit its head alone."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else _name(page_id)[1:-1]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(original)}"]
    else:
        block += payload
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame, folder: str | None = None, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per page (page_id, url, html) and returns the archives' paths and record counts."""
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    kept = written(originals(pages, least), "warc-originals")
    # Both sides come straight from tables: a hot digest's partition can be split.
    decided = with_digest(pages.select("page_id", "url", "html")).join(kept, "payload_digest", "left")
    revisit = (F.col("payload_bytes") >= least) & F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))

    def run(batches: Iterator[pa.RecordBatch]):
        out, path, records = None, "", 0

        def closed() -> pa.RecordBatch:
            out.close()
            os.replace(f"{path}.part", path)
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records]})

        for batch in blocks(batches, "html"):
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "payload_digest", "original", "revisit"))):
                if out is None:
                    path = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, records = open(f"{path}.part", "wb"), 0
                page_id, url, html, digest, original, again = row
                out.write(_record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), digest, original, again, date))
                records += 1
                if out.tell() >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    chosen = decided.select("page_id", "url", "html", "payload_digest", "original", F.coalesce(revisit, F.lit(False)).alias("revisit"))
    return written(chosen.mapInArrow(run, ARCHIVES), "warc-archives")


def _records(path: str) -> Iterator[dict]:
    """The records of one archive, one at a time; payloads are checked against their digests."""
    with gzip.open(path, "rb") as source:
        while line := source.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError(f"{path}: no record begins with {line[:40]!r}")
            fields = {}
            while (line := source.readline()).strip():
                name, _, value = line.decode().partition(":")
                fields[name.lower()] = value.strip()
            block = source.read(int(fields["content-length"]))
            source.read(4)
            row = {
                "page_id": _page(fields["warc-record-id"]),
                "record_type": fields["warc-type"],
                "payload_digest": fields["warc-payload-digest"].partition(":")[2],
                "payload_bytes": None,
                "refers_to": _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
                "url": fields["warc-target-uri"],
            }
            if row["record_type"] == "response":
                payload = block.partition(b"\r\n\r\n")[2]
                row["payload_bytes"] = len(payload)
                if hashlib.sha1(payload).hexdigest() != row["payload_digest"]:
                    raise ValueError(f"{path}: payload of {fields['warc-record-id']} differs from its digest")
            yield row


def read(archives: DataFrame) -> DataFrame:
    """A row per record of the archives (column ``path``); a revisit has the payload size of the response it names."""
    spark: SparkSession = archives.sparkSession
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = pa.schema([(n, pa.int64() if "bigint" in f else pa.string()) for n, f in zip(names, RECORDS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                waiting = []
                for row in _records(path):
                    waiting.append(row)
                    if len(waiting) == 4096:
                        yield pa.RecordBatch.from_pylist(waiting, schema=kinds)
                        waiting = []
                if waiting:
                    yield pa.RecordBatch.from_pylist(waiting, schema=kinds)

    paths = archives.select("path")
    tasks = max(1, paths.count())
    records = written(paths.repartition(tasks, "path").mapInArrow(run, RECORDS), "warc-records")
    responses = (
        records.where("record_type = 'response' and payload_bytes >= 1")
        .groupBy("payload_digest")
        .agg(F.max("payload_bytes").alias("_size"))
        .join(records.where("record_type = 'revisit'").select("payload_digest").distinct(), "payload_digest", "left_semi")
    )
    sized = records.join(written(responses, "warc-responses"), "payload_digest", "left")
    return sized.select(*(F.coalesce("payload_bytes", "_size").alias(n) if n == "payload_bytes" else n for n in names))
