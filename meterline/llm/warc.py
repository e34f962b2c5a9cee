"""WARC archives with the index first: byte ranges are planned from the index and read in sorted, merged runs.

Writing: each task streams its records into archive files of its own in the shared folder and returns one index row per
record (file, offset, length, URL, digest). The index is the truth: files of a task attempt that was lost are in no
index row and are never read. Reading: selected index rows are sorted by offset within their file, neighbours are merged
into one range, and each range is one read.

Of records with equal payloads the one with the largest page id is the response; the others revisit it.

Defined results: a null payload is empty; a null page id never becomes the response of a group that has an id; rows equal
in id and payload are all responses; a null URL is left out of the record; an empty table gives an empty archive. Only
``page_id, url, html`` are read, so further columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from meterline.llm.common import new_folder, saved

DATE = "2025-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 0
ROLL_BYTES = 256 << 20
#: Ranges with a smaller gap are read together, up to a run of this size.
GAP_BYTES = 64 << 10
RUN_BYTES = 8 << 20
#: About so much is read by one task.
TASK_BYTES = 16 << 20
INDEX = "file string, offset bigint, length bigint, url string, payload_digest string, page_id bigint, record_type string, refers_to bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}",
        *([] if url is None else ["WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A")]),
        *([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]),
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])

    def page(name: str) -> int | None:
        value = fields.get(name, "<urn:page:None>")[len("<urn:page:"):-1]
        return None if value == "None" else int(value)
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    return {
        "page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload": payload,
    }


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, refers_to``: which record each page becomes."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    groups = (
        rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1 AND response IS NOT NULL").drop("n")
    )
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "html", F.when(revisit, F.col("response")).alias("refers_to"))


def write_archives(planned: DataFrame, compress: bool = True) -> DataFrame:
    """Write the archives; returns the stored index."""
    folder = new_folder(planned.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None or offset >= ROLL_BYTES:
                        if out:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc" + ".gz" * compress, 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    payload = row["html"].encode()
                    digest = sha1_base32(payload)
                    data = record(row["page_id"], row["url"], payload, digest, row["refers_to"])
                    if compress:
                        member = zlib.compressobj(1, zlib.DEFLATED, 31)
                        data = member.compress(data) + member.flush()
                    out.write(data)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    rows.append((f"{folder}/{name}", offset, len(data), row["url"], digest, row["page_id"], kind, row["refers_to"]))
                    offset += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, INDEX_TYPES, strict=True)], names=INDEX_NAMES)
        finally:
            if out:
                out.close()
    return saved(planned.mapInArrow(write, INDEX), "warc-index")


INDEX_NAMES = [x.split()[0] for x in INDEX.split(", ")]
INDEX_TYPES = [pa.string() if x.split()[1] == "string" else pa.int64() for x in INDEX.split(", ")]


def plan_reads(selected: DataFrame) -> DataFrame:
    """Merged ranges of the selected index rows: ``file, start, stop, parts``. A file has a bounded number of records."""
    order = Window.partitionBy("file").orderBy("offset")
    far = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(order) > GAP_BYTES
    full = F.floor(F.col("offset") / RUN_BYTES) != F.floor(F.lag("offset").over(order) / RUN_BYTES)
    opens = F.when(F.lag("offset").over(order).isNull() | far | full, 1).otherwise(0)
    return (
        selected.select("file", "offset", "length").withColumn("opens", opens).withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("file", "run").agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"), F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("parts"))
    )


def read_records(selected: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows; ``payloads=False`` returns their size and verified digest only."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.to_pylist():
                store, path = filesystem(run["file"])
                with store.open_input_file(path) as f:
                    data = f.read_at(run["stop"] - run["start"], run["start"])
                rows = []
                for part in run["parts"]:
                    at = part["offset"] - run["start"]
                    raw = data[at: at + part["length"]]
                    found = parse(zlib.decompress(raw, 31) if run["file"].endswith(".gz") else raw)
                    body = found["payload"]
                    if body is not None and sha1_base32(body) != found["payload_digest"]:
                        raise ValueError(f"damaged record in {run['file']} at {part['offset']}")
                    rows.append((*[found[k] for k in ("page_id", "url", "record_type", "refers_to", "payload_digest")], None if body is None else len(body), body if payloads else None))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in RECORD.split(", ")])
    total = selected.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    # rows of the plan are small and what they point at is not: tasks are dealt by the bytes to read
    runs = plan_reads(selected).repartition(max(1, -(-total // TASK_BYTES)), "file", "run")
    return runs.select("file", "start", "stop", "parts").mapInArrow(read, RECORD)


def digest(index: DataFrame) -> DataFrame:
    """Every record read back; a revisit reports the payload of its response."""
    rows = saved(read_records(index, payloads=False).drop("payload", "url"), "warc-read")
    whole = rows.where("record_type = 'response'").groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("bytes")).withColumnRenamed("page_id", "refers_to")
    size = F.coalesce("payload_bytes", "bytes").alias("payload_bytes")
    return rows.join(whole, ["refers_to", "payload_digest"], "left").select("page_id", size, "payload_digest", "record_type", "refers_to")
