"""WARC archives: one gzip member per record, written by tasks and read back sequentially."""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import stored
from fairtally.storage import scratch_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def _record(page_id, url, digest, size, refers_to, payload: bytes) -> bytes:
    """One record as a gzip member. A revisit has headers and an empty block."""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    name = lambda i: f"<urn:page:{i}>"
    head = [
        "WARC/1.1",
        "WARC-Type: " + ("response" if refers_to is None else "revisit"),
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{b32}",
        f"X-Payload-Length: {size}",
    ]
    if page_id is not None:
        head.append(f"WARC-Concurrent-To: {name(page_id)}")
    if url is not None:  # header lines hold neither line ends nor other control characters
        head.append("WARC-Target-URI: " + "".join(c if c > "\x1f" and c not in "%\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = payload if refers_to is None else b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + pack.flush()


def write_archives(folder: str, most_bytes: int = ARCHIVE_BYTES):
    """A mapInArrow function: writes its rows below ``folder`` and returns the names of its files.

    Each try of a task writes names of its own, and only the names of the try that succeeded
    arrive in the result: files of lost or repeated tries are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        out, path, count, size = None, "", 0, 0
        done: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload_digest", "payload_bytes", "refers_to", "html")]
            for row in zip(*columns):
                *head, html = (v.as_py() for v in row)
                if out is None:
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                data = _record(*head, (html or "").encode("utf-8", "surrogatepass"))
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= most_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        if done:
            names, counts, sizes = zip(*done)
            yield pa.record_batch([pa.array(names), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], schema=FILES)

    return run


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream one after the other, each decompressed step by step."""
    data, unpack, parts = b"", None, []
    while True:
        if not data:
            data = stream.read(READ_BYTES)
            if not data:
                break
        if unpack is None:
            unpack, parts = zlib.decompressobj(31), []
        parts.append(unpack.decompress(data))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack = None
    if unpack is not None:
        raise ValueError("the archive ends inside a record")


def parse_record(member: bytes) -> dict:
    """Headers and block of a record; the length frames the block, the digest must agree."""
    head, split, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not split or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("the block does not have the length that its header names")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and hashlib.sha1(block).hexdigest() != digest:
        raise ValueError(f"wrong payload digest of {fields.get('WARC-Target-URI')}")
    number = lambda key: int(fields[key][len("<urn:page:") : -1]) if key in fields else None
    url = fields.get("WARC-Target-URI")
    if url is not None and "%" in url:
        url = re.sub("%(0[0-9A-F]|1[0-9A-F]|25|7F)", lambda m: chr(int(m[1], 16)), url)
    return {
        "page_id": number("WARC-Concurrent-To"),
        "url": url,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "payload": block if fields["WARC-Type"] == "response" else None,
    }


def read_archives(with_payload: bool):
    """A mapInArrow function: the records of the files that ``path`` names, in file order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for member in members(stream):
                        row = parse_record(member)
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        size += len(row["payload"] or b"") + 200
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)

    return run


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html with the size, digest and (for revisits) the response of each payload.

    Among equal payloads of at least ``min_bytes`` the largest page_id is the response. Null html is
    an empty payload. Rows that repeat the response's page_id are responses too, and so is a row
    with a null page_id, as revisits could not name it.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html.cast("binary")).alias("payload_digest"),
    )
    large = rows.where(F.col("payload_bytes") >= min_bytes)
    # Only digests that occur more than once move, and only (page_id, digest) is aggregated.
    first = large.groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").select("payload_digest", "original")
    keys = large.select("page_id", "payload_digest").join(first, "payload_digest").where("page_id < original")
    revisits = keys.select("page_id", "payload_digest", F.col("original").alias("refers_to")).distinct()
    return rows.join(revisits, ["page_id", "payload_digest"], "left")


def write_warc(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT_BYTES, most_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the pages as archives below ``folder`` (else the shared scratch folder).

    Returns the written files: path (a full URI), records, bytes.
    """
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    files = plan_records(pages, min_bytes).mapInArrow(
        write_archives(uri, most_bytes), "path string, records bigint, bytes bigint"
    )
    scheme = uri.split("://", 1)
    host = "" if scheme[0] == "file" else scheme[1].split("/", 1)[0]
    named = F.concat(F.lit(f"{scheme[0]}://{host}/"), F.regexp_replace("path", "^/+", ""))
    return stored(files.withColumn("path", named), "warc-files")


def read_warc(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives that ``path`` names, up to 10,000 tasks with whole files each.

    A file is one stream: its members are framed, checked and returned in order. A damaged
    archive (cut member, wrong length, wrong digest) raises.
    """
    schema = (
        "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
        "payload_digest string, payload binary"
    )
    # A fixed number of tasks: names are so short that Spark would read all files in one.
    tasks = max(1, min(files.count(), 10_000))
    return files.select("path").repartition(tasks, "path").mapInArrow(read_archives(with_payload), schema)
