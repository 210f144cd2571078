"""WARC archives written from pages and read back as a chunked record table.

Archives are compressed, each record a gzip member of its own.

Writing: equal payloads share one ``response`` record, that of the largest ``page_id``; the others are
``revisit`` records that refer to it. Each task writes archives of bounded size, record by record, under
names that become final only when the file is whole; only files that the manifest names are read.

Reading: an archive is streamed in chunks of ``CHUNK`` bytes. A record gives one row per chunk, with the
record's identifier, the chunk's number and offset, and the digest over all chunks so far, so a payload of
any size passes through in bounded memory. The row of the last chunk has the whole payload's digest.

A null html is an empty payload, which is one chunk of no bytes. Null page ids are kept and never win as a
response unless their payload has no other; rows that repeat the response's ``page_id`` and payload are
responses too. An empty table gives no rows. Extra columns are ignored.
"""

import base64
import gzip
import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from doorstep.llm.shared_files import move_into_place, store
from doorstep.llm.tables import settled
from doorstep.session import scratch_dir

CHUNK = 1 << 20
FILE_BYTES = 256 << 20
#: What a reading task takes from a stream at a time while it looks for the end of a header.
HEADER_READ = 1 << 12
WARC_DATE = "1970-01-01T00:00:00Z"

MANIFEST = "path string, n_records long"
CHUNKS = (
    "page_id long, record_type string, refers_to long, chunk_no long, offset long, data binary, "
    "digest string, is_last boolean"
)


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _uri(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record_head(page_id: int | None, url: str | None, kind: str, refers_to: int | None, length: int, digest: str) -> bytes:
    """The header of one record. A revisit has no payload of its own; its header keeps the payload's size."""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{_uri(page_id)}>"),
        ("WARC-Date", WARC_DATE),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if kind == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{_uri(refers_to)}>"),
            ("WARC-Payload-Length", str(length)),
            ("Content-Length", "0"),
        ]
    else:
        fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(length))]
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in fields], "\r\n"]).encode()


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and digest of every page, with its record type and the response it refers to."""
    html = F.coalesce("html", F.lit(""))
    digests = pages.select("page_id", F.sha1(html).alias("digest"))
    responses = digests.groupBy("digest").agg(F.max("page_id").alias("response"))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("digest"))
    # One row per digest on the right: a payload that very many pages share is split on the left.
    joined = rows.join(responses, "digest")
    first = F.col("page_id").eqNullSafe(F.col("response")) | (F.octet_length("html") < least_bytes)
    return joined.select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(first, "response").otherwise("revisit").alias("record_type"),
        F.when(~first, F.col("response")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records; the manifest has a row per archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        piece, attempt = context.partitionId(), context.taskAttemptId()
        number, n, size, out, path = 0, 0, 0, None, ""

        def close() -> pa.RecordBatch:
            nonlocal number, n, size, out
            out.close()
            move_into_place(path, f"{path}.{attempt}")
            row = pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_records"])
            number, n, size, out = number + 1, 0, 0, None
            return row

        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for k in range(batch.num_rows):
                if out is None:
                    path = f"{folder}/pages-{piece:06d}-{number:06d}.warc.gz"
                    files, target = store(path)
                    files.create_dir(os.path.dirname(target), recursive=True)
                    out = files.open_output_stream(f"{target}.{attempt}")
                page, url, kind, refers, digest = (
                    columns[c][k].as_py() for c in ("page_id", "url", "record_type", "refers_to", "digest")
                )
                payload = memoryview(columns["html"][k].as_buffer() or b"")
                head = record_head(page, url, kind, refers, len(payload), _base32(bytes.fromhex(digest)))
                member = zlib.compressobj(1, zlib.DEFLATED, 31)
                parts = [head]
                if kind == "response":
                    parts += [payload[at : at + CHUNK] for at in range(0, len(payload), CHUNK)]
                for part in [*parts, b"\r\n\r\n"]:
                    out.write(member.compress(part))
                    size += len(part)
                out.write(member.flush())
                n += 1
                if size >= file_bytes:
                    yield close()
        if out is not None:
            yield close()

    return settled(records.mapInArrow(write, MANIFEST), "warc-manifest")


def _page(uri: str | None) -> int | None:
    digits = (uri or "").strip("<>").rpartition(":")[2]
    return int(digits) if digits else None


def read_records(source, chunk: int = CHUNK) -> Iterator[tuple]:
    """(page_id, type, refers_to, chunk_no, offset, data, digest so far, is_last) of every chunk in a stream."""
    held = b""
    while True:
        while b"\r\n\r\n" not in held:
            more = source.read(HEADER_READ)
            if not more:
                if held.strip():
                    raise ValueError("an archive ends inside a record's header")
                return
            held += more
        head, _, held = held.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        page, kind = _page(fields["WARC-Record-ID"]), fields["WARC-Type"]
        refers = _page(fields.get("WARC-Refers-To"))
        left, number, offset, digest = int(fields["Content-Length"]), 0, 0, hashlib.sha1()
        if kind == "revisit":
            total = int(fields["WARC-Payload-Length"])
            yield page, kind, refers, 0, total, b"", fields["WARC-Payload-Digest"].partition(":")[2], True
        while kind != "revisit":
            data = held[: min(chunk, left)]
            held = held[len(data) :]
            if len(data) < min(chunk, left):
                data += source.read(min(chunk, left) - len(data))
                if len(data) < min(chunk, left):
                    raise ValueError("an archive ends inside a payload")
            digest.update(data)
            left -= len(data)
            yield page, kind, refers, number, offset, data, _base32(digest.digest()), not left
            number, offset = number + 1, offset + len(data)
            if not left:
                break
        held += source.read(max(0, 4 - len(held)))
        if held[:4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        held = held[4:]


def read_chunks(manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunked record table. Without data only each chunk's place and digest travel on."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, at = store(path)
                rows, size = [], 0
                with files.open_input_stream(at, compression=None) as raw, gzip.open(raw) as source:
                    for row in read_records(source):
                        size += len(row[5])
                        rows.append(row if with_data else (*row[:5], len(row[5]), *row[6:]))
                        if len(rows) >= 4096 or (with_data and size >= 16 * CHUNK):
                            yield _batch(rows, with_data)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, with_data)

    schema = CHUNKS if with_data else CHUNKS.replace("data binary", "data_bytes long")
    # The number is given: left to itself Spark would read all names, which are few bytes, in one task.
    return manifest.select("path").repartition(max(1, manifest.count()), "path").mapInArrow(scan, schema)


def _batch(rows: list[tuple], with_data: bool) -> pa.RecordBatch:
    data = pa.binary() if with_data else pa.int64()
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), data, pa.string(), pa.bool_()]
    names = ["page_id", "record_type", "refers_to", "chunk_no", "offset", "data" if with_data else "data_bytes", "digest", "is_last"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def page_records(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder, read them back, and describe every record.

    A record's size and digest are those of its last chunk; a revisit's are the ones that its header names.
    """
    folder = scratch_dir(pages.sparkSession, "warc")
    chunks = read_chunks(write_archives(plan_records(pages), folder), with_data=False)
    return chunks.where("is_last").select(
        "page_id",
        (F.col("offset") + F.col("data_bytes")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
