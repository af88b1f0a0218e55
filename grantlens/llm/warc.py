"""WARC archives written from a page table, and read back as a table of record chunks.

A task writes its pages into gzip archives, one member per record, a stretch of the payload at a time. Of
pages with equal payloads one is stored in full and the others refer to it. Reading gives one row per record and
chunk number: no payload is ever held whole, and each row carries size and digest of the payload up to and with its
chunk, so the last one has the whole payload's without a second pass or a gathering of chunks.

Files have names that no other attempt has; the manifest, a Spark table, names those of the attempts that counted.
"""

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.files import file_system
from grantlens.sources.storage import shared_folder, written

CHUNK_BYTES = 1 << 16
ARCHIVE_BYTES = 1 << 30
CHUNKS = pa.schema(
    [
        ("archive", pa.string()),
        ("record_no", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("declared_digest", pa.string()),
        ("chunk_no", pa.int64()),
        ("chunk", pa.binary()),
        ("bytes_so_far", pa.int64()),
        ("digest_so_far", pa.string()),
        ("is_last", pa.bool_()),
        ("digest_fits", pa.bool_()),
    ]
)
CHUNK_COLUMNS = (
    "archive string, record_no long, record_id string, record_type string, page_id long, refers_to long, payload_bytes long,"
    " declared_digest string, chunk_no long, chunk binary, bytes_so_far long, digest_so_far string, is_last boolean,"
    " digest_fits boolean"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id, digest: str) -> str:
    """Rows that repeat a page and its payload have the same id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record_head(kind: str, page_id, url, n_bytes: int, digest: str, refers_to, date: str) -> tuple[bytes, bytes]:
    """(WARC header, HTTP header) of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    address = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:page:{page_id}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {address}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (n_bytes if kind == 'response' else 0)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), http


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Writes a record for every row below ``folder``; returns the manifest (archive, records).

    Of rows with equal payloads of at least ``least_bytes`` bytes that with the lowest page_id becomes a response and
    the others revisits of it; smaller payloads are all responses. A null payload is empty. A row
    with a null page_id revisits like any other, and is a response where no equal payload has an id; a row that
    repeats the lowest page_id is a response too. Other columns are not read. An empty table writes no archive.
    """
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("n"),
        payload.alias("payload"),
    )
    sizes = rows.filter(F.col("n") >= least_bytes).groupBy("digest")
    repeated = sizes.agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    # Stored, so that Spark knows its size before it chooses how to join the payloads.
    repeated = written(repeated.select(F.col("digest").alias("_digest"), "_first"), "warc-repeats")
    found = rows.join(repeated, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "digest", "n", "_first", "payload"
    )

    def run(batches):
        system, path = file_system(folder)
        out = name = None
        written_bytes = records = 0
        done = []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append((name, records))
            out = None

        for batch in batches:
            for page, address, digest, n, first, value in zip(*batch.columns):
                page, n, first = page.as_py(), n.as_py(), first.as_py()
                kind = "response" if first is None or first == page else "revisit"
                known = base32(bytes.fromhex(digest.as_py()))
                head, http = record_head(kind, page, address.as_py(), n, known, first, date)
                if out is None or written_bytes >= ARCHIVE_BYTES:
                    close()
                    name, written_bytes, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                member = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=5, mtime=0)
                member.write(head)
                member.write(http)
                if kind == "response":
                    buffer = memoryview(value.as_buffer())
                    for at in range(0, n, CHUNK_BYTES):
                        member.write(buffer[at : at + CHUNK_BYTES])
                    written_bytes += n
                member.write(b"\r\n\r\n")
                member.close()
                records += 1
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["archive", "records"]
        )

    found.mapInArrow(run, "archive string, records long").write.parquet(f"{folder}/manifest")
    return spark_manifest(pages.sparkSession, folder)


def spark_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("archive string, records long").parquet(f"{folder}/manifest")


def _fields(stream) -> dict[str, str]:
    """Header lines up to the empty one; the first has no colon."""
    fields = {"": stream.readline().decode("utf-8").strip()}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode("utf-8").partition(":")
        fields[name.lower()] = value.strip()
    return fields


def record_chunks(stream, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """Chunk rows of an archive's records, in file order; a record without payload has one empty chunk.

    Records of every type are read. Where a record holds an HTTP message the payload is its body, otherwise the whole
    block. What a record does not say (its id, a digest, a page) is null. ``digest_fits`` is told in the last row of a
    record that is no revisit and declares a SHA-1 of its payload.
    """
    number = 0
    while True:
        start = stream.read(1)
        if not start:
            return
        if start in b"\r\n":
            continue
        head = _fields(stream)
        left = int(head.get("content-length", 0))
        before, http = stream.tell(), {}
        if left and head.get("content-type", "").lower().startswith("application/http"):
            http = _fields(stream)
            left -= stream.tell() - before
        number += 1
        is_revisit = head.get("warc-type") == "revisit"
        told = http.get("content-length", "")
        declared = head.get("warc-payload-digest")
        row = {
            "record_no": number,
            "record_id": head.get("warc-record-id"),
            "record_type": head.get("warc-type"),
            "page_id": int(head["x-page-id"]) if "x-page-id" in head else None,
            "refers_to": int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None,
            "payload_bytes": int(told) if is_revisit and told.isdigit() else left,
            "declared_digest": declared and declared.removeprefix("sha1:"),
        }
        compared = not is_revisit and declared is not None and declared.startswith("sha1:")
        running, at, read = hashlib.sha1(), 0, 0
        while True:
            chunk = stream.read(min(chunk_bytes, left))
            left -= len(chunk)
            if left and not chunk:
                raise EOFError(f"record {row['record_id']} ends {left} bytes early")
            running.update(chunk)
            read += len(chunk)
            digest = base32(running.copy().digest())
            yield row | {
                "chunk_no": at,
                "chunk": chunk,
                "bytes_so_far": read,
                "digest_so_far": digest,
                "is_last": left == 0,
                "digest_fits": digest == row["declared_digest"] if compared and left == 0 else None,
            }
            at += 1
            if not left:
                break


def read_chunks(spark: SparkSession, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of all archives of a manifest; an archive is one task, which holds one chunk at a time."""

    def run(batches):
        system, path = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw, mode="rb"), 1 << 17)
                    rows, held = [], 0
                    for row in record_chunks(stream, chunk_bytes):
                        rows.append(row | {"archive": name})
                        held += len(row["chunk"]) + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=CHUNKS)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=CHUNKS)

    manifest = spark_manifest(spark, folder).select("archive")
    # A number of partitions that is given is kept; without it all the short rows of a manifest come to one task.
    return manifest.repartitionByRange(max(manifest.count(), 1), "archive").mapInArrow(run, CHUNK_COLUMNS)


def page_records(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), a row for each response and revisit.

    A response's digest and size are those of the chunks read, as its last row says; a revisit's are those it declares.
    """
    stored = F.col("record_type") == "response"
    last = chunks.filter(F.col("is_last") & F.col("record_type").isin("response", "revisit"))
    return last.select(
        "page_id",
        F.when(stored, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.col("digest_so_far")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def payloads(chunks: DataFrame, most_chunks: int) -> DataFrame:
    """(archive, record_no, payload) of the responses of at most ``most_chunks`` chunks, put together again."""
    parts = F.array_sort(F.collect_list(F.struct("chunk_no", "chunk")))
    small = chunks.filter((F.col("record_type") == "response") & (F.col("payload_bytes") <= most_chunks * CHUNK_BYTES))
    whole = small.groupBy("archive", "record_no").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda sofar, p: F.concat(sofar, p["chunk"]))
    return whole.select("archive", "record_no", joined.alias("payload"))


def new_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "warc")
