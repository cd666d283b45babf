"""Pages as WARC files: deterministic, sharded, deduplicated by payload, and back.

Records are range-sorted by page_id. A task writes its range into files that end once they
have so many compressed bytes; each record is a gzip member of its own, its headers and
digests are made anew. Files are written under temporary names; the driver renames what
succeeded and writes the manifest last. Ids and dates follow from the content and a
parameter, so the same table gives the same records.

Of the records with one payload (of at least ``least_bytes``), the one with the smallest
page_id is a response; the others are revisits without payload, which name it and keep
digest and length. The first page_ids come from an aggregate with partial results; the join
back carries page_id and digest alone, so a payload that a third of the pages share costs one
narrow skewed join, which adaptive execution splits. The references then meet the pages in
the range sort.

A null html is an empty payload, a null url an empty target. Null page_ids come first and
are always responses. Repeated page_ids: each row is a record; rows that share page_id and
payload are all responses. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import filesystem
from .token_files import commit, manifest

FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def record(page_id, url, payload: bytes, refers_to, digest: str, size: int, date: str) -> bytes:
    """One record, uncompressed. ``refers_to``: the response's page_id for a revisit."""
    revisit = refers_to is not None
    body = _HTTP % size + (b"" if revisit else payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~")),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(body)),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(body)}"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", size),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", page_id))
    if revisit:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page-Id", refers_to),
        ]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The pages, and a row without html before each page that revisits another.

    Both kinds have page_id, digest in hex and ``refers_to`` (null: a page). They meet when
    sorted, so that the html is shuffled once, and not for a join as well.
    """
    html = F.coalesce("html", F.lit(""))
    digest = F.sha1(html.cast("binary")).alias("digest")
    narrow = pages.select("page_id", digest, F.octet_length(html).alias("size"))
    groups = narrow.where(F.col("size") >= least_bytes).groupBy("digest")
    groups = groups.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = groups.where("n > 1").select("digest", "first")
    later = narrow.join(groups, "digest").where(F.col("page_id") > F.col("first"))
    nothing = F.lit(None).cast("string")
    later = later.select("page_id", nothing, nothing, "digest", F.col("first").alias("refers_to"))
    first = pages.select("page_id", "url", "html", digest, F.lit(None).cast("long").alias("refers_to"))
    return first.union(later.dropDuplicates())


def write_warc(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
) -> None:
    """Write the pages into ``folder`` as ``part-*.warc.gz`` with a manifest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = filesystem(folder)
        task, out, seq, size, n = TaskContext.get().partitionId(), None, 0, 0, 0
        revisit = None  # page_id, digest and reference of the last row that announced one

        def row() -> pa.RecordBatch:
            out.close()
            found = {"name": name, "n_records": n, "bytes": size, "task": task, "seq": seq}
            return pa.RecordBatch.from_pylist([found])

        for batch in batches:
            for i in range(len(batch)):
                page_id, url, html, known, refers_to = (c[i].as_py() for c in batch.columns)
                if refers_to is not None:
                    revisit = page_id, known, refers_to
                    continue
                refers_to = revisit[2] if revisit and revisit[:2] == (page_id, known) else None
                payload = (html or "").encode()
                digest, length = sha1_base32(payload), len(payload)
                if out is None:
                    files.create_dir(f"{path}/_temporary", recursive=True)
                    name = uuid.uuid4().hex
                    out, size, n = files.open_output_stream(f"{path}/_temporary/{name}"), 0, 0
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = pack.compress(record(page_id, url, payload, refers_to, digest, length, date))
                data += pack.flush()
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    yield row()
                    out, seq = None, seq + 1
        if out is not None:
            yield row()

    ordered = with_references(pages, least_bytes).repartitionByRange("page_id")
    ordered = ordered.sortWithinPartitions("page_id", "digest", F.col("refers_to").desc_nulls_last(), "url")
    written = ordered.mapInArrow(
        work, "name string, n_records long, bytes long, task long, seq long"
    )
    commit(folder, sorted(written.collect(), key=lambda r: (r.task, r.seq)), "warc.gz")


def records_of(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file, member by member."""
    files, path = filesystem(uri)
    with files.open_input_stream(path, compression=None) as f:
        data = f.read(1 << 20)
        while data:
            unpack, parts = zlib.decompressobj(31), []
            while not unpack.eof:
                if not data and not (data := f.read(1 << 20)):
                    raise ValueError(f"{uri} ends within a record")
                parts.append(unpack.decompress(data))
                data = unpack.unused_data
            head, _, block = b"".join(parts).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")[1:]
            headers = dict(line.split(": ", 1) for line in lines)
            yield headers, block[: int(headers["Content-Length"])]
            data = data or f.read(1 << 20)


def read_warc(spark: SparkSession, folder: str, with_html: bool = False) -> DataFrame:
    """A row for each record; digests of payloads and blocks are verified."""
    rows = [(f"{folder}/{r['name']}",) for r in manifest(folder)]
    schema = "page_id long, url string, payload_bytes long, payload_digest string,"
    schema += " record_type string, refers_to long, record_id string" + ", html string" * with_html
    names = [c.split()[0] for c in schema.split(",")]

    def row(headers: dict[str, str], block: bytes) -> dict:
        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = block.partition(b"\r\n\r\n")[2]
        if headers["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
            raise ValueError(f"record {headers['WARC-Record-ID']}: its block has another digest")
        if kind == "response" and sha1_base32(payload) != digest:
            raise ValueError(f"record {headers['WARC-Record-ID']}: its payload has another digest")
        page_id, refers_to = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page-Id")
        html = payload.decode() if kind == "response" else None
        values = (
            page_id and int(page_id), headers["WARC-Target-URI"], int(headers["X-Payload-Length"]),
            digest, kind, refers_to and int(refers_to), headers["WARC-Record-ID"], html,
        )
        return dict(zip(names, values, strict=False))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                out, size = [], 0
                for headers, block in records_of(uri):
                    out.append(row(headers, block))
                    size += len(block)
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(out, arrow)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, arrow)

    kinds = [pa.int64() if c.split()[1] == "long" else pa.string() for c in schema.split(",")]
    arrow = pa.schema(list(zip(names, kinds, strict=True)))
    uris = spark.createDataFrame(rows, "uri string").repartition(max(1, len(rows)))
    return uris.mapInArrow(work, schema)
