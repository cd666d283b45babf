"""Token ids of documents as files of Simple-8b blocks, and back.

A file is ``MAGIC``; blocks of ids; one block each of the documents' id counts and of
their doc_ids (differences to the one before, zigzag); the footer; the footer's length
(8 bytes) and ``MAGIC``. The footer is JSON and names the place of every block, so a
reader can begin at any of them. Ids run on over documents; the counts cut them.

Documents are range-sorted by doc_id, so file after file holds them in ascending order.
A task writes under a temporary name; the driver renames what succeeded, one name for each
file, and writes the manifest last. A folder without manifest was not committed.

Null or empty texts have only the end id. Null doc_ids come first. Repeated rows are all
written. Only ``doc_id`` and ``text`` are read. No rows: a manifest without files.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .simple8b import HEADER_BYTES, block_size, decode_block, encode_block
from .storage import filesystem
from .tokens import encoder
from .words import runs

MAGIC = b"IDS8B\x00\x00\x01"
BLOCK_IDS = 1 << 16
#: A file ends with the document that brings it to so many ids.
FILE_IDS = 1 << 25
MANIFEST = "manifest.json"


class _File:
    """One file as it is written."""

    def __init__(self, files, folder: str, name: str):
        self.name, self.out = name, files.open_output_stream(f"{folder}/{name}")
        self.place, self.blocks = 0, []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.n_null = 0
        self.counts: list[int] = []
        self.doc_ids: list[int] = []
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.place += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if doc_id is None:
            self.n_null += 1
        else:
            self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            self._blocks(BLOCK_IDS)

    def _blocks(self, least: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        at = 0
        while len(ids) - at >= least and at < len(ids):
            part = ids[at : at + BLOCK_IDS]
            self.blocks.append([self.place, len(part)])
            self._write(encode_block(part))
            at += len(part)
        self.waiting, self.n_waiting = [ids[at:]], len(ids) - at

    def close(self) -> dict:
        self._blocks(1)
        tables = [self.place]
        self._write(encode_block(np.array(self.counts, np.uint64)))
        tables.append(self.place)
        steps = np.diff(np.array([0, *self.doc_ids], np.int64))
        zigzag = (steps << 1) ^ (steps >> 63)
        self._write(encode_block(zigzag.view(np.uint64)))
        footer = {"blocks": self.blocks, "tables": tables, "n_null": self.n_null}
        data = json.dumps(footer).encode()
        self._write(data + len(data).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return {"name": self.name, "n_ids": self.n_ids, "n_docs": len(self.counts)}


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, spaces_kept: bool = True
) -> None:
    """Encode ``text``, append ``end_id`` to each document, write into ``folder``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = filesystem(folder)
        task, tokens, file = TaskContext.get().partitionId(), encoder(tokenizer, spaces_kept), None
        end = np.uint32(end_id)

        def row(seq: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([file.close() | {"task": task, "seq": seq}], _ROW)

        seq = 0
        for batch in batches:
            texts = batch.column(1)
            for low, high in runs(texts):
                ids_of = tokens.encode(texts.slice(low, high - low))
                names = batch.column(0).slice(low, high - low).to_pylist()
                for doc_id, ids in zip(names, ids_of, strict=True):
                    if file is None:
                        files.create_dir(f"{path}/_temporary", recursive=True)
                        file = _File(files, f"{path}/_temporary", uuid.uuid4().hex)
                    file.add(doc_id, np.append(ids, end))
                    if file.n_ids >= FILE_IDS:
                        yield row(seq)
                        file, seq = None, seq + 1
        if file is not None:
            yield row(seq)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id")
    written = ordered.sortWithinPartitions("doc_id", "text").mapInArrow(
        work, "name string, n_ids long, n_docs long, task long, seq long"
    )
    commit(folder, sorted(written.collect(), key=lambda r: (r.task, r.seq)), "s8b")


_ROW = pa.schema([("name", pa.string())] + [(n, pa.int64()) for n in ("n_ids", "n_docs", "task", "seq")])


def commit(folder: str, rows: list, suffix: str) -> None:
    """Name one file for each row of a finished job, drop the rest, write the manifest."""
    files, path = filesystem(folder)
    files.create_dir(path, recursive=True)
    named = []
    for i, r in enumerate(rows):
        name = f"part-{i:06d}.{suffix}"
        files.move(f"{path}/_temporary/{r.name}", f"{path}/{name}")
        named.append(r.asDict() | {"name": name})
    if rows:
        files.delete_dir(f"{path}/_temporary")
    with files.open_output_stream(f"{path}/_{MANIFEST}") as out:
        out.write(json.dumps(named).encode())
    files.move(f"{path}/_{MANIFEST}", f"{path}/{MANIFEST}")


def manifest(folder: str) -> list[dict]:
    files, path = filesystem(folder)
    with files.open_input_stream(f"{path}/{MANIFEST}") as f:
        return json.loads(f.read())


def documents_of(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each document of a file with its ids, block after block."""
    files, path = filesystem(uri)
    with files.open_input_file(path) as f:

        def block(place: int) -> np.ndarray:
            f.seek(place)
            header = f.read(HEADER_BYTES)
            return decode_block(header, f.read(block_size(header)[1]))

        size = f.size()
        f.seek(size - 16)
        tail = f.read(16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} has no footer")
        length = int.from_bytes(tail[:8], "little")
        f.seek(size - 16 - length)
        footer = json.loads(f.read(length))
        counts, zigzag = (block(p) for p in footer["tables"])
        steps = (zigzag >> np.uint64(1)).view(np.int64) ^ -(zigzag & np.uint64(1)).view(np.int64)
        names = [None] * footer["n_null"] + np.cumsum(steps).tolist()
        places = iter(footer["blocks"])
        have = np.zeros(0, np.uint32)
        for name, count in zip(names, counts.astype(np.int64).tolist(), strict=True):
            if len(have) < count:
                parts, n = [have], len(have)
                while n < count:
                    parts.append(block(next(places)[0]).astype(np.uint32))
                    n += len(parts[-1])
                have = np.concatenate(parts)
            yield name, have[:count]
            have = have[count:]


def _read(spark: SparkSession, folder: str, schema: str, row: Callable) -> DataFrame:
    rows, start = [], 0
    for r in manifest(folder):
        rows.append((f"{folder}/{r['name']}", start))
        start += r["n_ids"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out, size = [], 0
                for doc_id, ids in documents_of(uri):
                    out.append(row(doc_id, at, ids))
                    at, size = at + len(ids), size + len(ids)
                    if size >= 1 << 20:
                        yield pa.RecordBatch.from_pylist(out, arrow)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    names = spark.createDataFrame(rows, "uri string, start long")
    return names.repartition(max(1, len(rows))).mapInArrow(work, schema)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's ids, and how many ids come before it."""

    def row(doc_id, start, ids):
        return {"doc_id": doc_id, "start": start, "ids": ids.astype(np.int64)}

    return _read(spark, folder, "doc_id long, start long, ids array<long>", row)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ids before it, their number and their CRC-32 (little-endian, 32 bits)."""

    def row(doc_id, start, ids):
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        return {"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": crc}

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _read(spark, folder, schema, row)
