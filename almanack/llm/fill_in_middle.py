"""Fill-in-the-middle by piece tables.

A document is a list of descriptors (buffer, begin, end) over two buffers that never change: the
bytes of its text and the sentinels. Cutting splits descriptors, an arrangement permutes
them with sentinels between, and the inverse permutation restores the text. Hashes are
streamed over the descriptors; a new text is copied together only where it is wanted as a
column.

A text is cut into units, its lines (with their line feed); the prefix ends after the smaller, the middle after the larger
of two numbers of units drawn from a hash of seed and doc_id. Forms: ``psm`` is prefix, suffix, middle, each after
its sentinel; ``spm`` is suffix, prefix, middle; ``plain`` is the text as it is.

Nulls: a null text is an empty one, which is plain. A null doc_id is hashed as an empty
number. A text that holds a sentinel is plain. Rows are independent: repeated
rows give the same, ties cannot arise, an empty table gives an empty one. Columns of the documents other
than doc_id and text are left out, whatever their names. Memory is bounded by the longest text: its bytes
are looked at in stretches, and its output is one copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import runs

SEED = 7
#: Per cent of documents that are transformed, and of these that are suffix first.
FIM_PERCENT, SPM_PERCENT = 100, 50
#: The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: The order of the parts (0 prefix, 1 middle, 2 suffix) by form.
ARRANGED = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: Where the sentinel of each part lies in SENTINELS.
MARK = {0: (0, 3), 2: (3, 6), 1: (6, 9)}
TEXT, MARKS = 0, 1
#: Bytes looked at in one go.
STRETCH = 1 << 20

FORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"


class Piece(NamedTuple):
    """Bytes ``begin`` to ``end`` of a buffer."""

    buffer: int
    begin: int
    end: int


def cut(pieces: list[Piece], *places: int) -> list[list[Piece]]:
    """Split a piece table at ascending places, counted in bytes from its start."""
    out, at = [[]], 0
    left = list(places)
    for piece in pieces:
        while left and left[0] <= at + piece.end - piece.begin:
            middle = piece.begin + left.pop(0) - at
            if middle > piece.begin:
                out[-1].append(Piece(piece.buffer, piece.begin, middle))
            at += middle - piece.begin
            piece = Piece(piece.buffer, middle, piece.end)
            out.append([])
        if piece.end > piece.begin:
            out[-1].append(piece)
            at += piece.end - piece.begin
    return out + [[] for _ in left]


def arrange(parts: list[list[Piece]], form: str) -> list[Piece]:
    """The three parts in the order of the form, each after its sentinel."""
    out = []
    for k in ARRANGED[form]:
        out += [Piece(MARKS, *MARK[k]), *parts[k]]
    return out


def disarrange(segments: list[list[Piece]], form: str) -> list[Piece]:
    """The inverse permutation: segments in the order of the form, back in that of the text."""
    order = ARRANGED[form]
    inverse = sorted(range(len(order)), key=order.__getitem__)
    return [piece for k in inverse for piece in segments[k]]


def segments_of(output: memoryview, form: str) -> list[list[Piece]]:
    """What lies after each sentinel of an output, as pieces of that output.

    No text with sentinels is arranged, so each of them is there once; and no sentinel can
    begin in the end of a part, as it would have to begin again within itself.
    """
    raw, out = bytes(output), []
    places = [raw.find(SENTINELS[slice(*MARK[k])]) for k in ARRANGED[form]]
    if places[0] != 0 or sorted(places) != places:
        raise ValueError("not an output of this form")
    for begin, end in zip(places, [*places[1:], len(raw)], strict=True):
        out.append([Piece(TEXT, begin + len(PREFIX), end)])
    return out


def views(pieces: list[Piece], text: memoryview) -> Iterator[memoryview]:
    buffers = (text, memoryview(SENTINELS))
    for piece in pieces:
        yield buffers[piece.buffer][piece.begin : piece.end]


def digest(pieces: list[Piece], text: memoryview) -> str:
    """SHA-256 in hex, streamed over the pieces."""
    out = hashlib.sha256()
    for view in views(pieces, text):
        out.update(view)
    return out.hexdigest()


def count_units(text: np.ndarray) -> int:
    feeds = sum(int(np.count_nonzero(text[i : i + STRETCH] == 10)) for i in range(0, len(text), STRETCH))
    return feeds + bool(len(text) and text[-1] != 10)


def end_of_unit(text: np.ndarray, k: int) -> int:
    """Bytes of the first k units."""
    if not k:
        return 0
    for i in range(0, len(text), STRETCH):
        feeds = np.flatnonzero(text[i : i + STRETCH] == 10)
        if k <= len(feeds):
            return i + int(feeds[k - 1]) + 1
        k -= len(feeds)
    return len(text)


def code_points(text: np.ndarray) -> int:
    return sum(int(np.count_nonzero((text[i : i + STRETCH] & 0xC0) != 0x80)) for i in range(0, len(text), STRETCH))


class Transform:
    """What is drawn for a document, by seed and percentages."""

    def __init__(self, seed: int, fim_percent: int, spm_percent: int):
        self.seed, self.fim_percent, self.spm_percent = seed, fim_percent, spm_percent

    def __call__(self, doc_id: int | None, text: memoryview) -> tuple:
        """n, form, chars of prefix and middle, and the piece table of the output."""
        data = np.frombuffer(text, np.uint8)
        n = count_units(data)
        name = f"{self.seed}:{'' if doc_id is None else doc_id}"
        drawn = hashlib.sha256(name.encode()).hexdigest()
        h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in range(0, 32, 8))
        whole = [Piece(TEXT, 0, len(data))]
        if not len(data) or h3 % 100 >= self.fim_percent or holds_sentinel(text):
            return n, "plain", None, None, whole
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = end_of_unit(data, first), end_of_unit(data, second)
        form = "spm" if h4 % 100 < self.spm_percent else "psm"
        return n, form, code_points(data[:a]), code_points(data[a:b]), arrange(cut(whole, a, b), form)


def holds_sentinel(text: memoryview) -> bool:
    raw = bytes(text)
    return any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE))


def _texts(column: pa.Array) -> Iterator[memoryview]:
    """The bytes of each text, not copied; a null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = memoryview(column.buffers()[2] or b"")
    for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield raw[begin:end]


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """A row for each document: doc_id, n (units), form, prefix_chars, middle_chars, output, output_sha256."""
    transform = Transform(seed, fim_percent, spm_percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in runs(batch.column(1)):
                ids = batch.column(0).slice(low, high - low)
                rows = []
                texts = _texts(batch.column(1).slice(low, high - low))
                for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
                    n, form, prefix, middle, pieces = transform(doc_id, text)
                    output = b"".join(views(pieces, text))
                    rows.append((n, form, prefix, middle, output, digest(pieces, text)))
                n, form, prefix, middle, output, sha = zip(*rows, strict=True)
                columns = [ids, pa.array(n, pa.int64()), pa.array(form)]
                columns += [pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), _strings(output), pa.array(sha)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [c.split()[0] for c in FORMED.split(", ")]
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(work, FORMED)


def restored(formed: DataFrame) -> DataFrame:
    """The columns of ``formed`` but its output, with the ``text`` rebuilt from output and form."""
    return _over_outputs(formed, "text string", lambda pieces, output: b"".join(views(pieces, output)))


def restored_digests(formed: DataFrame) -> DataFrame:
    """As ``restored``, with the text's SHA-256 as ``restored_sha256`` in its place: nothing is copied."""
    return _over_outputs(formed, "restored_sha256 string", lambda pieces, output: digest(pieces, output).encode())


def _over_outputs(formed: DataFrame, column: str, value) -> DataFrame:
    keep = [c for c in formed.columns if c not in ("output", column.split()[0])]
    schema = ", ".join(f"`{c}` {formed.schema[c].dataType.simpleString()}" for c in keep) + f", {column}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form, output = (batch.column(batch.schema.get_field_index(c)) for c in ("form", "output"))
            for low, high in runs(output):
                rows = []
                texts = _texts(output.slice(low, high - low))
                for kind, text in zip(form.slice(low, high - low).to_pylist(), texts, strict=True):
                    pieces = [Piece(TEXT, 0, len(text))]
                    if kind != "plain":
                        pieces = disarrange(segments_of(text, kind), kind)
                    rows.append(value(pieces, text))
                part = batch.slice(low, high - low).select(keep)
                yield pa.RecordBatch.from_arrays([*part.columns, _strings(rows)], [*keep, column.split()[0]])

    return formed.select(*keep, *([] if "output" in keep else ["output"])).mapInArrow(work, schema)


def _strings(values) -> pa.Array:
    """A text column of bytes that came from one, as they are."""
    ends = np.cumsum([0, *map(len, values)])
    kind = (pa.string(), np.int32) if ends[-1] < 1 << 31 else (pa.large_string(), np.int64)
    buffers = [None, pa.py_buffer(ends.astype(kind[1])), pa.py_buffer(b"".join(values))]
    return pa.Array.from_buffers(kind[0], len(values), buffers)
