"""Hierarchical packing of tokenised documents into context windows of several lengths.

Documents are handled in lots of about ``LOT_IDS`` ids, as they come in a partition: no
shuffle, and no key that could be hot. In a lot, each document gives whole windows of the
longest tier; what remains of it is routed to the shortest tier that holds it. From the
longest tier down, each routed piece opens a window of its tier, whose gap is filled
with the best fitting pieces of shorter tiers, and at last by cutting one. Windows left with
a gap when no shorter piece remains feed each other, so that a lot ends with one window
at most that is not full; it is cut into tiers as well.

Full windows are dealt to step groups of ``STEP_WINDOWS`` windows of one tier, by the sum
of the squared piece lengths (the work of attention within pieces), largest first, back and
forth, so that groups cost about the same.

Null or empty texts are their end id alone. Each row is packed, repeated ones too; null
doc_ids stay null. Only ``doc_id`` and ``text`` are read. No rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .storage import give_back
from .tokens import encoder
from .words import runs

#: Context lengths, powers of two; the last is the longest.
TIERS = (256, 512, 1024, 2048)
LOT_IDS = 1 << 21
STEP_WINDOWS = 8

#: A piece: (document's place in the lot, its first id, its length).
Piece = tuple[int, int, int]


class _Pool:
    """Pieces shorter than the longest window, by length."""

    def __init__(self):
        self.by_length: dict[int, list[Piece]] = {}
        self.lengths = 0  # bit n is set if there is a piece of length n

    def put(self, piece: Piece) -> None:
        self.by_length.setdefault(piece[2], []).append(piece)
        self.lengths |= 1 << piece[2]

    def longest(self, most: int) -> int:
        """The greatest length up to ``most``; 0: none."""
        return max(0, (self.lengths & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.lengths &= ~(1 << length)
        return piece


def pack_lot(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """Windows as (tier, pieces) for documents of these sizes.

    Each window but one at most is as long as its tier; each id lies in one piece.
    """
    top = tiers[-1]
    windows: list[tuple[int, list[Piece]]] = []
    pool = _Pool()
    for doc, size in enumerate(sizes):
        whole = size - size % top
        windows += ((top, [(doc, at, top)]) for at in range(0, whole, top))
        if size > whole:
            pool.put((doc, whole, size - whole))
    open_windows: list[tuple[int, list[Piece]]] = []
    for k in range(len(tiers) - 1, -1, -1):
        tier, below = tiers[k], tiers[k - 1] if k else 0
        while (length := pool.longest(tier)) > below:
            pieces, gap = [pool.take(length)], tier - length
            while gap and (length := pool.longest(gap)):
                pieces.append(pool.take(length))
                gap -= length
            if gap and (length := pool.longest(below)):  # longer than the gap: cut it
                doc, at, length = pool.take(length)
                pieces.append((doc, at, gap))
                pool.put((doc, at + gap, length - gap))
                gap = 0
            (open_windows if gap else windows).append((tier, pieces))
    # Nothing shorter is left: the pieces of the emptiest windows fill the others.
    loose = sorted((p for _, pieces in open_windows for p in pieces), key=lambda p: -p[2])
    pieces, gap = [], top
    for doc, at, length in loose:
        while length:
            part = min(length, gap)
            pieces.append((doc, at, part))
            at, length, gap = at + part, length - part, gap - part
            if not gap:
                windows.append((top, pieces))
                pieces, gap = [], top
    rest = top - gap
    for tier in reversed(tiers):  # the last window, cut into tiers
        while rest >= tier or (rest and tier == tiers[0]):
            want, chosen = min(tier, rest), []
            rest -= want
            while want:
                doc, at, length = pieces.pop()
                part = min(length, want)
                chosen.append((doc, at, part))
                if length > part:
                    pieces.append((doc, at + part, length - part))
                want -= part
            windows.append((tier, chosen))
    return windows


def step_groups(windows: list[tuple[int, list[Piece]]]) -> list[int]:
    """A group number for each window: windows of one tier, of about equal cost together."""
    out, number = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}):
        own = [i for i, (t, _) in enumerate(windows) if t == tier]
        own.sort(key=lambda i: (-sum(p[2] ** 2 for p in windows[i][1]), i))
        groups = -(-len(own) // STEP_WINDOWS)
        for place, i in enumerate(own):
            lap, at = divmod(place, groups)
            out[i] = number + (groups - 1 - at if lap % 2 else at)
        number += groups
    return out


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, tier long, step_group long"
)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    spaces_kept: bool = False,
    with_ids: bool = False,
    forget: bool = False,
    lot_ids: int = LOT_IDS,
) -> DataFrame:
    """A row for each piece; ``with_ids`` adds its ids.

    ``forget``: a task gives back what its worker remembers of chunks, for the jobs that follow in
    the same workers; the next task learns them anew, which takes more than twice the time.
    ``lot_ids``: documents are packed in lots of about so many ids, which bounds a task's memory.
    ``sequence_id`` and ``step_group`` hold the partition's number in their upper bits.
    """
    schema = SCHEMA + ", ids array<long>" * with_ids

    def rows(lot: list[tuple[int | None, np.ndarray]], task: int, n_windows: int, n_groups: int):
        windows = pack_lot([len(ids) for _, ids in lot])
        out: list[list] = [[] for _ in range(9 + with_ids)]
        groups = step_groups(windows)
        for number, ((tier, pieces), group) in enumerate(zip(windows, groups, strict=True)):
            offset = 0
            for doc, at, length in pieces:
                doc_id, ids = lot[doc]
                part = ids[at : at + length]
                row = (doc_id, at, length, zlib.crc32(part.tobytes()), len(ids))
                row += ((task << 33) + n_windows + number, offset, tier, (task << 33) + n_groups + group)
                for values, value in zip(out, row, strict=False):
                    values.append(value)
                if with_ids:
                    out[9].append(part.astype(np.int64))
                offset += length
        arrays = [pa.array(v, pa.int64()) for v in out[:9]]
        arrays += [pa.array(v, pa.list_(pa.int64())) for v in out[9:]]
        batch = pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])
        return batch, n_windows + len(windows), n_groups + max(groups, default=-1) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, tokens = TaskContext.get().partitionId(), encoder(tokenizer, spaces_kept)
        end, lot, size, n_windows, n_groups = np.uint32(end_id), [], 0, 0, 0
        for batch in batches:
            for low, high in runs(batch.column(1)):
                names = batch.column(0).slice(low, high - low).to_pylist()
                ids_of = tokens.encode(batch.column(1).slice(low, high - low))
                for doc_id, ids in zip(names, ids_of, strict=True):
                    lot.append((doc_id, np.append(ids, end).astype("<u4")))
                    size += len(ids) + 1
                if size >= lot_ids:
                    batch_out, n_windows, n_groups = rows(lot, task, n_windows, n_groups)
                    yield batch_out
                    lot, size = [], 0
        if lot:
            yield rows(lot, task, n_windows, n_groups)[0]
        if forget:
            tokens.forget()
            lot = ids_of = batch = None
            give_back()

    return docs.select("doc_id", "text").mapInArrow(work, schema)
