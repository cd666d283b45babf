"""Words, lines and rolling hashes of many texts at once, as numpy arrays.

A word is a run of bytes other than space and tab to carriage return; these are
ASCII, so UTF-8 bytes can be cut without decoding. A prefix hash is the sum of
``value(byte) * BASE**position`` modulo 2**64, so that the hash of any slice is a
difference of two sums, moved back to position 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
STEP = np.uint64(0xC2B2AE3D27D4EB4F)
#: Texts are handled in runs of about so many bytes, which bounds a task's memory.
RUN_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * STEP)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        out = np.full(1 << bits, np.uint64(base))
        out[0] = 1
        return np.multiply.accumulate(out)

    return of(BASE), of(pow(BASE, -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    return _powers(max(20, int(n - 1).bit_length()))


class Texts:
    """The bytes of some texts, and where their words lie.

    Word ``i`` is ``data[starts[i]:ends[i]]``; text ``t`` has the words
    ``first[t]`` to ``first[t + 1]`` and the bytes ``offsets[t]`` to ``offsets[t + 1]``.
    """

    gaps = (0x20, *range(0x09, 0x0E))

    def __init__(self, column: pa.Array, lower: bool = False):
        column = column.cast(pa.large_string()).fill_null("")
        n = len(column)
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
        low = int(ends[0]) if n else 0
        self.offsets = ends - low
        raw = column.buffers()[2]
        size = int(self.offsets[-1]) if n else 0
        self.data = np.frombuffer(raw, np.uint8, size, low) if size else np.zeros(0, np.uint8)
        self.values = LOWER_VALUES if lower else BYTE_VALUES
        inside = np.ones(256, bool)
        inside[list(self.gaps)] = False
        self.inside = inside[self.data]
        first_bytes = self.offsets[:-1]
        begins, closes = self.inside.copy(), self.inside.copy()
        begins[1:] &= ~self.inside[:-1]
        closes[:-1] &= ~self.inside[1:]
        at = first_bytes[(first_bytes > 0) & (first_bytes < size)]
        begins[at] = self.inside[at]
        closes[at - 1] = self.inside[at - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def slice_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = powers(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(self.values[self.data] * up[: len(self.data)], out=self._sums[1:])
        raw = (self._sums[ends] - self._sums[starts]) * down[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * STEP)

    def word_hashes(self) -> np.ndarray:
        return self.slice_hashes(self.starts, self.ends)

    def shingles(self, size: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words and the text of each, in order.

        ``whole``: a text of one to ``size - 1`` words gives all its words as one.
        """
        return windows(self.word_hashes(), self.first, size, whole)


def windows(hashes: np.ndarray, first: np.ndarray, size: int, whole: bool = False):
    """As ``Texts.shingles``, from word hashes and each text's first word."""
    counts = np.diff(first)
    per_text = np.maximum(counts - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), per_text)
    inner = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    at = first[:-1][text] + inner
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        out = out * STEP + hashes[at + j]
    if whole and (short := np.flatnonzero((counts > 0) & (counts < size))).size:
        more = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            has = counts[short] > j
            more[has] = more[has] * STEP + hashes[first[short[has]] + j]
        more += counts[short].astype(np.uint64)
        text, out = np.concatenate((text, short)), np.concatenate((out, more))
        order = np.argsort(text, kind="stable")
        text, out = text[order], out[order]
    return mixed(out), text


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a text column into stretches of about ``limit`` bytes."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the 64-bit keys occur more than once.

    Keys whose slot in a small table is theirs alone need no sorting.
    """
    out = np.zeros(len(keys), bool)
    if len(keys) < 2:
        return out
    bits = min(24, int(len(keys)).bit_length() + 2)
    slots = (keys >> np.uint64(64 - bits)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(slots, minlength=1 << bits)[slots] > 1)
    if maybe.size:
        order = maybe[np.argsort(keys[maybe], kind="stable")]
        same = keys[order[1:]] == keys[order[:-1]]
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out
