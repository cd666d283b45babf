"""Token ids by the tokenizers library, with each distinct chunk encoded once a worker.

Ids do not reach across certain places, so texts are cut there; most chunks recur:

* byte-level vocabularies (``spaces_kept``): a single space before a character that is no
  white space begins a pre-token, and so does a single line break before such a
  character. Texts with any other white space are encoded in one piece.
* vocabularies that drop white space: every space and line break.
* texts that hold a special token of the vocabulary (as ``<|endoftext|>``) literally: nowhere. The
  library, by its default, makes one id of the token, and so do the ids here.
* a letter of ASCII or Latin-1 and a full stop or comma at a chunk's end.

Chunks are found, hashed (64 bits) and looked up with numpy; the library encodes those that
the worker has not met. The ids equal those of the whole texts; ``tests/llm`` compares them.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import BYTE_VALUES, LOWER_VALUES, Texts, mixed

#: Distinct chunks that a worker remembers before it starts anew: a bound on memory
#: (about 100 MB), not on what is encoded.
REMEMBERED = 1 << 21
_ODD_BYTES = np.zeros(256, bool)
_ODD_BYTES[[9, 11, 12, 13, 28, 29, 30, 31]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class _Known:
    """Ids by 64-bit key: open addressing, probed for many keys at once."""

    def __init__(self, bits: int = REMEMBERED.bit_length()):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.entry = np.zeros(1 << bits, np.int32)
        self.starts = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.uint32)
        self.n = self.filled = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left, slots = np.arange(len(keys)), keys & self.mask
        while left.size:
            there = self.keys[slots]
            hit = there == keys[left]
            out[left[hit]] = self.entry[slots[hit]]
            on = ~hit & (there != 0)
            left, slots = left[on], (slots[on] + np.uint64(1)) & self.mask
        return out

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        """New distinct keys."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        total = self.filled + int(sizes.sum())
        while len(self.starts) <= self.n + len(keys):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
        while len(self.pool) < total:
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        flat = (i for part in ids for i in part)
        self.pool[self.filled : total] = np.fromiter(flat, np.uint32, total - self.filled)
        self.starts[self.n + 1 : self.n + 1 + len(keys)] = self.filled + np.cumsum(sizes)
        left, slots, number = keys, keys & self.mask, np.arange(self.n, self.n + len(keys))
        while left.size:
            free = self.keys[slots] == 0
            self.keys[slots[free]] = left[free]
            won = free & (self.keys[slots] == left)
            self.entry[slots[won]] = number[won]
            on = ~won
            left, number = left[on], number[on]
            slots = (slots[on] + np.uint64(1)) & self.mask
        self.n, self.filled = self.n + len(keys), total


class Encoder:
    def __init__(self, path: str, spaces_kept: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in special if t.special]
        self.spaces_kept = spaces_kept
        self.values = BYTE_VALUES if spaces_kept else LOWER_VALUES
        self.known = _Known()
        self.marks = {m: self._ids([m])[0] for m in (".", ",", "\n")}
        # A mark must be one id for the flat layout below; else chunks keep their marks.
        self.marks_cut = all(len(self.marks[m]) == 1 for m in (".", ","))

    def _ids(self, texts: list[str], whole: bool = False) -> list[list[int]]:
        # Chunks are remembered by hashes that may ignore case, special tokens do not: these
        # count in whole texts only.
        self.tokenizer.encode_special_tokens = not whole
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def _odd(self, texts: Texts) -> np.ndarray:
        """Which texts hold white space that a cut might divide wrongly."""
        if not self.spaces_kept:
            return np.zeros(len(texts), bool)
        if len(self.marks["\n"]) != 1:
            return np.ones(len(texts), bool)
        data, n = texts.data, len(texts.data)
        gap = (data == 32) | (data == 10)
        odd = _ODD_BYTES[data]
        odd[1:] |= gap[1:] & gap[:-1]
        for i in np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))).tolist():
            lead = bytes(data[i : i + 3])
            odd[i] = lead[:2] in (b"\xc2\x85", b"\xc2\xa0") or lead.decode("utf8", "ignore").isspace()
        full = np.flatnonzero(np.diff(texts.offsets) > 0)
        out = texts.per_text(odd) > 0
        out[full] |= gap[texts.offsets[full]] | gap[texts.offsets[full + 1] - 1]
        return out if n else np.zeros(len(texts), bool)

    def forget(self) -> None:
        """Give the room of what is remembered back, as a task ends and its worker waits."""
        self.known = _Known()

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null: none."""
        texts = _Chunks(column)
        texts.values = self.values
        odd = self._odd(texts)
        for token in self.special:
            held = pc.fill_null(pc.match_substring(column, token), False)
            odd = odd | held.to_numpy(zero_copy_only=False)
        data = texts.data
        starts, ends = texts.starts, texts.ends.copy()
        cut = np.zeros(len(starts), bool)
        if self.marks_cut and len(starts):
            last, before = data[ends - 1], data[np.maximum(ends - 2, starts)]
            lead = data[np.maximum(ends - 3, starts)]
            latin = (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
            mark = (last == ord(".")) | (last == ord(","))
            cut = mark & (ends - starts > 1) & (_LETTER[before] | (latin & (ends - starts > 2)))
            ends -= cut
        before = np.where(starts > 0, data[np.maximum(starts - 1, 0)], 10) if len(starts) else starts
        opening = np.zeros(len(starts), bool)
        opening[texts.first[:-1][np.diff(texts.first) > 0]] = True
        spaced = (before == 32) & ~opening & self.spaces_kept
        broken = (before == 10) & ~opening & self.spaces_kept
        keys = mixed(texts.slice_hashes(starts, ends) + spaced.astype(np.uint64)) | np.uint64(1)
        entry = self.known.find(keys)
        if (entry < 0).any():
            new, at = np.unique(keys[entry < 0], return_index=True)
            at = np.flatnonzero(entry < 0)[at]
            if self.known.n + len(new) > REMEMBERED:
                self.known = _Known(max(REMEMBERED, 2 * len(keys)).bit_length())
                new, at = np.unique(keys, return_index=True)
            spans = zip(starts[at].tolist(), ends[at].tolist(), spaced[at].tolist(), strict=True)
            raw = data.tobytes()
            words = [" " * s + raw[a:b].decode("utf8") for a, b, s in spans]
            self.known.add(new, self._ids(words))
            entry = self.known.find(keys)
        begin = self.known.starts[entry]
        sizes = self.known.starts[entry + 1] - begin
        space = sizes + broken + cut
        total = np.concatenate(([0], np.cumsum(space)))
        out = np.empty(total[-1], np.uint32)
        lead = total[:-1] + broken
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(lead, sizes) + inner] = self.known.pool[np.repeat(begin, sizes) + inner]
        if self.spaces_kept and broken.any():
            out[total[:-1][broken]] = self.marks["\n"][0]
        if cut.any():
            dots = data[ends[cut]] == ord(".")
            out[total[1:][cut] - 1] = np.where(dots, self.marks["."][0], self.marks[","][0])
        bounds = total[texts.first]
        rows = [out[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd).tolist():
            rows[i] = np.array(self._ids([column[i].as_py() or ""], whole=True)[0], np.uint32)
        return rows


class _Chunks(Texts):
    """Texts cut at spaces and line breaks alone."""

    gaps = (32, 10)


@lru_cache(maxsize=2)
def encoder(path: str, spaces_kept: bool) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path, spaces_kept)
