"""Simple-8b: several unsigned integers in each 64-bit word.

The top four bits of a word select how many values its other 60 bits hold and how wide
each is. Selector 0 is the escape: its value (2**60 or more) stands in the block's list
of escaped values. Selector 1 stands for 120 zeros. The last word of a block may be
padded with zeros; the block's count says where to stop.

A block is ``n_values, n_words, n_escaped`` as unsigned 32-bit integers, then the words,
then the escaped values, all little-endian.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the format: (values, bits of each) by selector.
SELECTORS = (
    (1, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = 0
COUNTS = np.array([c for c, _ in SELECTORS])
WIDTHS = np.array([b for _, b in SELECTORS])
HEADER = np.dtype("<u4")
HEADER_BYTES = 3 * HEADER.itemsize
#: The least selector (from 1 on) whose width holds a number of so many bits; 16: an escape.
_CLASS_OF_BITS = np.array(
    [next((s for s in range(1, 16) if WIDTHS[s] >= b), 16) for b in range(65)], np.uint8
)
_SMALL = _CLASS_OF_BITS[[int(v).bit_length() for v in range(1 << 16)]]


def _classes(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < 1 << 16:
        return _SMALL[values]
    edges = np.array([1 << int(w) for w in WIDTHS[1:]], np.uint64)
    return (1 + np.searchsorted(edges, values, "right")).astype(np.uint8)


def _choices(classes: np.ndarray) -> np.ndarray:
    """The selector a word would have that begins at each position, most values first."""
    n = len(classes)
    maxima = {1: np.concatenate((classes, np.ones(128, np.uint8)))}
    while (p := max(maxima)) < 64:
        maxima[2 * p] = np.maximum(maxima[p][:-p], maxima[p][p:])
    out = np.zeros(n, np.uint8)
    for selector in range(15, 0, -1):
        count = int(COUNTS[selector])
        p = 1 << (count.bit_length() - 1)
        high = np.maximum(maxima[p][:n], maxima[p][count - p : count - p + n])
        out[high <= selector] = selector
    return out


def encode_block(values: np.ndarray) -> bytes:
    """Values of any unsigned type as one block."""
    n = len(values)
    values = values.astype(np.uint64)
    choices = _choices(_classes(values))
    steps = COUNTS[choices].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    selectors = choices[starts]
    padded = np.concatenate((values, np.zeros(128, np.uint64)))
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors):
        count, width = SELECTORS[selector]
        if width:
            here = np.flatnonzero(selectors == selector)
            shifts = (np.arange(count) * width).astype(np.uint64)
            packed = padded[starts[here][:, None] + np.arange(count)] << shifts
            words[here] |= np.bitwise_or.reduce(packed, axis=1)
    escaped = values[starts[selectors == ESCAPE]]
    header = np.array([n, len(words), len(escaped)], HEADER)
    return header.tobytes() + words.astype("<u8").tobytes() + escaped.astype("<u8").tobytes()


def block_size(header: bytes) -> tuple[int, int]:
    """Values in the block, and its bytes after the header."""
    n, words, escaped = np.frombuffer(header, HEADER, 3).tolist()
    return n, 8 * (words + escaped)


def decode_block(header: bytes, body: bytes) -> np.ndarray:
    n, n_words, n_escaped = np.frombuffer(header, HEADER, 3).tolist()
    numbers = np.frombuffer(body, "<u8", n_words + n_escaped)
    words, escaped = numbers[:n_words], numbers[n_words:]
    selectors = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[selectors])
    out = np.zeros(int(ends[-1]) if n_words else 0, np.uint64)
    for selector in np.unique(selectors):
        count, width = SELECTORS[selector]
        here = np.flatnonzero(selectors == selector)
        first = ends[here] - count
        if selector == ESCAPE:
            out[first] = escaped
        elif width:
            shifts = (np.arange(count) * width).astype(np.uint64)
            mask = np.uint64((1 << width) - 1)
            out[first[:, None] + np.arange(count)] = (words[here][:, None] >> shifts) & mask
    return out[:n]
