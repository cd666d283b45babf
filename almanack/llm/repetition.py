"""Quality rules: how much of a text lies inside repeated n-grams and lines.

Rolling hashes of n-grams of several lengths are compared within each text. For
each length, the characters of all words inside n-grams that occur twice or more
(the first included, each character once) are measured against the characters of all
words; lines likewise. A text is rejected by the base rule (too few words, or too many
words in repeated 5-word windows) or if a coverage exceeds its limit.

Null and empty texts have no words and fail the base rule. Rows are independent, so
repeated rows, ties and null ids need no care; a column named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .storage import give_back
from .words import Texts, mixed, repeated, runs, windows

#: Largest share of the characters of words inside repeated n-grams, by n-gram length.
NGRAM_LIMITS = {3: 0.50, 5: 0.30, 7: 0.25, 10: 0.20}
#: Largest share of the characters of words on repeated lines.
LINE_LIMIT = 0.30
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
    "dup_line_share": pa.float64(),
    "dup_ngram_shares": pa.list_(pa.float64()),
}


def _covered(texts: Texts, hashes, text, size: int) -> np.ndarray:
    """Which words lie inside a window of ``size`` words that its text repeats."""
    marks = np.zeros(len(texts.starts) + 1, np.int32)
    again = repeated(mixed(hashes ^ mixed(text.astype(np.uint64))))
    counts = np.diff(texts.first)
    per_text = np.maximum(counts - size + 1, 0)
    inner = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    at = (texts.first[:-1][text] + inner)[again]
    np.add.at(marks, at, 1)
    np.add.at(marks, at + size, -1)
    return np.cumsum(marks[:-1]) > 0


def _lines(texts: Texts, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines equal to an earlier one, and characters of words on repeated lines."""
    n, size = len(texts), len(texts.data)
    breaks = np.flatnonzero(texts.data == 10)
    # Each text's first byte and each byte after a break begins a line; empty lines have no word.
    starts = np.unique(np.concatenate((texts.offsets[:-1], breaks + 1)))
    starts = starts[starts < size]
    owner = np.searchsorted(texts.offsets, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], size), texts.offsets[owner + 1])
    ends = ends - ((ends > starts) & (texts.data[np.maximum(ends - 1, 0)] == 10))
    words = np.concatenate(([0], np.cumsum(chars)))
    weight = words[ends] - words[starts]
    full = weight > 0
    starts, ends, owner, weight = starts[full], ends[full], owner[full], weight[full]
    keys = mixed(texts.slice_hashes(starts, ends) ^ mixed(owner.astype(np.uint64)))
    again = np.flatnonzero(repeated(keys))
    covered = np.bincount(owner[again], weight[again], n)
    distinct, place = np.unique(keys[again], return_index=True)
    extra = np.bincount(owner[again], minlength=n) - np.bincount(owner[again][place], minlength=n)
    return extra.astype(np.int64), covered


def measure(column: pa.Array) -> dict[str, pa.Array]:
    """The columns of ``MEASURES`` for some texts."""
    texts = Texts(column)
    n_words = np.diff(texts.first)
    whole_chars = (texts.data & 0xC0) != 0x80
    chars = whole_chars & texts.inside
    word_chars = texts.per_text(chars)
    ends = np.concatenate(([0], np.cumsum(chars, dtype=np.int64)))
    lengths = ends[texts.ends] - ends[texts.starts]
    owner = np.repeat(np.arange(len(texts)), n_words)
    share = np.maximum(word_chars, 1)
    hashes = texts.word_hashes()
    shares, repeat_words = [], None
    for size in sorted({WINDOW, *NGRAM_LIMITS}):
        inside = _covered(texts, *windows(hashes, texts.first, size), size)
        if size == WINDOW:
            repeat_words = np.bincount(owner[inside], minlength=len(texts))
        if size in NGRAM_LIMITS:
            shares.append(np.bincount(owner[inside], lengths[inside], len(texts)) / share)
    dup_lines, line_chars = _lines(texts, chars)
    line_share = line_chars / share
    failed = (n_words < MIN_WORDS) | (100 * repeat_words > MAX_REPEAT_PERCENT * n_words)
    limits = [NGRAM_LIMITS[size] for size in sorted(NGRAM_LIMITS)]
    over = np.any([s > limit for s, limit in zip(shares, limits, strict=True)], axis=0)
    rows = np.stack(shares, axis=1).ravel()
    values = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": texts.per_text(SYMBOL[texts.data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
        "base_failed": failed,
        "kept": ~failed & ~over & (line_share <= LINE_LIMIT),
        "dup_line_share": line_share,
    }
    out = {k: pa.array(v, MEASURES[k]) for k, v in values.items()}
    cuts = np.arange(len(texts) + 1, dtype=np.int32) * len(shares)
    out["dup_ngram_shares"] = pa.ListArray.from_arrays(pa.array(cuts), pa.array(rows))
    return out


def repetition_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with its measures and the verdict ``kept``."""
    keep = [c for c in docs.columns if c != text and c not in MEASURES]
    schema = T.StructType([docs.schema[c] for c in keep])
    for name, kind in MEASURES.items():
        schema.add(name, _SPARK[str(kind)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for begin, end in runs(column):
                part = batch.slice(begin, end - begin)
                measured = measure(column.slice(begin, end - begin))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), *measured.values()],
                    names=[*keep, *measured],
                )

    return docs.select(*keep, text).mapInArrow(work, schema)


def keep_unrepetitive(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for begin, end in runs(column):
                part = batch.slice(begin, end - begin)
                yield part.filter(measure(column.slice(begin, end - begin))["kept"])
        give_back()

    return docs.mapInArrow(work, docs.schema)


_SPARK = {
    "int64": T.LongType(),
    "bool": T.BooleanType(),
    "double": T.DoubleType(),
    "list<item: double>": T.ArrayType(T.DoubleType()),
}
