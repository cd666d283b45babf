"""Benchmark decontamination: short test items found inside long documents.

Size-partitioned MinHash containment search. Items fall into bands by their number of
distinct five-word shingles. An item's sketch is the least hashes of its shingles; its length
is set by the band so that a document with the wanted share of the item's shingles must hold
some of the sketch: of n shingles at most n - need are missing, so of s sketch hashes at
least s - (n - need) are there. That many hits make a candidate; a document with fewer
windows than the band's least need is not searched. Candidates are then verified by
the shingles themselves, as text. No pair at or above the limit is lost.

Words are runs of characters other than space and tab to carriage return, A-Z in lower
case. An item of fewer than five words is one shingle, searched among the documents' windows
of as many words. Null or empty items match nothing; null or empty documents hold nothing.
Repeated items count once, repeated documents are all reported. No rows on either side: no
pairs. Only ``doc_id``, ``text`` and ``item_id`` are read.

Items are searched in blocks of about ``BLOCK_WORDS`` words, each broadcast in turn, so a
larger benchmark takes more passes and not more memory. There is no shuffle of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import give_back
from .words import Texts, runs

SHINGLE = 5
#: Least share, in percent, of an item's distinct shingles.
CONTAINMENT = 75
BLOCK_WORDS = 200_000
#: Sketch hashes beyond those that may all be missing; more hits are asked for instead.
SPARE = 3
_FILTER_BITS = 22
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_texts(text: str | None, size: int = SHINGLE) -> set[str]:
    """The distinct shingles of a text; a shorter text is one shingle."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return set()
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


class Index:
    """Sketches of some items, by shingle length."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.items = []
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            shingles = shingle_texts(text)
            if not shingles:
                continue
            size = min(SHINGLE, next(iter(shingles)).count(" ") + 1)
            hashes, _ = Texts(pa.array([text]), lower=True).shingles(size)
            n = len(shingles)
            need = -(-CONTAINMENT * n // 100)
            band = n.bit_length()  # sizes 2**(band-1) to 2**band - 1
            length = (100 - CONTAINMENT) * ((1 << band) - 1) // 100 + 1 + SPARE
            sketch = np.unique(hashes)[:length]
            hits = max(1, len(sketch) - (n - need))
            least_windows = -(-CONTAINMENT * (1 << (band - 1)) // 100)
            by_size.setdefault(size, []).append((len(self.items), sketch))
            self.items.append((item_id, shingles, need, hits, least_windows))
        self.tables = {}
        for size, sketches in by_size.items():
            hashes = np.concatenate([s for _, s in sketches])
            owners = np.concatenate([np.full(len(s), i) for i, s in sketches])
            order = np.argsort(hashes, kind="stable")
            self.tables[size] = hashes[order], owners[order]
        self.hits = np.array([i[3] for i in self.items], np.int64)
        self.least_windows = np.array([i[4] for i in self.items], np.int64)

    def filters(self) -> dict[int, np.ndarray]:
        out = {}
        for size, (hashes, _) in self.tables.items():
            out[size] = np.zeros(1 << _FILTER_BITS, bool)
            out[size][hashes >> np.uint64(64 - _FILTER_BITS)] = True
        return out

    def candidates(self, column: pa.Array, filters: dict[int, np.ndarray]) -> np.ndarray:
        """Pairs (text, item) whose sketch has enough hits."""
        texts = Texts(column, lower=True)
        words, out = np.diff(texts.first), [np.zeros((0, 2), np.int64)]
        for size, (hashes, owners) in self.tables.items():
            found, text = texts.shingles(size)
            maybe = np.flatnonzero(filters[size][found >> np.uint64(64 - _FILTER_BITS)])
            found, text = found[maybe], text[maybe]
            low, high = np.searchsorted(hashes, found), np.searchsorted(hashes, found, "right")
            times = high - low
            text, entry = np.repeat(text, times), np.repeat(low, times)
            entry += np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times)
            wide = words[text] - size + 1 >= self.least_windows[owners[entry]]
            hit = np.unique(np.stack((text[wide], entry[wide]), axis=1), axis=0)
            pairs = np.stack((hit[:, 0], owners[hit[:, 1]]), axis=1)
            pairs, count = np.unique(pairs, axis=0, return_counts=True)
            out.append(pairs[count >= self.hits[pairs[:, 1]]])
        return np.concatenate(out)

    def matches(self, column: pa.Array, filters: dict[int, np.ndarray]) -> Iterator[tuple]:
        """Verified (text, item_id, shared shingles, the item's shingles)."""
        last, sets = -1, {}
        pairs = self.candidates(column, filters)
        for text, item in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
            if text != last:
                last, sets = text, {}
            item_id, shingles, need, *_ = self.items[item]
            size = next(iter(shingles)).count(" ") + 1
            if size not in sets:
                sets[size] = shingle_texts(column[text].as_py(), size)
            shared = len(shingles & sets[size])
            if shared >= need:
                yield text, item_id, shared, len(shingles)


def _blocks(items: DataFrame) -> Iterator[Broadcast]:
    """The benchmark as broadcast indexes of bounded size."""
    items = items.select("item_id", "text").dropDuplicates()
    count = F.size(F.split(F.col("text"), r"[\x20\x09-\x0D]+"))
    words = items.agg(F.sum(count)).first()[0] or 0
    n = max(1, -(-words // BLOCK_WORDS))
    for block in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield items.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in part.collect()]))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of a document and an item with at least the wanted share of its shingles."""
    names = ["doc_id", "item_id", "n_shared", "n_shingles", "containment"]
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField("item_id", items.schema["item_id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in names[2:4]]
        + [T.StructField("containment", T.DoubleType())]
    )

    def search(block: Broadcast):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = block.value
            filters = index.filters()
            for batch in batches:
                for low, high in runs(batch.column(1)):
                    part = batch.slice(low, high - low)
                    found = list(index.matches(part.column(1), filters))
                    if found:
                        rows, item, shared, size = zip(*found, strict=True)
                        share = [a / b for a, b in zip(shared, size, strict=True)]
                        ids = part.column(0).take(pa.array(rows))
                        arrays = [ids, *(pa.array(c) for c in (item, shared, size, share))]
                        yield pa.RecordBatch.from_arrays(arrays, names=names)

        return work

    out = None
    for block in _blocks(items):
        pairs = docs.select("doc_id", "text").mapInArrow(search(block), schema)
        out = pairs if out is None else out.union(pairs)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no item."""
    at = docs.columns.index(text)

    def keep(block: Broadcast):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = block.value
            filters = index.filters()
            for batch in batches:
                for low, high in runs(batch.column(at)):
                    part = batch.slice(low, high - low)
                    clean = np.ones(len(part), bool)
                    clean[[m[0] for m in index.matches(part.column(at), filters)]] = False
                    yield part.filter(pa.array(clean))
            index = filters = None
            give_back()

        return work

    for block in _blocks(items):
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs
