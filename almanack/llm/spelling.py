"""Spelling variants: words one edit apart, found in a frequency-vector trie.

Words are letter runs of the texts, counted over all documents. A word's path in the trie is the
vector of its letter counts, group by group (``GROUPS``); words of one path share a leaf.
One inserted, deleted or replaced letter adds at most one to one count and takes at most one from
another, so a search goes down the trie with a budget of one surplus and one deficit, and
what it reaches is verified letter by letter.

1. Counting: each task counts the words of its texts, so a word in all texts sends a row a task.
2. The top of the trie is cut into subtrees of bounded work: a node that more than
   ``SHARD_QUERIES`` searches reach is opened, level by level. The searches are counted by
   node within tasks; the driver gets the opened nodes only, at most one for so many
   searches.
3. Each word is sent to the subtree it belongs to, and as a search to those that its budget
   reaches. A subtree is searched depth first in one task, all its searches at a time; a word's
   near words of one subtree leave as one row (how many, and the best form), never as pairs.
   Words that even whole paths do not part are dealt into blocks, and each block of searches meets each block of words.
4. Forms lead to words of larger counts, by pointer doubling in a number of rounds that the largest
   count bounds.

Nulls: a null text has no words. A null doc_id is written as an empty number in the hash that
draws noise. Repeated rows count as often as they are there. Ties between forms go to the
smaller word in code-point order. An empty table gives an empty one. Only doc_id and text are read. Long
texts are cut between words; a word of any length is taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import shared_folder, stored

#: What a word is made of; all of it is in Latin-1.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Of the pairs of document and word, one in so many has a letter taken out, as noise.
NOISE = 199
LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A form is at least so many times as frequent.
FORM_FACTOR = 5

#: Letters by group, in the order of the trie's levels: those first that part words best.
GROUPS = (
    "e", "n", "a", "o", "i", "t", "r", "h", "s", "u", "l", "c", "d", "g", "m", "b", "f", "p", "w", "z", "k", "v",
    "y", "q", "x", "j", "éÉ", "èêëÈÊË", "àáâãäåæÀÁÂÃÄÅÆ", "òóôõöøÒÓÔÕÖØ", "ìíîïÌÍÎÏ", "ùúûüÙÚÛÜ", "ñçßÑÇ", "ýþÿðÝÞÐ×÷",
)
LEVELS = len(GROUPS)
#: A subtree that more searches reach than this is opened.
SHARD_QUERIES = 100_000
#: Words counted in a task before they are sent on, and rows of a batch.
LOT_WORDS, BATCH_ROWS = 300_000, 20_000
#: Texts longer than this are cut into stretches, between words.
STRETCH = 1 << 20
#: A node with no more words, or no more searches, than this is compared whole.
FEW_WORDS, FEW_QUERIES = 4, 32
#: Pairs compared at a time, and letters compared as an array; longer words go one by one.
PAIRS, COLUMNS = 200_000, 40


def level_of_letter() -> np.ndarray:
    table = np.full(256, LEVELS - 1, np.int64)
    for level, letters in enumerate(GROUPS):
        table[list(letters.encode("latin-1"))] = level
    return table


LEVEL = level_of_letter()


# Words and their counts ---------------------------------------------------


def letter_runs(text: str) -> Iterator[str]:
    """All runs, by stretches, so that few are held at once."""
    begin = 0
    while begin < len(text):
        end = min(begin + STRETCH, len(text))
        if end < len(text) and (more := RUN.match(text, end)):
            end = more.end()
        yield from RUN.findall(text[begin:end])
        begin = end


def words_of(doc_id: int | None, text: bytes) -> Counter:
    """The words of a text after noise, with their counts; shorter ones than are wanted go."""
    found = Counter(letter_runs(text.translate(LOWER).decode("utf-8", "replace")))
    start, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for word, n in found.items():
        if len(word) < LEAST_LETTERS:
            continue
        drawn = zlib.crc32(word.encode(), start)
        if drawn % NOISE == 0:
            at = drawn % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < LEAST_LETTERS:
                continue
        out[word] += n
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all documents, those frequent enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(lot.keys(), pa.string()), pa.array(lot.values(), pa.int64())], names)

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                if texts[i].is_valid:
                    lot.update(words_of(doc_id, texts[i].as_py()))
                if len(lot) >= LOT_WORDS:
                    yield counted()
                    lot.clear()
        if lot:
            yield counted()

    names = ["word", "n"]
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(work, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# The trie -----------------------------------------------------------------


def paths(words: list[bytes]) -> np.ndarray:
    """The letter counts of each word (Latin-1) by level, up to 255."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8)
    cell = np.repeat(np.arange(len(words)) * LEVELS, sizes) + LEVEL[letters]
    return np.minimum(np.bincount(cell, minlength=len(words) * LEVELS), 255).astype(np.int16).reshape(-1, LEVELS)


def reached(path: np.ndarray, opened: list[set[bytes]]) -> Iterator[tuple[int, np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """The nodes that searches reach, level by level below the opened nodes.

    Yields level, rows of ``path``, nodes, whether the node is the row's own, and whether it
    is to be opened. ``opened[d]`` has the opened nodes of level d.
    """
    rows = np.arange(len(path))
    surplus = deficit = np.zeros(len(path), np.int8)
    nodes, level = [b""] * len(path), 0
    while len(rows):
        known = opened[level] if level < len(opened) else set()
        open_ = np.fromiter((node in known for node in nodes), bool, len(nodes))
        yield level, rows, nodes, (surplus == 0) & (deficit == 0), open_
        if level == LEVELS:
            return
        parts = []
        for step in (0, 1, -1):
            more, less = surplus + (step > 0), deficit + (step < 0)
            value = path[rows, level] + step
            go = np.flatnonzero(open_ & (more <= 1) & (less <= 1) & (value >= 0) & (value <= 255))
            below = [nodes[i] + bytes((v,)) for i, v in zip(go.tolist(), value[go].tolist(), strict=True)]
            parts.append((rows[go], more[go], less[go], below))
        rows, surplus, deficit = (np.concatenate([p[k] for p in parts]) for k in range(3))
        nodes = [node for p in parts for node in p[3]]
        level += 1


def _latin(batch: pa.RecordBatch) -> list[bytes]:
    return [w.encode("latin-1") for w in batch.column(0).to_pylist()]


def open_nodes(words: DataFrame, limit: int = SHARD_QUERIES) -> tuple[list[set[bytes]], dict[bytes, int]]:
    """The opened nodes of each level, and for whole paths that are too much the number of blocks."""
    spark, opened = words.sparkSession, []

    for level in range(LEVELS + 1):
        shared = spark.sparkContext.broadcast(opened)

        def loads(batches: Iterator[pa.RecordBatch], shared=shared, level=level) -> Iterator[pa.RecordBatch]:
            searches, own = Counter(), Counter()
            for batch in batches:
                for at, _, nodes, mine, _ in reached(paths(_latin(batch)), shared.value):
                    if at == level:
                        searches.update(nodes)
                        own.update(node for node, m in zip(nodes, mine.tolist(), strict=True) if m)
                if len(searches) > LOT_WORDS:
                    yield _loads(searches, own)
                    searches, own = Counter(), Counter()
            yield _loads(searches, own)

        found = words.select("word").mapInArrow(loads, "node binary, searches long, own long")
        found = found.groupBy("node").agg(F.sum("searches").alias("searches"), F.sum("own").alias("own"))
        heavy = found.where((F.col("searches") > limit) & (F.col("own") > 0)).collect()
        if not heavy:
            return opened, {}
        if level == LEVELS:
            return opened, {bytes(r.node): -(-r.searches // limit) for r in heavy}
        opened.append({bytes(r.node) for r in heavy})
    return opened, {}


def _loads(searches: Counter, own: Counter) -> pa.RecordBatch:
    nodes = list(searches)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(nodes, pa.binary()),
            pa.array([searches[x] for x in nodes], pa.int64()),
            pa.array([own[x] for x in nodes], pa.int64()),
        ],
        ["node", "searches", "own"],
    )


ROUTED = "shard binary, word string, n long, searches boolean, held boolean"


def routed(words: DataFrame, opened: list[set[bytes]], blocks: dict[bytes, int]) -> DataFrame:
    """A row for each word and subtree: whether it is searched for there, and whether it is held there."""
    shared = words.sparkSession.sparkContext.broadcast((opened, blocks))

    def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[list, list, list, list]]:
        opened, blocks = shared.value
        latin = _latin(batch)
        for _, rows, nodes, mine, open_ in reached(paths(latin), opened):
            ready = np.flatnonzero(~open_)
            shards, at = [nodes[i] for i in ready.tolist()], rows[ready].tolist()
            searches, held = [True] * len(shards), mine[ready].tolist()
            for i in [i for i, s in enumerate(shards) if s in blocks]:
                # Blocks of searches by blocks of words: a word's own ones, each with all others.
                shard, row, k = shards[i], at[i], blocks[shards[i]]
                own = zlib.crc32(latin[row]) % k
                if held[i]:
                    more = [(own, j, True, j == own) for j in range(k)] + [(j, own, False, True) for j in range(k) if j != own]
                else:
                    more = [(own, j, True, False) for j in range(k)]
                names = [shard + b"/%d/%d" % (x, y) for x, y, _, _ in more]
                shards[i], searches[i], held[i] = names[0], more[0][2], more[0][3]
                shards += names[1:]
                at += [row] * (len(more) - 1)
                searches += [m[2] for m in more[1:]]
                held += [m[3] for m in more[1:]]
            if shards:
                yield shards, at, searches, held

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), BATCH_ROWS):
                part = batch.slice(begin, BATCH_ROWS)
                for shards, at, searches, held in rows_of(part):
                    taken = part.take(pa.array(at))
                    columns = [pa.array(shards, pa.binary()), *taken.columns, pa.array(searches), pa.array(held)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = [c.split()[0] for c in ROUTED.split(", ")]
    return words.select("word", "n").mapInArrow(work, ROUTED)


class Words:
    """Some words as arrays: paths, lengths, and their first letters padded with zeros."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.path = paths(words)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        letters = b"".join(w[:COLUMNS].ljust(COLUMNS, b"\0") for w in words)
        self.letters = np.frombuffer(letters, np.uint8).reshape(-1, COLUMNS)

    def take(self, order: np.ndarray) -> Words:
        out = object.__new__(Words)
        out.words = [self.words[i] for i in order.tolist()]
        out.path, out.size, out.letters = self.path[order], self.size[order], self.letters[order]
        return out


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)
    while low < high:  # the length of the common prefix
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def near(q: Words, x: np.ndarray, t: Words, y: np.ndarray) -> np.ndarray:
    """Which of the pairs (q[x], t[y]) are one edit apart."""
    size, other = q.size[x], t.size[y]
    out = np.zeros(len(x), bool)
    gap = np.abs(size - other)
    long = np.maximum(size, other) > COLUMNS
    for i in np.flatnonzero(long & (gap <= 1)).tolist():
        out[i] = one_edit(q.words[x[i]], t.words[y[i]])
    same = np.flatnonzero(~long & (gap == 0))
    out[same] = np.count_nonzero(q.letters[x[same]] != t.letters[y[same]], axis=1) == 1
    one = np.flatnonzero(~long & (gap == 1))
    if len(one):
        a, b = q.letters[x[one]], t.letters[y[one]]
        swap = (size[one] > other[one])[:, None]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        differ = a != b
        first = np.argmax(differ, axis=1)
        # From the first difference on, the shorter word goes on one letter later in the longer one.
        after = np.arange(COLUMNS - 1)[None, :] >= first[:, None]
        out[one] = ~np.any(after & (a[:, :-1] != b[:, 1:]), axis=1)
    return out


def search(q: Words, t: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of q, row of t) one edit apart; t is in the order of its paths.

    Depth first. At a node the searches that still have their budget go on together.
    """
    everyone = np.arange(len(q.words))
    none = np.zeros(len(everyone), np.int8)
    stack = [(0, len(t.words), 0, everyone, none, none)]
    while stack:
        low, high, level, rows, surplus, deficit = stack.pop()
        if high - low <= FEW_WORDS or len(rows) <= FEW_QUERIES or level == LEVELS:
            yield from _leaf(q, rows, surplus, deficit, t, low, high, level)
            continue
        counts = t.path[low:high, level]
        cuts = np.flatnonzero(counts[1:] != counts[:-1]) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), high - low], strict=True):
            step = counts[begin] - q.path[rows, level]
            more, less = surplus + np.maximum(step, 0), deficit + np.maximum(-step, 0)
            go = np.flatnonzero((more <= 1) & (less <= 1))
            if len(go):
                budgets = more[go].astype(np.int8), less[go].astype(np.int8)
                stack.append((low + begin, low + end, level + 1, rows[go], *budgets))


def _leaf(q, rows, surplus, deficit, t, low, high, level) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rest of the way, word by word or all words for each search, then the letters."""
    step = max(1, PAIRS // max(1, high - low))
    for begin in range(0, len(rows), step):
        part = slice(begin, begin + step)
        x, y = np.repeat(rows[part], high - low), np.tile(np.arange(low, high), len(rows[part]))
        more, less = (np.repeat(b[part], high - low).astype(np.int16) for b in (surplus, deficit))
        close = np.abs(q.size[x] - t.size[y]) <= 1
        for at in range(level, LEVELS):
            if not close.all():
                x, y, more, less = x[close], y[close], more[close], less[close]
            if not len(x):
                break
            apart = t.path[y, at] - q.path[x, at]
            more, less = more + np.maximum(apart, 0), less + np.maximum(-apart, 0)
            close = (more <= 1) & (less <= 1)
        else:
            x, y = x[close], y[close]
        if len(x):
            found = near(q, x, t, y)
            if found.any():
                yield x[found], y[found]


def searched(table: pa.Table) -> pa.Table:
    """One subtree: word, n_near and its best form there (form, form_n), for searches with near words."""
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    n = table.column("n").to_numpy()
    asks = np.flatnonzero(table.column("searches").to_numpy())
    held = np.flatnonzero(table.column("held").to_numpy())
    names, types = ["word", "n_near", "form", "form_n"], [pa.string(), pa.int64(), pa.string(), pa.int64()]
    if not len(held) or not len(asks):
        return pa.table([pa.array([], k) for k in types], names=names)
    everything = Words(words)
    # In the order of paths, the first letter group first.
    held = held[np.lexsort(everything.path[held].T[::-1])]
    q, t = everything.take(asks), everything.take(held)
    count = np.zeros(len(asks), np.int64)
    # The best form is the first in this order: largest n, then smallest word.
    order = sorted(range(len(held)), key=lambda i: (-n[held[i]], t.words[i]))
    rank = np.empty(len(held), np.int64)
    rank[order] = np.arange(len(held))
    best = np.full(len(asks), len(held))
    for x, y in search(q, t):
        count += np.bincount(x, minlength=len(asks))
        np.minimum.at(best, x, rank[y])
    some = np.flatnonzero(count)
    form = held[np.array(order)[best[some]]]
    word = table.column("word")
    columns = [word.take(pa.array(asks[some])), pa.array(count[some]), word.take(pa.array(form)), pa.array(n[form])]
    return pa.table([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=names)


# Forms and roots ----------------------------------------------------------


def near_words(words: DataFrame, limit: int = SHARD_QUERIES) -> DataFrame:
    """word, n, n_near, best (its near word of largest n) and best_n for each (word, n)."""
    rows = routed(words, *open_nodes(words, limit))
    found = rows.groupBy("shard").applyInArrow(searched, "word string, n_near long, form string, form_n long")
    ranked = F.struct((-F.col("form_n")).alias("minus"), "form")
    alone = F.lit(None).cast("struct<minus:bigint,form:string>")
    both = found.select("word", F.lit(None).cast("long").alias("n"), "n_near", ranked.alias("best")).unionByName(
        words.select("word", "n", F.lit(0).cast("long").alias("n_near"), alone.alias("best"))
    )
    best = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return best.select("word", "n", "n_near", F.col("best.form").alias("best"), (-F.col("best.minus")).alias("best_n"))


def spelling_variants(docs: DataFrame, limit: int = SHARD_QUERIES) -> DataFrame:
    """A row for each word: word, n, n_near, form, form_n and root."""
    folder = shared_folder(docs.sparkSession, "spelling")
    words = stored(count_words(docs), folder, "words")
    found = near_words(words, limit)
    common = F.col("best_n") >= FORM_FACTOR * F.col("n")
    formed = found.select(
        "word", "n", "n_near", F.when(common, F.col("best")).alias("form"), F.when(common, F.col("best_n")).alias("form_n")
    )
    formed = stored(formed, folder, "formed")
    links = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most, longest = formed.agg(F.max("n")).first()[0] or 0, 0
    while LEAST_COUNT * FORM_FACTOR ** (longest + 1) <= most:
        longest += 1
    reach = 1
    while reach < longest:  # a link now leads so many forms on
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        reach *= 2
        links = stored(further, folder, f"links-{reach}")
    rooted = formed.join(links, "word", "left")
    return rooted.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
