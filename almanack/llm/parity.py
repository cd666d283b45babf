"""N-gram Jaccard join by parity sketches.

A document's set is its distinct five-word shingles, as 64-bit hashes. A parity sketch XORs
each shingle into one bit of a bit string: a shingle in one of two sets only flips one
bit, so the Hamming distance of two sketches is at most the size of the symmetric difference. Sets A
and B have a Jaccard similarity of at least 3/4 only if that is at most (|A| + |B|) / 7.

1. Equal sets become one node, the smallest doc_id.
2. A wide sketch is cut into blocks, of which just the XOR of the shingles in each is kept.
   At most d = |A| / 3 of A's blocks differ from B's (pigeonhole), so that the first d + 1 + s
   blocks of A and of B that are not empty, in the order of the blocks, have s + 1 in common.
   These are the join keys. Sizes fall into bands with their own number of blocks; a document
   whose smallest partner is in a lower band is also keyed by that one.
3. A key's bucket gives candidate pairs of its members with its smallest member, not all
   pairs. Each task does so for its own members first, so that a key in a third of all
   documents sends one row a task.
4. Candidates whose compact sketches are too far apart are dropped, the others verified by
   the sets. Links give components.
5. A bucket of several components has pairs left to try. In small buckets all are.
   A document with at most s keys in large ones of that kind has a small one in common with
   each partner. The others, which are mostly made of what many share, are keyed once more,
   by the blocks that are rare among them, and all open buckets of the new keys are tried. Trying is
   done within tasks: sketches of a bucket's members meet, then the sets of those that are
   near to one of another component, and only links that join components become rows. So no link is
   lost but between documents already in one component.

Texts of chosen documents are found by a broadcast of their ids if these are at most
``BROADCAST_IDS``, as counted, and by a shuffle otherwise.

Nulls: a null or empty text, or one without words, has no set, is linked with nothing and is its own
component. A row with null doc_id has null as component. Rows that repeat doc_id and text get
the same result. A text of fewer than five words is one shingle. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .storage import drop_stored, give_back, shared_folder, stored
from .words import STEP, Texts, mixed, runs

SHINGLE = 5
#: Band b > 0 holds sizes from 16 * 4**b up to 64 * 4**b; band 0 those below 64.
FIRST_BAND = 64
#: Keys beyond those that must have one in common (s above).
SPARE_KEYS = 16
#: A list of ids up to this length (8 bytes each) is broadcast.
BROADCAST_IDS = 500_000
#: Equal sets of more rows than this meet their node by a broadcast of such groups.
HOT_GROUP = 1_000
#: Buckets up to this size have all their open pairs made into rows; larger ones go another way.
SMALL_BUCKET = 8
#: Members of larger ones are compared in their tasks: so many sets, of so many bytes, with as many others.
SLOT_MEMBERS, SLOT_BYTES = 1024, 4 << 20
#: Sets verified at a time.
VERIFIED = 64
#: So many keys, the most frequent ones, are ranked in the second way: 16 bytes each.
RANKED_KEYS = 500_000
#: Sets of pairs are large rows; batches are bounded by bytes for the jobs of the join.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"
#: Keys are combined within a task in lots of so many.
LOT_KEYS = 500_000


def bands(sizes: np.ndarray) -> np.ndarray:
    """The band of each set size."""
    edges = FIRST_BAND * 4 ** np.arange(24)
    return np.searchsorted(edges, sizes, "right")


def _block(hashes: np.ndarray, band: np.ndarray) -> np.ndarray:
    """A shingle's block: in band 0 its own, else one of four times as many as may differ."""
    count = 4 * (FIRST_BAND * 4**band // 3 + 1)
    return np.where(band == 0, hashes, ((hashes >> np.uint64(32)) * count.astype(np.uint64)) >> np.uint64(32))


def spare_of_partners(size: Column) -> Column:
    """How many keys beyond one a set of this size surely has in common with any partner."""
    least = F.ceil(3 * size / 4)
    return F.least(F.lit(SPARE_KEYS), least - F.floor(least / 3) - 1)


def _sketch_bits(band: int) -> int:
    return max(128, FIRST_BAND * 4**band)


def sets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All sets of some texts: hashes ascending by text; and where each text's begin; their texts."""
    hashes, text = Texts(column, lower=True).shingles(SHINGLE, whole=True)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    if len(hashes):
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(column) + 1)), text


def compact_sketch(hashes: np.ndarray) -> bytes:
    """The parity sketch of one set, of as many bits as its band has."""
    bits = _sketch_bits(int(bands(np.array([len(hashes)]))[0]))
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """The Hamming distance; the longer sketch is folded to the other's length."""
    if len(a) < len(b):
        a, b = b, a
    x, bits = int.from_bytes(a, "little"), 8 * len(b)
    folded = int.from_bytes(b, "little")
    while x:
        folded ^= x & ((1 << bits) - 1)
        x >>= bits
    return folded.bit_count()


def may_link(n_a: int, n_b: int, distance: int) -> bool:
    return 4 * min(n_a, n_b) >= 3 * max(n_a, n_b) and 7 * distance <= n_a + n_b


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= 75 * (len(a) + len(b) - shared)


def block_keys(hashes, first, text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All blocks that are not empty: keys, texts, keys needed, and a number for text and band.

    Rows of one text and band are adjacent and in ascending order of blocks.
    """
    sizes = np.diff(first)
    own, low = bands(sizes), bands(-(-3 * sizes // 4))
    out = []
    for band, twice in ((low, True), (own, False)):
        want = (sizes > 0) & ((low != own) if twice else True)
        pick = want[text]
        h, t = hashes[pick], text[pick]
        if not len(h):
            continue
        b = band[t]
        block = _block(h, b)
        new = np.ones(len(h), bool)
        new[1:] = (block[1:] != block[:-1]) | (t[1:] != t[:-1])
        at = np.flatnonzero(new)
        xor = np.bitwise_xor.reduceat(mixed(h), at)
        place = mixed(block[at] + (b[at] + 1).astype(np.uint64) * STEP)
        # As the larger one of a pair, |A - B| + |B - A| is at most 2/7 of the size.
        need = (2 * sizes // 7 if twice else sizes // 3) + 1
        out.append((mixed(xor ^ place), t[at], need[t[at]], t[at] + (0 if twice else len(sizes))))
    if not out:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _prefix(keys, text, need, group, rank=None):
    """The first ``need`` keys of each set and band, in the order of rank, then block."""
    if rank is not None:
        order = np.lexsort((np.arange(len(keys)), rank, group))
        keys, text, need, group = keys[order], text[order], need[order], group[order]
    begins = np.searchsorted(group, group)
    place = np.arange(len(group)) - begins
    counts = np.searchsorted(group, group, "right") - begins
    # Beyond band 0 sets have far more blocks; the chance that one has not is below 1e-20.
    if (counts < np.minimum(need + SPARE_KEYS, np.where(need > FIRST_BAND // 3, 1 << 30, need))).any():
        raise ValueError("a set has too few blocks that are not empty")
    keep = place < need + SPARE_KEYS
    return keys[keep], text[keep]


def _over_texts(df: DataFrame, schema: str, row: Callable) -> DataFrame:
    """``row(ids, hashes, first, text)`` over (id, text) in runs, as columns of ``schema``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in runs(batch.column(1)):
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(row(part.column(0), *sets_of(part.column(1))), names=names)
        give_back()

    names = [c.split()[0] for c in schema.split(", ")]
    return df.mapInArrow(work, schema)


def _signatures(ids, hashes, first, text):
    n = np.diff(first)
    full = np.flatnonzero(n)
    marks = []
    for salt, combine in ((1, np.bitwise_xor), (2, np.add)):
        mark = np.zeros(len(n), np.uint64)
        if len(full):
            mark[full] = combine.reduceat(mixed(hashes + np.uint64(salt)), first[full])
        marks.append(pa.array(mark.view(np.int64)))
    sketches = [compact_sketch(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return [ids, pa.array(n), *marks, pa.array(sketches, pa.binary())]


def _set_bytes(ids, hashes, first, text):
    sets = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
    return [ids, pa.array(sets, pa.binary())]


def _keyed(texts: DataFrame, ranked=None) -> DataFrame:
    """(key, node, hub): a key's members in a task, each with the least of them."""

    def combined(keys: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
        keys, nodes = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[new], nodes[new]
        begin = np.searchsorted(keys, keys)
        alone = np.searchsorted(keys, keys, "right") - begin == 1
        columns = [keys.view(np.int64), nodes, nodes[begin], alone]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "hub", "alone"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if ranked is None else ranked.value
        keys, nodes, n = [], [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high in runs(batch.column(1)):
                found, text, need, group = block_keys(*sets_of(batch.column(1).slice(low, high - low)))
                rank = None
                if table is not None and len(table[0]):
                    at = np.minimum(np.searchsorted(table[0], found), len(table[0]) - 1)
                    rank = np.where(table[0][at] == found, table[1][at], 0)
                found, text = _prefix(found, text, need, group, rank)
                keys.append(found)
                nodes.append(ids[low:high][text])
                n += len(found)
                if n >= LOT_KEYS:
                    yield combined(keys, nodes)
                    keys, nodes, n = [], [], 0
        if n:
            yield combined(keys, nodes)
        keys = nodes = None
        give_back()

    return texts.mapInArrow(work, "key long, node long, hub long, alone boolean")


def _groups(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Numbers of groups, in the order of the rows; node, component; who is of the left and the right slot."""
    names = np.stack([rows.column(c).to_numpy() for c in ("family", "i", "j")])
    group = np.concatenate(([0], np.cumsum((names[:, 1:] != names[:, :-1]).any(axis=0))))
    node, component, slot = (rows.column(c).to_numpy() for c in ("node", "component", "slot"))
    return group, node, component, slot == names[1], slot == names[2]


def _near_rows(rows: pa.Table) -> list[pa.Array]:
    group, node, component, left, right = _groups(rows)
    sizes = rows.column("n_shingles").to_numpy()
    near = near_members(group, component, sizes, rows.column("sketch").to_pylist(), left, right)
    return [pa.array(x[near]) for x in (rows.column("family").to_numpy(), node, component)]


def _link_rows(rows: pa.Table) -> list[pa.Array]:
    group, node, component, left, right = _groups(rows)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("set")]
    cuts = np.flatnonzero(np.diff(group)) + 1
    found = []
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)], strict=True):
        own = slice(low, high)
        for a, b in links_between(component[own], sets[own], left[own], right[own]):
            found.append(sorted((int(node[low + a]), int(node[low + b]))))
    ends = np.array(found, np.int64).reshape(-1, 2)
    return [pa.array(ends[:, 0]), pa.array(ends[:, 1])]


def _frequent_keys(texts: DataFrame) -> DataFrame:
    """(key, count) of keys that occur more than once in a lot of one task.

    Only an order of the keys is made of them, and any order is right, so that keys which
    are alone need not leave their task.
    """

    def counted(keys: list[np.ndarray]) -> pa.RecordBatch:
        found, count = np.unique(np.concatenate(keys), return_counts=True)
        several = count > 1
        columns = [pa.array(found[several].view(np.int64)), pa.array(count[several])]
        return pa.RecordBatch.from_arrays(columns, ["key", "count"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = [], 0
        for batch in batches:
            for low, high in runs(batch.column(1)):
                keys.append(block_keys(*sets_of(batch.column(1).slice(low, high - low)))[0])
                n += len(keys[-1])
                if n >= LOT_KEYS:
                    yield counted(keys)
                    keys, n = [], 0
        if n:
            yield counted(keys)
        keys = None
        give_back()

    return texts.mapInArrow(work, "key long, count long")


def shared_sizes(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements one sorted set has in common with each of the others."""
    sizes = np.array([len(o) for o in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    sums = np.concatenate(([0], np.cumsum(one[at] == flat)))
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def near_members(group, component, sizes, sketches, left, right) -> np.ndarray:
    """Which members of some groups, rows in the order of the groups, may link with another of theirs.

    That is with a member of another component, by size and sketch, one of them from the left
    and one from the right. Rows are compared with the next one, the next but one and so on,
    in all groups at a time; within a band of sizes, and with those of the band above, folded.
    """
    near, own = np.zeros(len(group), bool), bands(sizes)
    for band in np.unique(own):
        pick = np.flatnonzero((own == band) | (own == band + 1))
        width = _sketch_bits(int(band)) // 64
        bits = np.empty((len(pick), width), np.uint64)
        for row, i in enumerate(pick.tolist()):
            bits[row] = np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint64).reshape(-1, width), axis=0)
        g, c, n, l, r, low = (x[pick] for x in (group, component, sizes, left, right, own == band))
        step, rows = 0, np.arange(len(pick))
        while len(rows):
            step += 1
            rows = rows[rows < len(pick) - step]
            rows = rows[g[rows] == g[rows + step]]
            x, y = rows, rows + step
            may = (c[x] != c[y]) & (low[x] | low[y]) & ((l[x] & r[y]) | (r[x] & l[y]))
            may &= 4 * np.minimum(n[x], n[y]) >= 3 * np.maximum(n[x], n[y])
            x, y = x[may], y[may]
            apart = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
            found = 7 * apart <= n[x] + n[y]
            near[pick[x[found]]] = near[pick[y[found]]] = True
    return near


def links_between(component, sets, left, right) -> list[tuple[int, int]]:
    """Links that join the components of a group, as places: fewer of them than components.

    Members of different components are compared by sketches, size band by size band of the
    smaller one; those that may link are verified by their sets at once, and members of
    one component, once it is one, no more.
    """
    component = np.unique(component, return_inverse=True)[1]
    sizes = np.array([len(x) for x in sets])
    found = []
    own = bands(sizes)
    for band in np.unique(own):
        # Partners are at most a third larger, that is in this band or the next one.
        pick = np.flatnonzero((own == band) | (own == band + 1))
        bits = _sketches([sets[i] for i in pick], int(band))
        for x in np.flatnonzero(own[pick] == band):
            i = pick[x]
            roles = (left[i] & right[pick]) | (right[i] & left[pick])
            n, m = sizes[i], sizes[pick]
            may = roles & (component[pick] != component[i]) & (4 * np.minimum(n, m) >= 3 * np.maximum(n, m))
            # Within the band each pair once.
            may &= (own[pick] > band) | (pick > i)
            y = np.flatnonzero(may)
            apart = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)
            rest = pick[y[7 * apart <= n + m[y]]]
            while len(rest):
                some, rest = rest[:VERIFIED], rest[VERIFIED:]
                shared = shared_sizes(sets[i], [sets[j] for j in some])
                for j in some[100 * shared >= 75 * (n + sizes[some] - shared)].tolist():
                    if component[j] != component[i]:
                        found.append((int(i), j))
                        component[component == component[j]] = component[i]
                rest = rest[component[rest] != component[i]]
    return found


def _sketches(sets: list[np.ndarray], band: int) -> np.ndarray:
    """Parity sketches of the width of a band, a row of 64-bit words for each set."""
    bits = 2 * _sketch_bits(band)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    place = row * bits + (flat & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64).reshape(len(sets), -1)


class _Join:
    """The tables of one run, in one shared folder."""

    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        self.folder = shared_folder(self.spark, "parity")
        self.docs = docs.select("doc_id", "text")
        schema = "doc_id long, n_shingles long, mark1 long, mark2 long, sketch binary"
        ids = self.docs.select(F.col("doc_id").cast("long"), "text")
        self.signed = stored(_over_texts(ids, schema, _signatures), self.folder, "signed")
        full = self.signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        self.same = full.groupBy("n_shingles", "mark1", "mark2").agg(
            F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows")
        )
        several = self.same.where("rows > 1").withColumnRenamed("node", "twin")
        self.several = stored(several, self.folder, "several")
        self.tried: DataFrame | None = None
        self.links: DataFrame | None = None
        self.known_components: DataFrame | None = None
        self.number = 0

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        self.number += 1
        return stored(df, self.folder, f"{name}-{self.number}")

    def texts(self, nodes: DataFrame) -> DataFrame:
        """The texts of some nodes (a column ``node`` of distinct values)."""
        return self._chosen(nodes.select(F.col("node").alias("doc_id")), "left_semi")

    def _chosen(self, ids: DataFrame, how: str) -> DataFrame:
        if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        found = self.docs.where("doc_id IS NOT NULL").join(ids, "doc_id", how)
        return found.select(F.col("doc_id").cast("long"), "text")

    def with_twins(self, rows: DataFrame) -> DataFrame:
        """The rows with ``twin``, the node of their set where several rows have it.

        Rows of a hot group do not meet in one task: its node comes to them. There is at most one such
        group for ``HOT_GROUP`` rows; more than ``BROADCAST_IDS`` of them are left to the shuffle.
        """
        of = ["n_shingles", "mark1", "mark2"]
        hot = self.several.where(F.col("rows") > HOT_GROUP).drop("rows")
        if hot.limit(BROADCAST_IDS + 1).count() > BROADCAST_IDS:
            return rows.join(self.several.drop("rows"), of, "left")
        marked = rows.join(F.broadcast(hot), of, "left")
        cold = self.several.where(F.col("rows") <= HOT_GROUP).drop("rows")
        others = marked.where("twin IS NULL").drop("twin").join(cold, of, "left")
        return marked.where("twin IS NOT NULL").unionByName(others)

    def first_of_each(self) -> DataFrame:
        """The texts without copies: of equal sets, the one with the smallest doc_id."""
        full = self.signed.where("doc_id IS NOT NULL").drop("sketch")
        copies = self.with_twins(full).where("doc_id <> twin").select("doc_id")
        return self._chosen(self.stored(copies.distinct(), "copies"), "left_anti")

    def buckets(self, keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members (key, node) of keys with several, and the pairs (a, b) to try first."""
        keyed = self.stored(keyed, "keyed")
        path = f"{self.folder}/keyed-{self.number}"
        # A key has a row for each task at most by now, so its rows may meet in one task.
        own = Window.partitionBy("key")
        hubs = keyed.where("node = hub").select("key", "hub", "alone")
        hubs = hubs.select(
            "key",
            "hub",
            F.count(F.lit(1)).over(own).alias("n"),
            F.min("hub").over(own).alias("least"),
            F.min("alone").over(own).alias("single"),
        )
        # Two members make one pair: nothing is left to try after that.
        closed = ((F.col("n") == 2) & F.col("single")).alias("closed")
        wide = self.stored(hubs.where("n > 1").select("key", "hub", "least", closed), "wide")
        members = keyed.where("NOT alone").select("key", "node").union(wide.where("NOT closed").select("key", "hub"))
        pairs = keyed.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
        pairs = pairs.union(wide.where("hub <> least").select("least", "hub")).distinct()
        members, pairs = self.stored(members.distinct(), "members"), self.stored(pairs, "pairs")
        drop_stored(self.spark, path)
        return members, pairs

    def try_pairs(self, pairs: DataFrame, name: str) -> None:
        """Add the links among distinct pairs (a < b) that were not tried before."""
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        side = self.signed.select("doc_id", "n_shingles", "sketch")
        for end in ("a", "b"):
            own = side.select(
                F.col("doc_id").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col("sketch").alias(f"s_{end}")
            )
            pairs = pairs.join(own, end)
        pairs = pairs.where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "s_a", "s_b")), strict=True)
                keep = [may_link(n_a, n_b, sketch_distance(s_a, s_b)) for n_a, n_b, s_a, s_b in rows]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        pairs = pairs.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(near, "a long, b long")
        pairs = self.stored(pairs.distinct(), f"{name}-near")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = _over_texts(self.texts(nodes), "node long, set binary", _set_bytes)
        sets = self.stored(sets, f"{name}-sets")
        for end in ("a", "b"):
            own = sets.select(F.col("node").alias(end), F.col("set").alias(f"set_{end}"))
            pairs = pairs.join(own, end)

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True)
                keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in rows]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        found = pairs.select("a", "b", "set_a", "set_b").mapInArrow(verify, "a long, b long")
        self.add_links(found, name)

    def open_members(self, members: DataFrame) -> DataFrame:
        """(key, node, component, n) of buckets that hold several components."""
        of = self.components.withColumnRenamed("component", "root")
        members = members.join(of, "node", "left")
        members = members.select("key", "node", F.coalesce("root", "node").alias("component"))
        members = self.stored(members, "placed")
        state = members.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n")
        )
        state = state.where("low <> high AND n > 2").select("key", "n")
        return self.stored(members.join(state, "key"), "open")

    def open_links(self, members: DataFrame, name: str) -> None:
        """Add links that join the components of open buckets, found within tasks.

        Buckets with the same least member are one family, so that documents with many
        keys in common meet once. First the sketches of a family meet, and members go that are
        near to none of another component; then the sets of those that stay. So what leaves the
        tasks is a row for a member, or a link that joins components, and no pairs.
        """
        least = members.groupBy("key").agg(F.min("node").alias("family"))
        placed = members.join(least, "key").select("family", "node", "component").distinct()
        placed = self.stored(placed, f"{name}-families")
        marks = self.signed.select(F.col("doc_id").alias("node"), "n_shingles", "sketch")
        near = self._within_families(
            placed, marks, F.octet_length("sketch"), ["n_shingles", "sketch"], _near_rows, "family long, node long, component long"
        )
        near = self.stored(near.distinct(), f"{name}-near")
        sets = _over_texts(self.texts(near.select("node").distinct()), "node long, set binary", _set_bytes)
        sets = self.stored(sets, f"{name}-sets")
        links = self._within_families(near, sets, F.octet_length("set"), ["set"], _link_rows, "a long, b long")
        self.add_links(links, name)

    def _within_families(self, placed: DataFrame, with_: DataFrame, size: Column, names: list, rows: Callable, schema: str):
        """``rows`` of the members of each family, dealt in blocks, with columns of another table.

        A family's members are dealt into k slots of bounded size, and each pair of slots is a group of
        its own: at most k rows for each member, and no group grows with the family.
        """
        sized = placed.join(with_.select("node", size.alias("bytes")), "node").groupBy("family").agg(
            F.greatest(F.sum("bytes") / SLOT_BYTES, F.count(F.lit(1)) / SLOT_MEMBERS).alias("size"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        several = sized.where("low <> high").select("family", F.ceil("size").cast("int").alias("k"))
        slot = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
        dealt = placed.join(several, "family").select(
            "*", slot.alias("slot"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
        )
        group = ["family", "i", "j"]
        # An id that has several rows is one member here; its rows have a component of their own.
        dealt = dealt.join(with_, "node").select(
            "family", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"),
            "slot", "node", "component", *names,
        ).repartition(*group).sortWithinPartitions(*group, "node")
        named = [c.split()[0] for c in schema.split(", ")]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, held_rows, last = [], 0, None
            for batch in batches:
                keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in group])
                cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
                begin = 0
                # A run ends where a group does, once it has rows enough.
                for cut in ([0] if held and tuple(keys[:, 0]) != last else []) + cuts.tolist():
                    if held_rows + cut - begin >= 2 * SLOT_MEMBERS:
                        held.append(batch.slice(begin, cut - begin))
                        yield pa.RecordBatch.from_arrays(rows(pa.Table.from_batches(held)), named)
                        held, held_rows, begin = [], 0, cut
                held.append(batch.slice(begin))
                held_rows, last = held_rows + len(batch) - begin, tuple(keys[:, -1])
            if held_rows:
                yield pa.RecordBatch.from_arrays(rows(pa.Table.from_batches(held)), named)
            held = None
            give_back()

        return dealt.mapInArrow(work, schema)

    def add_links(self, links: DataFrame, name: str) -> None:
        links = self.stored(links.distinct(), f"{name}-links")
        self.links = links if self.links is None else self.links.union(links)
        self.known_components = None

    @property
    def components(self) -> DataFrame:
        """(node, component) by the links so far, computed when it is asked for after new ones."""
        if self.known_components is None:
            self.number += 1
            self.known_components = components(self.links, self.folder, f"components-{self.number}")
        return self.known_components

    def run(self) -> DataFrame:
        """All jobs but the last, with Arrow batches that a worker can hold twice."""
        before = self.spark.conf.get(ARROW_BYTES)
        self.spark.conf.set(ARROW_BYTES, BATCH_BYTES)
        try:
            self.link()
        finally:
            self.spark.conf.set(ARROW_BYTES, before)
        return self.result()

    def link(self) -> None:
        members, pairs = self.buckets(_keyed(self.first_of_each()))
        self.try_pairs(pairs, "first")
        self.tried = pairs
        left = self.open_members(members)
        counts = left.where(F.col("n") > SMALL_BUCKET).groupBy("node").agg(F.count(F.lit(1)).alias("large"))
        sized = counts.join(self.signed.select(F.col("doc_id").alias("node"), "n_shingles"), "node")
        large = sized.where(F.col("large") > spare_of_partners(F.col("n_shingles"))).select("node")
        large = self.stored(large.distinct(), "large")
        self.open_links(left.where(F.col("n") <= SMALL_BUCKET), "small")
        if not large.isEmpty():
            self.by_rare_keys(large)

    def by_rare_keys(self, nodes: DataFrame) -> None:
        counts = _frequent_keys(self.texts(nodes)).groupBy("key").agg(F.sum("count").alias("count"))
        top = counts.where(F.col("count") > SMALL_BUCKET).orderBy(F.desc("count"), "key").limit(RANKED_KEYS)
        rows = np.array([tuple(r) for r in top.collect()], np.int64).reshape(-1, 2)
        keys = rows[:, 0].copy().view(np.uint64)
        order = np.argsort(keys)
        ranked = self.spark.sparkContext.broadcast((keys[order], rows[order, 1]))
        members, pairs = self.buckets(_keyed(self.texts(nodes), ranked))
        self.try_pairs(pairs, "rare")
        left = self.open_members(members)
        self.open_links(left, "rest")

    def result(self) -> DataFrame:
        found = self.with_twins(self.signed.drop("sketch"))
        found = found.select("doc_id", "n_shingles", F.coalesce("twin", "doc_id").alias("node"))
        found = found.join(self.components, "node", "left")
        component = F.when(
            F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component", "node")
        ).otherwise(F.col("doc_id"))
        return found.select("doc_id", "n_shingles", component.alias("component_id"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles (size of the set) and component_id for each row."""
    return _Join(docs).run()


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns: of each component the row with its smallest doc_id.

    Rows that repeat that doc_id and the text go but for one; another text under the same
    doc_id stays. Rows with null doc_id stay. Texts are shuffled only where ids are too many to
    broadcast, or repeat.
    """
    found = stored(jaccard_components(docs), shared_folder(docs.sparkSession, "kept"), "components")
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("first"), F.count(F.lit(1)).alias("rows")
    )

    def sized(chosen: DataFrame) -> DataFrame:
        own = chosen.select("doc_id")
        return F.broadcast(own) if own.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else own

    named = docs.where("doc_id IS NOT NULL").join(sized(ids.where("NOT first")), "doc_id", "left_anti")
    again = sized(ids.where("first AND rows > 1"))
    once = named.join(again, "doc_id", "left_anti").select(*docs.columns)
    repeated = named.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return once.unionAll(repeated).unionAll(docs.where("doc_id IS NULL"))
