"""Quality classifier by co-training of two views of a document.

The content view sees the text: hashed word frequencies and a few shares (symbols, capitals,
repeats and so on). The metadata view sees the page's source, language and size. Both are
regularised least-squares classifiers. In each round each view scores all unlabelled rows that have
not been handed over, and those of which it is surest join the *other* view's training set. After
the rounds each view is calibrated on labelled rows it was not trained on, and so is their
combination; it then scores all documents in one pass, without a shuffle of texts.

Only the labelled sample is bounded: at most ``MAX_LABELLED`` rows, those with the least hash of
doc_id, which the driver holds. The unlabelled rows are all there are. Their features are computed
and stored once; a round makes two passes over them, which count the rows by confidence
(this gives the threshold) and sum the products of the features of the rows beyond it. Sums are
added by partition, then by groups of partitions, and of groups, until one is left for the driver;
their size does not depend on the number of rows.

Null texts are empty, null sources and languages are a value of their own, a null n_chars is the text's
length; these columns may be missing. Null doc_ids are scored, not trained on. Of repeated labels
of one doc_id the largest counts. Rows with a label never get another one, whether they are in the
sample or not. Without labels of both classes every score is 0.5 and every document is kept. A class of a
single label is both trained and calibrated on. Empty tables give no rows. Of the documents doc_id, text, source, lang and n_chars
are read, and of the labels doc_id and the label: other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop_stored, shared_folder, stored
from .words import Texts, mixed, runs

MAX_LABELLED = 6_000
ROUNDS = 4
#: The share of all unlabelled rows that a view hands over in a round, and how sure it must be. Rows
#: as sure as the last of the share (within 1/64 of log-odds) go too.
HANDED_OVER = 1 / 15
SURE = 0.95
#: A document is kept if its score (the probability of good quality) is at least this.
LEAST_SCORE = 0.5
BUCKETS = 512
CONTENT, METADATA = BUCKETS + 8, 64 + 16 + 12  # features of the views
#: Sums of so many partitions are added in one group, and of so many groups, until one is left.
GROUP = 32
_BINS, _STEP, _END = 3_841, 64, 30  # of log-odds from -30 to 30
_HELD_OUT = 5  # every fifth labelled row of a class calibrates

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!?")] = True


def content_features(column: pa.Array) -> np.ndarray:
    texts = Texts(column)
    n, words = len(texts), np.diff(texts.first)
    hashes, owner = texts.word_hashes(), np.repeat(np.arange(n), words)
    slots = owner * BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    share = np.bincount(slots, minlength=n * BUCKETS).reshape(n, BUCKETS)
    out = [np.sqrt(share / np.maximum(words, 1)[:, None])]
    size = np.maximum(np.diff(texts.offsets), 1)
    data = texts.data
    for marked in (_SYMBOLS[data], _MARKS[data], (data >= 65) & (data < 91), (data >= 48) & (data < 58)):
        out.append(4 * texts.per_text(marked)[:, None] / size[:, None])
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    distinct = np.unique(mixed(hashes ^ mixed(owner.astype(np.uint64))), return_index=True)[1]
    counts = [np.bincount(owner[again], minlength=n), np.bincount(owner[distinct], minlength=n)]
    out += [4 * (c / np.maximum(words, 1))[:, None] for c in counts]
    out.append((size / np.maximum(words, 1))[:, None] / 10)
    out.append(np.log1p(words)[:, None] / 5)
    return np.concatenate(out, axis=1).astype(np.float32)


def metadata_features(batch: pa.RecordBatch) -> np.ndarray:
    """One-hot source (64 slots) and language (16), and the size's logarithm in 12 steps."""
    n = len(batch)
    out = np.zeros((n, 64 + 16 + 12), np.float32)
    rows, begin = np.arange(n), 0
    for name, slots in (("source", 64), ("lang", 16)):
        column = batch.column(batch.schema.get_field_index(name))
        values = Texts(column)
        hashes = values.slice_hashes(values.offsets[:-1], values.offsets[1:])
        out[rows, begin + (hashes & np.uint64(slots - 1)).astype(np.int64)] = 1
        begin += slots
    size = batch.column(batch.schema.get_field_index("n_chars")).to_numpy(zero_copy_only=False)
    step = np.log2(np.maximum(np.nan_to_num(size.astype(float)), 1)).astype(int) - 4
    out[rows, begin + np.clip(step, 0, 11)] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 300) -> np.ndarray:
    """Weights and bias by accelerated gradient descent; classes weigh alike."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1).astype(np.float32)
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    weight = weight.astype(np.float32)
    rate = np.float32(4 / (np.square(x).sum(axis=1) * weight).sum())
    penalty = np.float32(penalty)
    w = last = np.zeros(x.shape[1], np.float32)
    for i in range(steps):
        ahead = w + np.float32(i / (i + 3)) * (w - last)
        slope = x.T @ (weight * (_sigmoid(x @ ahead) - y)) + penalty * np.append(ahead[:-1], np.float32(0))
        last, w = w, ahead - rate * slope
    return w


def _scores(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def _calibrated(raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Scale and shift that make raw scores log-odds of balanced classes (Platt)."""
    return fit_logistic(raw.reshape(len(raw), -1), y, penalty=1e-2, steps=200)


def _products(x: np.ndarray) -> np.ndarray:
    """Sums of the products of any two features and a 1, which a fit needs of rows of one class."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
    return x.T @ x


def _least_squares(sums: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Weights and bias from the products of both classes; classes weigh alike."""
    weighed = [s * (0.5 / max(1, s[-1, -1])) for s in sums]
    ridge = penalty * np.eye(len(sums[0]))
    ridge[-1, -1] = 1e-9
    return np.linalg.solve(weighed[0] + weighed[1] + ridge, weighed[1][-1] - weighed[0][-1])


def _bins(x: np.ndarray, w: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The bins of a view's log-odds."""
    odds = _scores(_scores(x, w)[:, None], scale)
    return np.rint((np.clip(odds, -_END, _END) + _END) * _STEP).astype(int)


def _turns(views: list[np.ndarray], turns: list) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The rows that views have handed over in these rounds, and for the last round those
    that each view hands over as bad and as good."""
    taken, hands = np.zeros(len(views[0]), bool), []
    for weights, scales, bounds in turns:
        hands = []
        for x, w, scale, (low, high) in zip(views, weights, scales, bounds, strict=True):
            bins = _bins(x, w, scale)
            hands.append([~taken & (bins <= low), ~taken & (bins >= high)])
        for bad, good in hands:
            taken = taken | bad | good
    return taken, hands


def _bounds(counts: np.ndarray, share: float, rows: float) -> tuple[int, int]:
    """The bins up to which a view's rows are bad, and from which they are good."""
    sure = int(np.ceil(np.log(SURE / (1 - SURE)) * _STEP))
    middle = _END * _STEP
    low = np.searchsorted(np.cumsum(counts), HANDED_OVER * (1 - share) * rows)
    high = _BINS - 1 - np.searchsorted(np.cumsum(counts[::-1]), HANDED_OVER * share * rows)
    return int(min(low, middle - sure)), int(max(high, middle + sure))


def held_out(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to train on, and rows to calibrate on: every fifth of each class.

    A class of one row cannot do both apart: then all rows do both.
    """
    held = np.zeros(len(y), bool)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        if len(own) < 2:
            return np.ones(len(y), bool), np.ones(len(y), bool)
        held[own[::_HELD_OUT]] = True
    return ~held, held


class CoTrained:
    """The two views and their combination, fitted on labelled and unlabelled rows."""

    def __init__(self, views: list[np.ndarray], y: np.ndarray, pool: DataFrame, rounds: int = ROUNDS):
        trained, held = held_out(y)
        sums = [np.stack([_products(v[trained & (y == label)]) for label in (0, 1)]) for v in views]
        share = (y > 0).mean()
        turns, self.handed_over, rows = [], 0, None
        for turn in range(rounds + 1):
            self.weights = [_least_squares(s) for s in sums]
            pairs = list(zip(views, self.weights, strict=True))
            self.scales = [_calibrated(_scores(v[held], w), y[held]) for v, w in pairs]
            if turn == rounds:
                break
            counts = _counted(pool, turns, self.weights, self.scales)
            rows = counts[0].sum() if rows is None else rows
            turns.append((self.weights, self.scales, [_bounds(c, share, rows) for c in counts]))
            more = _handed(pool, turns)
            if not any(m[:, -1, -1].any() for m in more):
                break
            for k in (0, 1):
                sums[k] += more[k]
                self.handed_over += int(more[k][:, -1, -1].sum())
        both = np.stack([self.log_odds(k, v[held]) for k, v in enumerate(views)], axis=1)
        self.mix = _calibrated(both, y[held])
        # Balanced log-odds plus the classes' own odds.
        self.prior = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))

    def log_odds(self, k: int, x: np.ndarray) -> np.ndarray:
        return _scores(_scores(x, self.weights[k])[:, None], self.scales[k])

    def probability(self, views: list[np.ndarray]) -> list[np.ndarray]:
        """Content, metadata and combined probability of good quality."""
        odds = [self.log_odds(k, v) for k, v in enumerate(views)]
        mixed_odds = _scores(np.stack(odds, axis=1), self.mix)
        return [_sigmoid(o + self.prior) for o in (*odds, mixed_odds)]


def _inputs(docs: DataFrame) -> DataFrame:
    """doc_id, text, source, lang and n_chars, whatever is missing."""
    has = set(docs.columns)
    text = F.coalesce("text", F.lit(""))

    def column(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in has else F.lit("")

    size = F.coalesce(F.col("n_chars") if "n_chars" in has else F.lit(None), F.length(text))
    named = [column(c).alias(c) for c in ("source", "lang")]
    return docs.select("doc_id", text.alias("text"), *named, size.cast("long").alias("n_chars"))


def _features(df: DataFrame, keep: str) -> DataFrame:
    """Both views of each row, side by side: the places and values of the features other than 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in runs(batch.column(1)):
                part = batch.slice(low, high - low)
                x = np.concatenate((content_features(part.column(1)), metadata_features(part)), axis=1)
                row, slot = np.nonzero(x)
                bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(x)))))
                packed = []
                for data in (slot.astype("<u2"), x[row, slot].astype("<f4")):
                    ends = (bounds * data.itemsize).astype(np.int32)
                    buffers = [None, pa.py_buffer(ends), pa.py_buffer(data)]
                    packed.append(pa.Array.from_buffers(pa.binary(), len(x), buffers))
                kept = part.column(part.schema.get_field_index(keep))
                yield pa.RecordBatch.from_arrays([kept, *packed], [keep, "slots", "sizes"])

    kind = df.schema[keep].dataType.simpleString()
    return df.mapInArrow(work, f"{keep} {kind}, slots binary, sizes binary")


def _views(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Both views from the columns that ``_features`` gives."""
    flat = []
    for name, kind in (("slots", "<u2"), ("sizes", "<f4")):
        column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2] if len(column) and ends[-1] > ends[0] else b""
        data = memoryview(data)[int(ends[0]) : int(ends[-1])] if len(data) else data
        flat.append(np.frombuffer(data, kind))
        each = np.diff(ends) // np.dtype(kind).itemsize
    out = np.zeros((len(batch), CONTENT + METADATA), np.float32)
    out[np.repeat(np.arange(len(batch)), each), flat[0]] = flat[1]
    return [out[:, :CONTENT], out[:, CONTENT:]]


def _total(pool: DataFrame, size: int, add: Callable[[list[np.ndarray], np.ndarray], None]) -> np.ndarray:
    """``size`` numbers that ``add`` sums over all rows; always added in the same order."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, seen = np.zeros(size), False
        for batch in batches:
            seen = seen or len(batch) > 0
            add(_views(batch), out)
        if seen:
            part = TaskContext.get().partitionId()
            columns = [pa.array([part]), pa.array([zlib.compress(out, 1)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "sums"])

    def together(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        out = np.zeros(size)
        for sums in table.column("sums"):
            out += np.frombuffer(zlib.decompress(sums.as_buffer()), float)
        packed = pa.array([zlib.compress(out, 1)], pa.binary())
        return pa.table({"part": table.column("g")[:1], "sums": packed})

    sums = pool.mapInArrow(each, "part long, sums binary")
    left = max(2, pool.rdd.getNumPartitions())
    while left > 1:
        grouped = sums.select(F.floor(F.col("part") / GROUP).alias("g"), "part", "sums").groupBy("g")
        sums, left = grouped.applyInArrow(together, "part long, sums binary"), -(-left // GROUP)
    out = np.zeros(size)
    for r in sums.collect():
        out += np.frombuffer(zlib.decompress(r["sums"]), float)
    return out


def _counted(pool: DataFrame, turns: list, weights: list, scales: list) -> np.ndarray:
    """How many rows that are not handed over lie in each bin of each view's log-odds."""
    turns = list(turns)

    def add(views: list[np.ndarray], out: np.ndarray) -> None:
        free = ~_turns(views, turns)[0]
        for k, x in enumerate(views):
            bins = _bins(x[free], weights[k], scales[k])
            out[k * _BINS : (k + 1) * _BINS] += np.bincount(bins, minlength=_BINS)

    return _total(pool, 2 * _BINS, add).reshape(2, _BINS)


def _handed(pool: DataFrame, turns: list) -> list[np.ndarray]:
    """For each view the products, by class, of the rows that the other hands it in the last round."""
    turns = list(turns)
    upper = [np.triu_indices(n + 1) for n in (CONTENT, METADATA)]
    sizes = [len(i) for i, _ in upper]

    def add(views: list[np.ndarray], out: np.ndarray) -> None:
        at = 0
        hands = _turns(views, turns)[1]
        for k, n in enumerate(sizes):
            for rows in hands[1 - k]:
                if rows.any():
                    out[at : at + n] += _products(views[k][rows])[upper[k]]
                at += n

    flat, out = _total(pool, 2 * sum(sizes), add), []
    for (i, j), half in zip(upper, np.split(flat, [2 * sizes[0]]), strict=True):
        both = np.zeros((2, i[-1] + 1, i[-1] + 1))
        both[:, i, j] = both[:, j, i] = half.reshape(2, -1)
        out.append(both)
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> CoTrained | None:
    """A classifier from a bounded sample of labelled and all unlabelled documents; None: no labels."""
    spark, docs = docs.sparkSession, _inputs(docs).where("doc_id IS NOT NULL")
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    ids = docs.select("doc_id").distinct()
    marked = known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    chosen = docs.join(F.broadcast(marked), "doc_id").withColumn("row", F.struct("doc_id", "label"))
    rows = _features(chosen.select("doc_id", "text", "source", "lang", "n_chars", "row"), "row").toArrow()
    key = rows.column("row").to_pylist()
    found = [np.concatenate(v) for v in zip(*map(_views, rows.to_batches()), strict=True)] if key else []
    del rows
    y = np.array([k["label"] for k in key])
    order = sorted(range(len(y)), key=lambda i: (key[i]["doc_id"], y[i], found[0][i].tobytes()))
    if len({*y}) < 2:
        return None
    folder = shared_folder(spark, "cotraining")
    # Features are stored and meet the labels, not the texts.
    pool = stored(_features(docs, "doc_id").join(known, "doc_id", "left_anti").drop("doc_id"), folder, "pool")
    model = CoTrained([v[order] for v in found], y[order], pool)
    drop_stored(spark, folder)
    return model


def score(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """A row for each document: the probabilities of both views and of their combination."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "content_score", "metadata_score", "score", "kept"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for low, high in runs(batch.column(1)):
                part = batch.slice(low, high - low)
                if model is None:
                    found = [np.full(len(part), 0.5)] * 3
                else:
                    found = model.probability([content_features(part.column(1)), metadata_features(part)])
                arrays = [pa.array(p.astype(float)) for p in found]
                kept = pa.array(found[2] >= LEAST_SCORE)
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays, kept], names=names)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, content_score double,"
    return _inputs(docs).mapInArrow(work, schema + " metadata_score double, score double, kept boolean")


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
