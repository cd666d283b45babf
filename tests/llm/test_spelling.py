"""Spelling variants by the frequency-vector trie."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from almanack.llm import spelling
from almanack.llm.queries import QUERIES
from almanack.llm.spelling import Words, letter_runs, near_words, one_edit, paths, reached, search, spelling_variants
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def neighbours(words):
    """Near words by what is left when a letter is taken out, checked."""
    holders = defaultdict(set)
    for w in words:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holders[k].add(w)
    return {w: {x for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for x in holders[k] if is_near(w, x)} for w in words}


def plain(counts):
    near, forms = neighbours(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 5 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, n, len(near[w]), forms[w], counts.get(forms[w]), root))
    return out


def rows_of(df):
    rows = [tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = plain(counted(docs))
    found = rows_of(QUERIES["op13_spelling_variants"](spark, f"{DATA}/sf0.01"))
    assert found == want
    assert sum(r[3] is not None for r in want) > 50 and any(r[3] not in (None, r[5]) for r in want)


@pytest.mark.parametrize("limit", [3, 40, 500])
def test_subtrees_and_blocks(spark, limit):
    """However the trie is cut, also where words of one path are too many."""
    rnd = random.Random(limit)
    words = {"".join(rnd.choices("enaé", k=rnd.randint(6, 8))) for _ in range(300)}
    words |= {"".join(rnd.sample("enaotr", 6)) for _ in range(150)} | {"x" * 45, "x" * 46, "x" * 44 + "yx", "z" * 300, "z" * 299 + "y"}
    counts = {w: 5 + len(w) * 7 ** (i % 4) for i, w in enumerate(sorted(words))}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    near = neighbours(counts)
    found = near_words(df, limit).collect()
    assert len(found) == len(counts)
    for r in found:
        best = min(near[r.word], key=lambda x: (-counts[x], x), default=None)
        assert (r.n, r.n_near, r.best, r.best_n) == (counts[r.word], len(near[r.word]), best, counts.get(best))


def test_odd_tables(spark):
    rows = [(1, None), (None, ""), (2, "kurz Wort"), (3, "ÀÉßçñü× " * 9), (3, "ÀÉßçñü× " * 9), (None, "VARIANT variant variants " * 6)]
    rows += [(i, f"Variante{'x' * (i % 3)} variants.variants1 " * 4 + "\x00e\u0301") for i in range(400)]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], SCHEMA + ", word string, n int")
    assert rows_of(spelling_variants(docs)) == plain(counted(rows))
    assert spelling_variants(docs.limit(0)).collect() == []


def test_chains_of_forms(spark):
    words = ["chained" + "abcdefg"[:k] for k in range(7)]
    rows = [(i, " ".join([w] * 5 * 5**k)) for i, k, w in zip(range(1000, 1007), range(7), words, strict=True)]
    want = plain(counted(rows))
    assert rows_of(spelling_variants(spark.createDataFrame(rows, SCHEMA))) == want
    assert ("chained", words[-1]) in {(r[0], r[5]) for r in want}


def test_long_texts_and_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "STRETCH", 16)
    text = "ab cdefghijkl " * 5 + "m" * 100 + "  " + "ordinary" * 3 + "é"
    assert list(letter_runs(text)) == re.findall("[A-Za-zÀ-ÿ]+", text)
    rows = [(i, f"{'q' * 5000} {'q' * 4999} words") for i in range(6)]
    assert rows_of(spelling_variants(spark.createDataFrame(rows, SCHEMA))) == plain(counted(rows))


WORD = st.text("abeé", min_size=1, max_size=6)


@given(WORD, WORD)
@settings(max_examples=500, deadline=None)
def test_one_edit(a, b):
    assert one_edit(a.encode("latin-1"), b.encode("latin-1")) == is_near(a, b)


@given(st.sets(WORD, max_size=40))
@settings(max_examples=150, deadline=None)
def test_search_finds_all_near_words_once(words):
    latin = sorted(w.encode("latin-1") for w in words)
    t = Words(latin) if latin else None
    if t is None:
        return
    order = sorted(range(len(latin)), key=lambda i: t.path[i].tolist())
    held = t.take(np.array(order))
    found = sorted((t.words[i], held.words[j]) for x, y in search(t, held) for i, j in zip(x.tolist(), y.tolist(), strict=True))
    assert found == sorted((a, b) for a in latin for b in latin if is_near(a.decode("latin-1"), b.decode("latin-1")))


def test_a_search_reaches_the_nodes_within_its_budget():
    word = paths([b"een"])
    nodes = {node for level, _, names, _, _ in reached(word, [{b""}, {b"\2"}]) for node in names if level == 2}
    assert nodes == {b"\2\0", b"\2\1", b"\2\2"}
    own = [(node, m) for _, _, names, mine, _ in reached(word, [{b""}]) for node, m in zip(names, mine, strict=True)]
    assert set(own) == {(b"", True), (b"\1", False), (b"\2", True), (b"\3", False)}


def test_subtree_without_words():
    table = pa.table({"shard": [b""], "word": ["abcdef"], "n": [5], "searches": [True], "held": [False]})
    assert spelling.searched(table).num_rows == 0
