"""Jaccard join, decontamination, co-training, archives, pipeline."""

import base64
import hashlib
import random
import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from almanack.llm import cotraining, decontaminate, parity, pii, repetition, warc
from almanack.llm.components import components
from almanack.llm.queries import ORACLES, QUERIES
from almanack.llm.storage import shared_folder
from brute import components as plain_components
from brute import contained, shingles
from brute import repetition as plain_repetition
from compare import difference, oracle
from conftest import DATA


def table(spark, name, sf="sf0.001", columns=("doc_id", "text")):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/{sf}/{name}.parquet").select(*columns).collect()]


def near_copies(seed=2):
    random.seed(seed)
    vocabulary, rows = [f"w{i}" for i in range(2000)], []
    for _ in range(40):
        n = random.choice([1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 64, 66, 80, 250, 255, 300, 400, 1100])
        base = random.choices(vocabulary, k=n)
        for _ in range(random.choice([1, 2, 5, 40])):
            w = list(base)
            for _ in range(random.randint(0, max(1, n // 25))):
                w[random.randrange(len(w))] = random.choice(vocabulary)
            if random.random() < 0.2:
                w += random.choices(vocabulary, k=int(n * random.uniform(0, 0.35)))
            rows.append((len(rows) * 3, " ".join(w)))
    passage = random.choices(vocabulary, k=55)
    for _ in range(80):
        before, after = (random.choices(vocabulary, k=random.randint(5, 60)) for _ in range(2))
        rows.append((len(rows) * 3, " ".join(before + passage + after)))
    odd = [None, "", " \n", "Only One", "only one"]
    return rows + [(10**6 + i, t) for i, t in enumerate(odd)]


@pytest.mark.parametrize(("small", "block", "spare"), [(8, 1024, 16), (3, 5, 16), (3, 1024, 0)])
def test_join_equals_all_pairs(spark, monkeypatch, small, block, spare):
    """Also with few small buckets and keys to spare, so that the second way is taken."""
    monkeypatch.setattr(parity, "SMALL_BUCKET", small)
    monkeypatch.setattr(parity, "SLOT_MEMBERS", block)
    monkeypatch.setattr(parity, "SPARE_KEYS", spare)
    monkeypatch.setattr(parity, "HOT_GROUP", block)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity.jaccard_components(docs).collect()}
    assert got == plain_components(rows)


def test_join_query(spark):
    rows = table(spark, "documents")
    got = QUERIES["op7_jaccard_join"](spark, f"{DATA}/sf0.001").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows)


def test_join_agrees_with_sql(spark):
    found = QUERIES["op7_jaccard_join"](spark, f"{DATA}/sf0.01")
    assert difference(found, oracle(f"{DATA}/sf0.01"), ORACLES["op7_jaccard_join"]) is None


def test_sketch_distance_bounds_the_difference():
    random.seed(1)
    for _ in range(200):
        a = {random.getrandbits(64) for _ in range(random.randint(1, 400))}
        b = {x for x in a if random.random() < 0.8} | {random.getrandbits(64) for _ in range(random.randint(0, 400))}
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        distance = parity.sketch_distance(parity.compact_sketch(x), parity.compact_sketch(y))
        assert distance <= len(a ^ b) and (distance - len(a ^ b)) % 2 == 0


def test_one_document_of_each_group_stays(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(5, words, 1), (3, words.upper(), 2), (3, words.upper(), 2), (9, words + " more", 3), (4, None, 4), (6, "", 5)]
    rows += [(None, words, 6), (None, None, 7), (8, "one text", 8), (8, "another text", 9), (8, "one text", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = parity.keep_one_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.component_id for r in got.collect()) == [2, 4, 5, 6, 7, 8, 9]
    found = {(r.doc_id, r.component_id) for r in parity.jaccard_components(docs).collect()}
    assert found == {(5, 3), (3, 3), (9, 3), (4, 4), (6, 6), (8, 8), (None, None)}
    assert parity.keep_one_each(docs.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i + 1, i) for i in range(20, 60)] + [(5, x) for x in range(100, 120)] + [(110, 50)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df, shared_folder(spark, "test"), "c").collect()}
    assert got == dict.fromkeys([*range(20, 61), 5, *range(100, 120)], 5)


def test_decontamination_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 900)  # several blocks
    random.seed(1)
    items = table(spark, "benchmark", columns=("item_id", "text"))
    docs = table(spark, "documents")
    for k in range(60):
        w = random.choice(items)[1].split()
        part = w[random.randint(0, len(w) // 3) : random.randint(len(w) // 2, len(w))]
        docs.append((5000 + k, " ".join(["x", "the"] * 10 + part + ["y"] * random.randint(0, 50))))
    docs += [(6000, None), (6001, ""), (6002, "of the of"), (6003, "AND"), (None, items[0][1])]
    items += [(900, "the of"), (901, None), (902, ""), (903, "And"), (904, "a b c d e f"), items[0]]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(d, i)
    pairs = [(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got.collect()]
    want = contained(docs, items)
    assert set(pairs) == want and len(pairs) == len(want)
    bad = {p[0] for p in want}
    clean = decontaminate.decontaminate(d, i)
    assert clean.columns == d.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(x for x, _ in docs if x not in bad)
    for empty in (decontaminate.contaminated(d.limit(0), i), decontaminate.contaminated(d, i.limit(0))):
        assert empty.collect() == []


def test_decontamination_query(spark):
    got = QUERIES["op5_decontamination"](spark, f"{DATA}/sf0.01").collect()
    items = table(spark, "benchmark", "sf0.01", ("item_id", "text"))
    want = contained(table(spark, "documents", "sf0.01"), items)
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got} == want and want


def test_cotraining_tells_quality_on_unseen_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    seen = labels.where("doc_id % 10 >= 3")
    model = cotraining.fit(docs, seen)
    assert model.handed_over > 0
    unseen = cotraining.score(docs, model).join(labels.where("doc_id % 10 < 3"), "doc_id").collect()
    good, bad = ([r.kept for r in unseen if r.quality == q] for q in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05


def test_cotraining_query(spark):
    got = QUERIES["op3_cotraining"](spark, f"{DATA}/sf0.01").collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in got)


def test_cotraining_of_odd_rows(spark):
    rows = [(None, None, None), (1, "", "x"), (1, "", "x"), (2, "a " * 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    got = cotraining.classify_quality(docs, none)
    assert [(r.score, r.kept) for r in got.collect()] == [(0.5, True)] * 4
    assert cotraining.classify_quality(docs.limit(0), none).collect() == []
    good, bad = [(i, f"the cat {i} sat on a mat") for i in range(20)], [(50 + i, "### *** |||" * 5) for i in range(20)]
    docs = spark.createDataFrame(good + bad + [(None, None), (99, "the cat 9 sat on a mat")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 50)) for i, _ in good + bad], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in cotraining.classify_quality(docs, labels).collect()}
    assert got[99] and got[0] and not got[50] and None in got


def plain_pages(rows):
    first = {}
    for page_id, _, html in sorted(rows, key=lambda r: r[0]):
        first.setdefault(html or "", page_id)
    out = {}
    for page_id, _, html in rows:
        payload, response = (html or "").encode(), first[html or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        own = response == page_id
        out[page_id] = (len(payload), digest, "response" if own else "revisit", None if own else response)
    return out


def fields(rows):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows}


def test_archives_return_the_pages(spark, tmp_path):
    rows = [(i, f"http://é.example/{i}", f"<p>{i % 7} ü" * (i % 5)) for i in range(200)]
    rows += [(300, None, None), (301, "http://x y\r\nz", ""), (302, "", "one")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest")
    for name in ("a", "b"):
        warc.write_warc(pages.repartition(3), str(tmp_path / name), file_bytes=4000)
    got = warc.read_warc(spark, str(tmp_path / "a"), with_html=True).collect()
    assert fields(got) == plain_pages(rows) and len(got) == len(rows)
    html = {p: h or "" for p, _, h in rows}
    assert all(r.html == html[r.page_id] for r in got if r.record_type == "response")
    again = warc.read_warc(spark, str(tmp_path / "b")).collect()
    assert {r.record_id for r in got} == {r.record_id for r in again}
    files = sorted((tmp_path / "a").glob("part-*.warc.gz"))
    assert len(files) > 1 and not list((tmp_path / "a").glob("_*"))
    order = [int(h["X-Page-Id"]) for f in files for h, _ in warc.records_of(f"file://{f}")]
    assert order == sorted(order)


def test_archives_of_odd_rows(spark, tmp_path):
    rows = [(None, "u", "same"), (None, "u", "same"), (4, "u", "same"), (4, "u", "same"), (2, "u", "same"), (8, "u", "x"), (9, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "a"), least_bytes=2)
    got = warc.read_warc(spark, str(tmp_path / "a")).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got)
    assert kinds == [(0, "response", None)] * 2 + [(2, "response", None)] + [(4, "revisit", 2)] * 2 + [(8, "response", None), (9, "response", None)]
    warc.write_warc(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_warc(spark, str(tmp_path / "b")).collect() == []


def test_archive_query(spark):
    rows = table(spark, "pages", "sf0.01", ("page_id", "url", "html"))
    got = QUERIES["op8_warc"](spark, f"{DATA}/sf0.01").collect()
    assert fields(got) == plain_pages(rows) and len(got) == len(rows)


def test_pipeline_stages_equal_plain_forms(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "n-gram Jaccard join" and len(corpus_pipeline.STAGES) == 5
    rows = [tuple(r) for r in docs.collect()]
    stages = [f for _, f in corpus_pipeline.STAGES]

    got = stages[0](spark, docs, f"{DATA}/sf0.01")
    kept = repetition.measure(pa.array([r[1] for r in rows]))["kept"].to_pylist()
    rows = [r for r, k in zip(rows, kept, strict=True) if k]
    assert not any(plain_repetition(r[1])[5] for r in rows)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(rows)

    got = stages[1](spark, spark.createDataFrame(rows, docs.schema), f"{DATA}/sf0.01")
    of = plain_components([r[:2] for r in rows])
    rows = [r for r in rows if of[r[0]][1] == r[0]]
    assert sorted(map(tuple, got.collect())) == sorted(rows)

    got = stages[2](spark, spark.createDataFrame(rows, docs.schema), f"{DATA}/sf0.01")
    bad = {p[0] for p in contained([r[:2] for r in rows], table(spark, "benchmark", "sf0.01", ("item_id", "text")))}
    rows = [r for r in rows if r[0] not in bad]
    assert sorted(map(tuple, got.collect())) == sorted(rows)

    got = stages[3](spark, spark.createDataFrame(rows, docs.schema), f"{DATA}/sf0.01")
    rows = [(d, pii.redacted(t), *more) for d, t, *more in rows]
    found = sorted(map(tuple, got.collect()))
    assert [r[:2] for r in found] == sorted(r[:2] for r in rows) and all(r[4] == len(r[1]) for r in found)

    result = corpus_pipeline.run(spark, f"{DATA}/sf0.01").collect()
    assert {r.doc_id for r in result} == {r[0] for r in rows}


def test_pipeline_takes_no_rows(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{DATA}/sf0.001")
    assert corpus_pipeline.packing(spark, docs, f"{DATA}/sf0.001").collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_sql(spark, name):
    sf_dir = f"{DATA}/sf0.01"
    assert difference(QUERIES[name](spark, sf_dir), oracle(sf_dir), ORACLES[name]) is None


def test_short_texts_are_one_shingle():
    assert decontaminate.shingle_texts("One\ttwo") == {"one two"} and shingles("One two") == {("one", "two")}


def test_cotraining_hands_over_from_all_unlabelled_rows(spark):
    rows = [(i, f"the cat {i % 97} sat on a mat" if i % 2 else "### *** |||" * 5) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.range(200).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    model = cotraining.fit(docs, labels)
    # In four rounds a fixed pool of 6,000 handed over 3,200 rows at most; views now hand over a share of all.
    assert model.handed_over > 4 * 1_000
    free = spark.range(200, 20_000).count()
    assert model.handed_over <= 2 * free


def test_pipeline_keeps_the_packed_ids(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    got = corpus_pipeline.packing(spark, docs, f"{DATA}/sf0.001").collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.select("doc_id").collect()}
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_links_of_a_group_join_its_components():
    """As many links as join what all links join, and no more; only between the two sides."""
    random.seed(4)
    vocabulary = [random.getrandbits(64) for _ in range(4000)]
    for trial in range(25):
        sets, component = [], []
        for _ in range(random.randint(1, 6)):
            base = random.sample(vocabulary, random.choice([1, 3, 12, 60, 70, 250, 300]))
            for _ in range(random.randint(1, 14)):
                kept = [x for x in base if random.random() < 0.93] or base
                extra = random.sample(vocabulary, random.randint(0, 1 + len(base) // 12))
                sets.append(np.unique(np.array(kept + extra, np.uint64)))
                component.append(random.choice([len(component), max(0, len(component) - 1)]))
        n, side = len(sets), np.array([random.random() < 0.5 for _ in sets])
        left, right = (np.ones(n, bool), np.ones(n, bool)) if trial % 2 else (side, ~side)
        parent = list(range(n))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        def groups(links, parent=parent, component=component, n=n, root=root):
            parent[:] = range(n)
            for a, b in links:
                parent[root(a)] = root(b)
            return {frozenset(i for i in range(n) if root(i) == r) for r in map(root, range(n))}

        same = [(i, component.index(c)) for i, c in enumerate(component)]
        every = [
            (a, b) for a in range(n) for b in range(a)
            if ((left[a] and right[b]) or (left[b] and right[a])) and parity.linked(sets[a], sets[b])
        ]
        found = parity.links_between(np.array(component), sets, left, right)
        assert all(tuple(sorted(x, reverse=True)) in every for x in found)
        assert len(found) < len(set(component)) or not found
        assert groups([*same, *found]) == groups([*same, *every])


def test_a_large_group_of_near_but_unlinked_copies(spark, monkeypatch):
    """Rows that leave the tasks grow no faster than the group, here of a template with own words."""
    emitted = {}
    for n in (300, 1200):
        template = [f"t{i}" for i in range(60)]
        rng = random.Random(n)
        rows = [(i, " ".join(template + [f"u{rng.getrandbits(40)}" for _ in range(26)])) for i in range(n)]
        rows += [(n + i, rows[i][1] + " end") for i in range(0, n, 10)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        join, sizes = parity._Join(docs), []
        keep = join.stored

        def counted(df, name, keep=keep, sizes=sizes):
            found = keep(df, name)
            sizes.append((name, found.count()))
            return found

        join.stored = counted
        got = {r.doc_id: r.component_id for r in join.run().collect()}
        assert got == {d: i for i, (d, _) in enumerate(rows[:n])} | {n + i: i for i in range(0, n, 10)}
        emitted[n] = {name: size for name, size in sizes if name in ("small-near", "rest-near", "rest-links", "first-near")}
    for name, size in emitted[1200].items():
        assert size <= 5 * max(emitted[300].get(name, 0), 100), emitted


@pytest.mark.parametrize("labels", [[1, 0, 0, 0], [1, 0, 0, 0, 0, 1, 0, 0, 0, 0], [0, 1], [0, 1, 1, 0, 0, 0]])
def test_cotraining_of_few_labels(spark, labels):
    rows = [(i, f"the cat {i} sat" if y else "### *** |||" * 5) for i, y in enumerate(labels)] + [(90, "a dog sat"), (91, "***")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int")
    got = cotraining.classify_quality(docs, known).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("group", [2, 32])
def test_one_round_equals_a_plain_form(spark, monkeypatch, group):
    """Bounds, what is handed over and the sums that follow, written plainly with all rows at hand."""
    monkeypatch.setattr(cotraining, "GROUP", group)
    monkeypatch.setattr(cotraining, "SURE", 0.6)
    rng = random.Random(8)
    good, bad = "the cat sat on a mat and looked out".split(), "### *** ||| $$$ %%".split()
    rows = []
    for i in range(400):
        kind = i % 2 if rng.random() < 0.9 else 1 - i % 2
        words = rng.choices(good if kind else bad, k=rng.randint(3, 30)) + rng.choices(good + bad, k=rng.randint(0, 9))
        rows.append((i, " ".join(words), f"s{i % 5 + 5 * kind}", "en", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(7)
    inputs = cotraining._inputs(docs)
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in inputs.orderBy("doc_id").collect()], inputs.toArrow().schema)
    both = [cotraining.content_features(batch.column(1)), cotraining.metadata_features(batch)]
    y = np.array([i % 2 for i in range(80)])
    views, free = [v[:80] for v in both], [v[80:].astype(float) for v in both]
    pool = cotraining._features(inputs.where("doc_id >= 80"), "doc_id").drop("doc_id")
    model = cotraining.CoTrained(views, y, pool, rounds=1)

    held = np.isin(np.arange(80), [*range(0, 80, 10), *range(1, 80, 10)])

    def fitted(x, label):
        """Ridge regression on +1 and -1 in which classes weigh alike; the bias is all but free."""
        x = np.column_stack([x, np.ones(len(x))])
        weight = np.where(label > 0, 0.5 / (label > 0).sum(), 0.5 / (label == 0).sum())
        ridge = np.diag([1e-3] * (x.shape[1] - 1) + [1e-9])
        return np.linalg.solve((x * weight[:, None]).T @ x + ridge, (x * weight[:, None]).T @ np.where(label > 0, 1.0, -1.0))

    first = [fitted(v[~held].astype(float), y[~held]) for v in views]
    given = []
    for v, f, w in zip(views, free, first, strict=True):
        scale = cotraining._calibrated(v[held] @ w[:-1] + w[-1], y[held])
        odds = np.clip((f @ w[:-1] + w[-1]) * scale[0] + scale[1], -30, 30)
        cells = np.rint((odds + 30) * 64)
        sure, take = np.log(0.6 / 0.4), len(f) / 15
        down, up = np.sort(cells), np.sort(cells)[::-1]
        # The bin of the row that completes the share; halves, as half of the labels are good.
        low = min(down[int(np.ceil(take * 0.5)) - 1], 30 * 64 - np.ceil(sure * 64))
        high = max(up[int(np.ceil(take * 0.5)) - 1], 30 * 64 + np.ceil(sure * 64))
        given.append((cells <= low, cells >= high))
    assert model.handed_over == sum(int(a.sum() + b.sum()) for a, b in given) > 0
    for k in (0, 1):
        down, up = given[1 - k]
        x = np.concatenate([views[k][~held], free[k][down], free[k][up]])
        label = np.concatenate([y[~held], np.zeros(down.sum()), np.ones(up.sum())])
        assert np.allclose(model.weights[k], fitted(x, label), rtol=1e-4, atol=1e-5)
