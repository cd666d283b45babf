"""Fill-in-the-middle by piece tables."""

import hashlib
import re

import pytest
from almanack.llm import fill_in_middle as fim
from almanack.llm.fill_in_middle import Piece, Transform, arrange, cut, disarrange, fill_in_middle, restored, restored_digests
from almanack.llm.oracles import ORACLES
from almanack.llm.queries import QUERIES
from compare import difference, oracle
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

ODD = [
    None, "", "\n", "\n\n", "a", "a\n", "a\nb", "é\n漢字\n😀", "a<P>b\nc", "<S>", "x\n<M>", "<P\n>", "<", "P>\n<", "a\r\nb\x0bc\u2028d\n",
    "x\n" * 300, "no break " * 50, "<P\nS>\n<\nM>",
]


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, drawn = len(units), hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i : i + 8], 16) for i in range(0, 32, 8)]
    sha = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, text, sha
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < 50 else "psm"
    output = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), output, hashlib.sha256(output.encode()).hexdigest()


def test_query_agrees_with_sql(spark):
    found = QUERIES["op12_fill_in_middle"](spark, f"{DATA}/sf0.01")
    assert difference(found, oracle(f"{DATA}/sf0.01"), ORACLES["op12_fill_in_middle"]) is None


@pytest.mark.parametrize("stretch", [2, 1 << 20])
def test_odd_texts_and_tables(spark, monkeypatch, stretch):
    monkeypatch.setattr(fim, "STRETCH", stretch)
    rows = [(None if i % 5 == 4 else i, t, "o", 1) for i, t in enumerate(ODD * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n int")
    formed = fill_in_middle(docs)
    want = [plain(r[0], r[1]) for r in rows]
    assert sorted(map(tuple, formed.collect()), key=str) == sorted(want, key=str)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    back = sorted((str(r.doc_id), r.form, r.text) for r in restored(formed).collect())
    assert back == sorted((str(r[0]), w[2], r[1] or "") for r, w in zip(rows, want, strict=True))
    digests = sorted(r.restored_sha256 for r in restored_digests(formed).collect())
    assert digests == sorted(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows)
    assert restored_digests(fill_in_middle(docs.limit(0))).collect() == []


def test_one_very_long_text(spark):
    line = "line of some words é\n"
    text = line * (24_000_000 // len(line))
    docs = spark.range(1).selectExpr("id AS doc_id", f"repeat('{line.strip()}\n', {len(text) // len(line)}) AS text")
    row = restored_digests(fill_in_middle(docs)).first()
    assert row.n == len(text) // len(line)
    assert row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


@given(st.text("ab\n<P>SMé", max_size=30), st.integers(0, 10**6))
@settings(max_examples=300, deadline=None)
def test_small_texts(text, doc_id):
    raw = memoryview(text.encode())
    n, form, prefix, middle, pieces = Transform(7, 100, 50)(doc_id, raw)
    output = b"".join(fim.views(pieces, raw))
    assert (doc_id, n, form, prefix, middle, output.decode(), fim.digest(pieces, raw)) == plain(doc_id, text)


def test_percentages():
    forms = [Transform(7, 40, 0)(i, memoryview(b"a\nb\nc"))[1] for i in range(500)]
    assert 150 < forms.count("psm") < 250 and forms.count("spm") == 0


@given(st.lists(st.integers(0, 5), min_size=1, max_size=4), st.data())
@settings(max_examples=200, deadline=None)
def test_cut_and_arrange_of_piece_tables(lengths, data):
    """A document of several pieces is cut anywhere, and the inverse permutation restores it."""
    pieces, at = [], 0
    for k in lengths:
        pieces.append(Piece(fim.TEXT, at, at + k))
        at += k + 1
    text = bytes(range(65, 65 + at))
    whole = b"".join(fim.views(pieces, memoryview(text)))
    a, b = sorted(data.draw(st.integers(0, len(whole))) for _ in range(2))
    parts = cut(pieces, a, b)
    assert [b"".join(fim.views(p, memoryview(text))) for p in parts] == [whole[:a], whole[a:b], whole[b:]]
    for form, order in fim.ARRANGED.items():
        segments = [parts[k] for k in order]
        assert b"".join(fim.views(disarrange(segments, form), memoryview(text))) == whole
        assert len(arrange(parts, form)) == 3 + sum(map(len, parts))


def test_wrong_form_is_refused():
    with pytest.raises(ValueError, match="form"):
        fim.segments_of(memoryview(b"<S>a<P>b<M>c"), "psm")
