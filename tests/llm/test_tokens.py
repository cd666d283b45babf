"""Token ids, the Simple-8b codec and its files, packing."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from almanack.llm import token_files, tokens
from almanack.llm.packing import TIERS, pack_documents, pack_lot, step_groups
from almanack.llm.queries import QUERIES
from almanack.llm.simple8b import HEADER_BYTES, block_size, decode_block, encode_block
from almanack.llm.token_files import read_token_files, token_digests, write_token_files
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "A. b, É, x.y. .,. \nB, C.", "ΑΣ. ΑΣ, I. İ.", ",", ". ,", "a .", "a\n.", "a\n,b c.\nd.", "", "\n", "\n\n",
    " ", " a", "a ", "a  b", "a\n b", "a \nb", "a\n\nb", "\na", "a\tb c", "a\t b", "a \tb", "it's 's 'll x'll",
    "a\xa0b \xa0c\x1cd \x1ce", "é ̈a Á", "é. × .×, ÷.", "<|endoftext|> a<|endoftext|>", "中文 字", "a\r\nb",
    "a\x85b", "“q” x’s – e 　f", "x" * 200 + " " + "y" * 100, None,
]


def plain(path: str, texts: list) -> list[list[int]]:
    t = Tokenizer.from_file(path)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, True), (WORDS, False)])
@pytest.mark.parametrize("room", [1 << 21, 50])
def test_ids_are_those_of_whole_texts(spark, monkeypatch, path, spaces, room):
    docs = [r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()]
    monkeypatch.setattr(tokens, "REMEMBERED", room)
    encoder, texts = tokens.Encoder(path, spaces), docs + ODD
    column, want = pa.array(texts), plain(path, texts)
    assert [x.tolist() for x in encoder.encode(column)] == want
    assert [encoder.encode(column.slice(i, 1))[0].tolist() for i in range(len(texts))] == want


@given(st.lists(st.text("ab .,\n\t'É", max_size=12), max_size=8))
@settings(max_examples=150, deadline=None)
def test_ids_of_odd_spacing(texts):
    encoder = tokens.encoder(BYTES, True)
    assert [x.tolist() for x in encoder.encode(pa.array(texts, pa.string()))] == plain(BYTES, texts)


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 3) | st.integers(0, 60000), max_size=300))
@settings(max_examples=200, deadline=None)
def test_blocks_return_their_values(values):
    block = encode_block(np.array(values, np.uint64))
    head, body = block[:HEADER_BYTES], block[HEADER_BYTES:]
    assert block_size(head) == (len(values), len(body))
    assert decode_block(head, body).tolist() == values


def test_zeros_and_small_ids_are_packed():
    assert len(encode_block(np.zeros(1200, np.uint64))) == HEADER_BYTES + 80
    assert len(encode_block(np.full(600, 7, np.uint64))) == HEADER_BYTES + 240


def digests(rows: list, path: str, end: int) -> dict:
    out, start = {}, 0
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    ids = plain(path, [t for _, t in rows])
    for i in order:
        own = np.array([*ids[i], end], "<u4")
        out[rows[i][0]] = (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)
    return out


def test_token_files_query(spark):
    rows = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op1_token_files"](spark, f"{DATA}/sf0.001").collect()
    want = digests([tuple(r) for r in rows], BYTES, 0)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want
    assert len(got) == len(want)


def test_files_roll_and_return_the_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 16)
    rows = [(i, f"word{i} " * (i % 40)) for i in range(0, 400, 3)] + [(7, None), (-5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    write_token_files(docs, str(tmp_path / "ids"), BYTES, 0)
    got = read_token_files(spark, str(tmp_path / "ids")).collect()
    want = digests(rows, BYTES, 0)
    assert {r.doc_id: (r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got} == want
    assert not list((tmp_path / "ids").glob("_*"))


def test_null_ids_repeated_rows_and_no_rows(spark, tmp_path):
    rows = [(None, "a"), (None, None), (3, "b b"), (3, "b b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start")
    write_token_files(docs, str(tmp_path / "a"), BYTES, 0)
    got = token_digests(spark, str(tmp_path / "a"))
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got.collect()) == [(-1, 1), (-1, 2), (3, 3), (3, 3)]
    write_token_files(docs.limit(0), str(tmp_path / "b"), BYTES, 0)
    assert token_digests(spark, str(tmp_path / "b")).collect() == []


def check_windows(sizes, windows):
    pieces = sorted(p for _, ps in windows for p in ps)
    at = defaultdict(int)
    for doc, start, length in pieces:
        assert start == at[doc] and length > 0
        at[doc] += length
    assert dict(at) == {i: n for i, n in enumerate(sizes) if n}
    short = [t for t, ps in windows if sum(p[2] for p in ps) != t]
    assert len(short) <= 1
    assert all(t in TIERS and sum(p[2] for p in ps) <= t for t, ps in windows)


@given(st.lists(st.integers(0, 5000) | st.integers(1, 40) | st.sampled_from([256, 512, 1024, 2048]), max_size=60))
@settings(max_examples=200, deadline=None)
def test_lots_are_packed_whole(sizes):
    windows = pack_lot(sizes)
    check_windows(sizes, windows)
    groups = step_groups(windows)
    assert all(n <= 8 for n in np.bincount(groups)) if groups else True


def test_step_groups_cost_about_the_same():
    sizes = np.random.default_rng(1).integers(20, 3000, 2000).tolist()
    windows = pack_lot(sizes)
    cost = defaultdict(float)
    for (tier, ps), g in zip(windows, step_groups(windows), strict=True):
        cost[tier, g] += sum(p[2] ** 2 for p in ps)
    long = [c for (t, _), c in cost.items() if t == 2048]
    assert max(long) < 1.5 * min(long)


def test_packing_query(spark):
    rows = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip([r.doc_id for r in rows], plain(WORDS, [r.text for r in rows]), strict=True))
    ids = {d: np.array([*x, 1], "<u4") for d, x in ids.items()}
    got = QUERIES["op2_packing"](spark, f"{DATA}/sf0.001").collect()
    places, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part.tobytes()), len(ids[r.doc_id]))
        places[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for known, total in ((places, {d: len(x) for d, x in ids.items()}), (sequences, None)):
        for k, parts in known.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == total[k] if total else at <= 2048
    assert set(places) == set(ids)


def test_packing_of_nulls_and_repeats(spark):
    rows = [(None, "a b"), (1, None), (1, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS tier")
    got = pack_documents(docs.coalesce(1), WORDS, 1, with_ids=True).collect()
    assert sorted((r.doc_id or 0, r.ids) for r in got) == [(0, [*plain(WORDS, ["a b"])[0], 1]), (1, [1]), (1, [1]), (2, [1])]
    assert pack_documents(docs.limit(0), WORDS, 1).collect() == []


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, True), (WORDS, False)])
def test_special_tokens_in_texts_are_those_of_the_library(path, spaces):
    """As the library encodes by default: a literal special token is one id, in its own case only."""
    texts = [
        "a <|endoftext|> b", "a <|ENDOFTEXT|> b", "<|endoftext|>", "x<|endoftext|>y.\nz <|startoftext|>,", "a b",
        "<|EndOfText|> <|endoftext|>", None, "<|endoftext|>\n<|endoftext|> c.", "<|endoftext |>",
    ]
    library = Tokenizer.from_file(path)
    want = [e.ids for e in library.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert want[0] == ([64, 220, 50256, 275] if spaces else [320, 49407, 321])
    encoder = tokens.Encoder(path, spaces)
    assert [x.tolist() for x in encoder.encode(pa.array(texts))] == want
    for i in range(len(texts)):
        assert encoder.encode(pa.array(texts).slice(i, 1))[0].tolist() == want[i]
        assert tokens.Encoder(path, spaces).encode(pa.array(texts[::-1]).slice(i))[0].tolist() == want[::-1][i]


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, True), (WORDS, False)])
def test_ids_are_those_of_the_library_by_default(spark, path, spaces):
    docs = [r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()]
    library, texts = Tokenizer.from_file(path), docs + ODD
    want = [e.ids for e in library.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert [x.tolist() for x in tokens.Encoder(path, spaces).encode(pa.array(texts))] == want
