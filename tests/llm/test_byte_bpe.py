"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import byte_bpe, registry

PATH = public_tokenizers.path(registry.RANKS)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def codec(**kwargs):
    return byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN, **kwargs)


SHARED = codec()
ODD = ["", " ", "\n\n  x", "don't we'LL", "aaaaaaaaa" * 30, "x" * 700, "é́́ß" * 90, "<|endoftext|>", "한국 日本 １２３ ½", "😀" * 40, "\u0085  　a", "a" * 20_001, " " * 3000, "=" * 515, "\x00\x1c\x7f"]


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_whole_documents(spark, sf, library):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()] + ODD
    expected = [library.encode_ordinary(t) for t in texts]
    small = codec(cache_pieces=100)  # the cache turns over often
    assert [ids(x) for a in range(0, len(texts), 7) for x in small.encode(texts[a : a + 7])] == expected
    assert [ids(x) for x in SHARED.encode(texts)] == expected
    assert [SHARED.decode(x).decode() for x in SHARED.encode(texts)] == texts


@given(st.lists(st.one_of(st.text(max_size=80), st.text("ab ", max_size=300)), max_size=4))
@settings(max_examples=200, deadline=None)
def test_any_text(library, texts):
    assert [ids(x) for x in SHARED.encode(texts)] == [library.encode_ordinary(t) for t in texts]


@given(st.lists(st.binary(min_size=1, max_size=40), min_size=1, max_size=30))
@settings(max_examples=100, deadline=None)
def test_forest_is_tree_is_repeated_search(pieces):
    """Both forms against the plain loop: find the leftmost pair of the least rank, merge it."""
    single = SHARED.single

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = [(SHARED.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in SHARED.ranks]
            if not found:
                return [SHARED.ranks[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    expected = [plain(p) for p in pieces]
    assert [byte_bpe.merge_tree(single[np.frombuffer(p, np.uint8)].tolist(), SHARED.pairs.dict) for p in pieces] == expected
    flat = np.frombuffer(b"".join(p.ljust(64, b"\0") for p in pieces), np.uint8).reshape(-1, 64)
    found, live = byte_bpe.merge_forest(single[flat], np.array([len(p) for p in pieces]), SHARED.pairs)
    assert [row[on].tolist() for row, on in zip(found, live, strict=True)] == expected


def test_long_text_in_parts(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 50)
    monkeypatch.setattr(byte_bpe, "PIECES", 7)
    texts = ["a long text, in parts of seven pieces " * 9 + "z" * 300, "short"]
    assert [ids(x) for x in codec().encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_query(spark, sf, library):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = registry.op13_byte_bpe(spark, sf).collect()
    assert sorted(r.doc_id for r in found) == sorted(rows)
    for r in found:
        own = library.encode_ordinary(rows[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(), hashlib.sha256(rows[r.doc_id].encode()).hexdigest())


def test_odd_rows(spark, library):
    rows = [(None, "no id", "x", 1), (5, None, "x", 1), (5, "", None, 1), (7, "twice", "x", 1), (7, "twice", "x", 1), (8, "w" * 100_000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, Decoded string, ids int")
    encoded = byte_bpe.encode(docs, PATH)
    assert sorted((repr(r.doc_id), ids(r.ids)) for r in encoded.collect()) == sorted((repr(i), library.encode_ordinary(t or "")) for i, t, _, _ in rows)
    back = byte_bpe.decode(encoded.selectExpr("ids", "doc_id as Decoded"), PATH)
    assert back.columns == ["ids", "Decoded", "_decoded"] and sorted(bytes(r._decoded).decode() for r in back.collect()) == sorted(t or "" for _, t, _, _ in rows)
    assert byte_bpe.decode(encoded.selectExpr("cast(null as binary) as ids"), PATH).where("decoded is not null").count() == 0
    assert byte_bpe.digests(byte_bpe.encode(docs.limit(0), PATH), PATH).count() == 0
