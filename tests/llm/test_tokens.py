"""Tokens, token files and packing against the tokenizers library's own ids."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import packing, registry, token_files
from larkspur.llm.common import new_path
from larkspur.llm.tokens import WordTokenizer, tokenizer

PATH = public_tokenizers.path(registry.TOKENIZER)
ODD = ["", " ", None, "don't we'll IT'S", "a\x1cb  c", "İstanbul ΣΑΣ ςσ <|endoftext|> x<|startoftext|>y", "Ǆ ﬁ é É ½ ²", "한국 日本 123 a1b2_c", "!!Wow...(really)", "x" * 3000, "é́ é ́a", "　全角 x"]


def own_ids(text):
    return [*tokenizer(PATH).library.encode(text or "", add_special_tokens=False).ids, 1]


def ids(data, t):
    return np.frombuffer(data, t.dtype).tolist()


def test_ids_are_the_librarys(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()] + ODD
    t = WordTokenizer(PATH, cache_chunks=50)  # the cache turns over often
    assert [ids(x, t) for x in t.encode(texts)] == [own_ids(x) for x in texts]


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_any_text(text):
    t = tokenizer(PATH)
    assert ids(t.encode([text])[0], t) == own_ids(text)


@pytest.fixture
def docs(spark):
    rows = [(5, "b c"), (None, "no id"), (1, ODD[3]), (5, "a"), (9, None), (2, "long " * 5000), (-3, "")]
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, start string, ids int"), rows


def test_token_files_round_trip(spark, docs):
    df, rows = docs
    store = token_files.write_token_files(df, new_path(spark, "t"), PATH, shards=3)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for i, t in order:
        e = own_ids(t)
        expected.append((i, start, len(e), np.array(e, "<u4").tobytes()))
        start += len(e)
    got = [tuple(r) for r in token_files.read_documents(spark, store).orderBy("start").collect()]
    assert [(a, b, c, bytes(d)) for a, b, c, d in got] == expected
    assert [r.ids_crc32 for r in token_files.document_digests(spark, store).orderBy("start").collect()] == [zlib.crc32(e[3]) for e in expected]
    folder = Path(store.uri.removeprefix("file://"))
    assert sum(p.stat().st_size for p in folder.glob("*.bin")) == 2 * start and not list(folder.glob(".0*"))


def test_empty_table(spark, docs):
    none = docs[0].limit(0)
    assert token_files.read_documents(spark, token_files.write_token_files(none, new_path(spark, "t"), PATH, shards=2)).count() == 0
    assert packing.pack(none, PATH).count() == 0


def test_piece_lengths():
    for n in (1, 2, 3, 2047, 2048, 2049, 10_000):
        p = packing.piece_lengths(n, 2048)
        assert sum(p) == n and all(x & (x - 1) == 0 for x in p) and p == sorted(p, reverse=True) and len(set(x for x in p if x < 2048)) == len([x for x in p if x < 2048])


def test_pack(spark, docs):
    df, rows = docs
    pieces = packing.pack(df, PATH, sequence_length=16)
    got = pieces.collect()
    by_doc: dict = {}
    for r in sorted(got, key=lambda r: r.start):
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert sorted(len(own_ids(t)) for _, t in rows) == sorted(k[1] for k in by_doc)
    for (_, n), ps in by_doc.items():
        at = 0
        for p in ps:
            assert p.start == at and p.offset == 0 and p.length == 1 << p.bucket
            at += p.length
        assert at == n
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    order = sorted(got, key=lambda r: r.sequence_id)
    assert [r.bucket for r in order] == sorted(r.bucket for r in got)
    crc = {(r.doc_id, r.doc_tokens, r.start): r.ids_crc32 for r in packing.with_crc32(pieces).collect()}
    long = own_ids("long " * 5000)
    assert crc[2, len(long), 16] == zlib.crc32(np.array(long[16:32], "<u4").tobytes())
