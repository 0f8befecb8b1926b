"""Fill-in-middle transformation against SQL and a string version."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.llm import fim, registry

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def by_strings(doc_id, text, policy=fim.Policy()):
    """``n, form, prefix_chars, middle_chars, output`` by slices of a list of units."""
    text = text or ""
    units = re.findall(fim.UNIT, text)
    h = hashlib.sha256(f"{policy.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m.decode() in text for m in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)) or h3 % 100 >= policy.rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < policy.spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def by_scatter(texts, ids, policy=fim.Policy()):
    array = pa.array(texts, pa.string())
    found = fim.transformed(array, ids, policy)
    output = found.pop("output")
    assert fim.restored(output.cast(pa.string()), found["form"]).to_pylist() == texts
    return list(zip(*found.values(), output.to_pylist(), strict=True))


PIECES = st.lists(st.sampled_from(["a", "Ünï", " ", "\n\t", "\x1f", "<", ">", "P", "<S>", "<P", "M>", "😀", " ", "\x0b"]), max_size=25).map("".join)


@given(st.lists(st.tuples(PIECES, st.integers(-50, 5000)), max_size=8))
@settings(max_examples=300, deadline=None)
def test_scatter_is_slicing(rows):
    for policy in (fim.Policy(), fim.Policy(7, 100, 50)):
        assert by_scatter([t for t, _ in rows], [i for _, i in rows], policy) == [by_strings(i, t, policy) for t, i in rows]


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_blocks(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    texts = ["one two  three\n", "", " \t ", "é" * 50 + " x " * 20, "<P> plain", "<", "P>"]
    for ids in (range(7), range(100, 107), [None] * 7):
        assert by_scatter(texts, list(ids), fim.Policy(rate=100)) == [by_strings(i, t, fim.Policy(rate=100)) for i, t in zip(ids, texts, strict=True)]


def test_sliced_array():
    whole = pa.array(["x y", "a b c", "d e f g", ""])
    assert fim.transformed(whole.slice(1, 2), [1, 5], fim.Policy(rate=100))["output"].to_pylist() == [by_strings(i, t, fim.Policy(rate=100))[4] for i, t in ((1, "a b c"), (5, "d e f g"))]


def test_query_is_sql_and_strings(spark, sf):
    found = registry.op12_fim_scatter(spark, sf).select(*COLUMNS)
    mine = sorted(tuple(r) for r in found.collect())
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert mine == sorted(duckdb.sql(registry.ORACLE_SQL["op12_fim_scatter"]).select(*COLUMNS).fetchall())
    assert {r[2] for r in mine} == {"plain", "psm", "spm"}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert mine == sorted((i, *(x := by_strings(i, t))[:4], hashlib.sha256(x[4].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


def test_odd_rows(spark):
    rows = [(None, "no id here", "x", 1), (5, None, "x", 1), (5, "", None, 1), (7, "w " * 100_000, "x", 1), (7, "w " * 100_000, "x", 1), (8, "<M>", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, output string, n int")
    found = fim.restore(fim.transform(docs, fim.Policy(rate=100)))
    assert sorted(map(repr, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found.collect()))) == sorted(repr((i, *by_strings(i, t, fim.Policy(rate=100)))) for i, t, _, _ in rows)
    assert sorted(r.restored for r in found.collect()) == sorted(t or "" for _, t, _, _ in rows)
    clash = fim.restore(fim.transform(docs).withColumn("Restored", F.lit(1)))
    assert clash.columns[-2:] == ["Restored", "_restored"] and clash.count() == len(rows)
    assert fim.digests(fim.transform(docs.limit(0))).count() == 0
