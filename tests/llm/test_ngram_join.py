"""The n-gram join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from larkspur.llm import graph, ngram_join
from larkspur.llm.shingles import shingle_sets, sketch


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """Smallest id that links lead to, by comparison of all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, component_id int")
    got = ngram_join.similar_components(df, **options).collect()
    expected = brute(rows)
    assert len(got) == len(rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles) for r in got) == sorted((i is not None, i or 0, len(shingles(t))) for i, t in rows)
    assert all(r.component_id == (None if r.doc_id is None else expected[r.doc_id]) for r in got)
    return expected


def test_shingles_of_odd_texts():
    texts = [None, "", " \t", "a", "A a", "a b c d", "a b c d e", "A B\x0bc D\x0ce f", "é ÉÈ x", "a b c", "x " * 300]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    assert (shingle_sets(["A b C d e F"])[0] == shingle_sets(["a B c D e f"])[0]).all()


def test_pigeonhole_never_misses():
    rng = random.Random(5)
    for n in [*range(4, 70), 100, 350, 900]:
        for _ in range(10):
            size = rng.randint(n, ngram_join.largest_partner(n))
            common = -(-80 * (n + size) // 180)
            if common > n:
                continue
            base = [rng.getrandbits(64) for _ in range(n)]
            a = np.unique(np.array(base, np.uint64))
            b = np.unique(np.array(base[:common] + [rng.getrandbits(64) for _ in range(size - common)], np.uint64))
            keys, owner, _ = ngram_join.keys_of([a, b])
            assert set(keys[owner == 0]) & set(keys[owner == 1])
            apart = int(np.bitwise_count(sketch(a).view(np.uint64) ^ sketch(b).view(np.uint64)).sum())
            assert apart <= n + size - 2 * common


def texts_with_copies(rng, n, common=""):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = words(rng.choice(rows)[1])
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join([*(f"w{rng.randrange(500)}" for _ in range(rng.choice((3, 6, 9, 30, 120)))), common])))
    return rows


@pytest.mark.parametrize("all_pairs", [2, 10])
def test_against_all_pairs(spark, all_pairs):
    rng = random.Random(9)
    rows = texts_with_copies(rng, 150) + texts_with_copies(rng, 60, "this work is licensed under the general public license version three " * 3)
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + [(1000, None), (1001, ""), (1002, "   "), (None, rows[0][1]), (None, None)]
    assert len(set(check(spark, rows, all_pairs=all_pairs).values())) < 150


def test_chain_and_large_group(spark):
    """Links that only lead on, and a group far larger than what is paired at once."""
    w = [f"w{i}" for i in range(100)]
    chain = [(i, " ".join(w[: 100 - 0] if not i else [*(f"c{i}{j}" for j in range(0)), *w[4 * i :], *(f"n{k}" for k in range(4 * i))])) for i in range(12)]
    near = [(100 + i, " ".join([*w[:50], f"x{i}", *w[51:], *w])) for i in range(40)]
    check(spark, chain + near, all_pairs=3)


def test_many_components_in_one_group(spark):
    """Copies of an original that are near it but not near one another, and others that only look near."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(10_000, " ".join(base))]
    for i in range(600):
        w = list(base)
        for _ in range(2 if i % 3 else 4):  # four edits are too many, two on either side are, too
            w[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(w)))
    sets = [(i, shingles(t)) for i, t in rows]
    assert sum(100 * len(sets[1][1] & s) >= 80 * len(sets[1][1] | s) for _, s in sets) < 590
    check(spark, rows)


def test_different_sets_that_share_a_number(spark):
    rng = random.Random(3)
    check(spark, texts_with_copies(rng, 200), sid_bits=4)


def test_forest_joins_what_links_join():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 63, 100, np.uint64))
    sets = [np.unique(np.concatenate([base[: 100 - k], rng.integers(0, 1 << 63, k, np.uint64)])) for k in (0, 5, 10, 15, 40)]
    every = np.ones(5, bool)
    assert len(ngram_join._forest(sets, np.arange(5), np.arange(5), every, every)) == 2  # 0 and 5, 0 and 10 alone
    assert not ngram_join._forest(sets, np.arange(5), np.zeros(5), every, every)


def test_sets_that_never_earn_enough_meet_by_elements(monkeypatch):
    monkeypatch.setattr(ngram_join, "SEEDS", 0)
    base = np.arange(100, 160, dtype=np.uint64)
    keys, owner, flags = ngram_join.keys_of([base, np.concatenate([base[6:], np.arange(6, dtype=np.uint64)])])
    assert set(keys[owner == 0]) & set(keys[owner == 1])
    assert (flags & 0xFF).min() > 0


def test_empty_and_repeated_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_components(none).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert [r.component_id for r in ngram_join.similar_components(df).collect()] == [1, 1, 1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(50, 60), (60, 55)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, 60: 50, 55: 50}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
