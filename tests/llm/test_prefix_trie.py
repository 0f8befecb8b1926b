"""Prefix trie against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from larkspur.llm import prefix_trie, registry


def turn_key(turn, role, text):
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, digest[:16], len(text.encode()))


def brute(rows, every, most):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: turn_key(*t))] for c, ts in own.items()}
    built = own
    if every:
        built = {}
        for c, ts in own.items():
            h = zlib.crc32(str(c).encode()) % most
            start = c - (abs(c) % every) * (1 if c > 0 else -1)
            built[c] = own.get(start, [])[:h] + ts[h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].add(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children[p]
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[x] for x in below)
    joined = {p: ",".join(map(str, sorted(ends[p]))) for p in members}
    return order((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(joined[p].encode()).hexdigest()) for p, m in members.items())


def plain(df):
    return order(tuple(r[c] for c in prefix_trie.RESULT) for r in df.collect())


def order(rows):
    return sorted(rows, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", b"y") for r in rows], "conv_id long, turn int, role string, text string, path string, Entry binary")


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_is_brute_force(spark, name):
    d = f"/root/testdata/{name}"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{d}/conversations.parquet").collect()]
    expected = order(brute(rows, 5, 9))
    assert plain(registry.op11_prefix_trie(spark, d)) == expected
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    found = duckdb.sql(registry.ORACLE_SQL["op11_prefix_trie"])
    assert order(tuple(r) for r in found.select(*prefix_trie.RESULT).fetchall()) == expected


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_hot_prefixes_and_odd_rows(spark, shards):
    """A third of all conversations are the same; ids are negative, turns null, tied or missing."""
    r = random.Random(shards)
    words = ["a", "b", "ä ", "", None]
    rows = [(c, t, "user", f"hot {t}") for c in range(100, 160) for t in range(3)]
    for c in range(-60, 60):
        rows += [(c, r.choice([None, 1, 2, 2, 3]), r.choice(["user", None, ""]), r.choice(words)) for _ in range(r.randint(1, 6))]
    rows += [(None, 1, "user", "no id"), (7, 1, "user", "again"), (7, 1, "user", "again")]
    for every, most in ((None, 1), (5, 9)):
        assert plain(prefix_trie.prefix_trie(table(spark, rows), every=every, most=most, shards=shards)) == order(brute(rows, every, most))


def test_long_conversation_and_short_splitters(spark, monkeypatch):
    rows = [(c, t, "user", str(t if c < 8 or t < 150 else c)) for c in range(12) for t in range(300)]
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 20 * 40 * 10 * 3)  # splitters of three turns
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 2)
    assert plain(prefix_trie.prefix_trie(table(spark, rows), shards=40)) == order(brute(rows, None, 1))


def test_empty(spark):
    assert prefix_trie.prefix_trie(table(spark, []), every=5, most=9).count() == 0
    assert prefix_trie.prefix_trie(table(spark, [(None, 1, "user", "x")])).count() == 0


def test_turnless_conversation_is_in_the_root(spark):
    """Conversation 8 has fewer turns than it gives up, and there is no conversation 5 to take them from."""
    assert zlib.crc32(b"8") % 9 == 5
    rows = [(8, 1, "user", "x")]
    assert plain(prefix_trie.prefix_trie(table(spark, rows), every=5, most=9)) == brute(rows, 5, 9)
    assert brute(rows, 5, 9) == [(8, 0, None, 1, 0, 1, 0, hashlib.sha256(b"8").hexdigest())]
