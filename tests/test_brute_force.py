"""Queries that SQL cannot express against plain Python over the same rows."""

from __future__ import annotations

import difflib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import consolidation, discovery, greedy, review
from larkspur.plans import catalog, entity_queries, evolution_queries, text_queries
from larkspur.sources import ingest
from tests.test_greedy import loop_unions


def rows_of(spark, sf, name):
    return catalog.QUERIES[name](spark, sf).collect()


@pytest.fixture(scope="module")
def documents(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    return {r.vec_id: (r.label, np.array(r.embedding, float) / np.linalg.norm(r.embedding)) for r in rows}


def normal(text):
    return re.sub("[^0-9a-z一-鿿+#.]", "", (text or "").lower())


def smallest(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def test_near_duplicates_and_clusters(spark, sf, documents):
    """A pair found is as alike as it says, equal texts are always found, and every document has its cluster."""
    found = {(r.a, r.b) for r in rows_of(spark, sf, "near_duplicates")}
    for a, b in found:
        x, y = (normal(documents[i].text) for i in (a, b))
        assert documents[a].lang == documents[b].lang and (x == y or difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() >= 0.7)
    first = {}
    for i in sorted(documents):
        first.setdefault((documents[i].lang, normal(documents[i].text)), i)
    clusters = {r.node: r.component for r in rows_of(spark, sf, "near_dup_clusters")}
    assert clusters == smallest(documents, found)
    assert all(clusters[i] == clusters[first[documents[i].lang, normal(documents[i].text)]] for i in documents if normal(documents[i].text))


def test_title_clusters(spark, sf):
    parts = {f"{r.p_name} {r.p_type}" for r in spark.read.parquet(f"{sf}/part.parquet").collect()}
    links = [(a, b) for a in parts for b in parts if a < b and difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.92]
    expected = {n: c for n, c in smallest(parts, links).items() if n != c}
    got = {r.node: r.component for r in rows_of(spark, sf, "title_clusters")}
    assert {n: c for n, c in got.items() if n != c} == expected


def test_similar_titles(spark, sf):
    """All pairs of a brand's titles."""
    titles = defaultdict(set)
    for r in spark.read.parquet(f"{sf}/part.parquet").collect():
        titles[r.p_brand].add(f"{r.p_name} {r.p_type} {r.p_partkey % 97:02d}")
    like = lambda a, b: difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
    expected = {(k, a, b): round(x, 6) for k, own in titles.items() for a in own for b in own if a < b and (x := like(a, b)) >= 0.9}
    assert {(r.brand, r.a, r.b): r.ratio for r in rows_of(spark, sf, "similar_titles")} == expected and expected


def test_selection_by_relevance_and_novelty(spark, sf, vectors):
    got = defaultdict(dict)
    for r in rows_of(spark, sf, "mmr_select"):
        got[r.label][r.mmr_rank] = r.vec_id
    by = defaultdict(list)
    for i, (label, _) in vectors.items():
        by[label].append((-(i * 37 % 1000 / 1000), i))
    for label, items in by.items():
        best = sorted(items)[:30]
        chosen = []
        while len(chosen) < min(5, len(best)):
            gain = [(round(0.75 * -s - 0.25 * max((float(vectors[i][1] @ vectors[j][1]) for j in chosen), default=0), 9), k) for k, (s, i) in enumerate(best) if i not in chosen]
            chosen.append(best[max(gain, key=lambda g: (g[0], -g[1]))[1]][1])
        assert [got[label][k] for k in sorted(got[label])] == chosen


def test_recall_of_cells(spark, sf, vectors):
    """Against all pairs, at the query's parameters and with cells so large that they fall into blocks."""
    from larkspur.operators import similarity

    ids = sorted(vectors)
    v = np.stack([vectors[i][1] for i in ids])
    like = np.round(np.clip(v @ v.T, 0, 1), 9)
    np.fill_diagonal(like, -1)
    expected = {(ids[i], ids[j]) for i, row in enumerate(like) for j in np.argsort(-row, kind="stable")[:10]}
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    for got in (rows_of(spark, sf, "ann_topk"), similarity.nearest_by_cells(e, e, "vec_id", "embedding", 10, cells=16, probes=12).collect()):
        assert len({(r.query, r.neighbour) for r in got} & expected) >= 0.9 * len(expected)
        assert all(abs(r.similarity - like[ids.index(r.query), ids.index(r.neighbour)]) < 1e-5 for r in got[:500])
    copies = e.where("vec_id < 3").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(1500)))).select((F.col("vec_id") * 10_000 + F.col("n")).alias("vec_id"), "embedding")
    got = similarity.nearest_by_cells(copies.where("vec_id % 1000 = 7"), copies, "vec_id", "embedding", 3, cells=2, probes=2).collect()
    assert len(got) == 6 * 3 and all(r.similarity > 0.999999 for r in got)
    assert similarity.nearest_by_cells(e.limit(0), e, "vec_id", "embedding", 3).count() == 0 == similarity.nearest_by_cells(e, e.limit(0), "vec_id", "embedding", 3).count()


def test_redundancy(spark, sf, vectors):
    got = {r.vec_id for r in rows_of(spark, sf, "redundancy_filter")}
    kept = defaultdict(list)
    for i in sorted(vectors, key=lambda i: (-(i * 37 % 1000 / 1000), i)):
        label, v = vectors[i]
        if all(float(v @ vectors[j][1]) < 0.9 for j in kept[label]):
            kept[label].append(i)
    assert got == {i for k in kept.values() for i in k}


def test_capped_clusters(spark, sf):
    """By unions in order of falling similarity, at most eight in a cluster."""
    rows = entity_queries._rounded_knn(entity_queries.neighbours(spark, sf, 5)).where("query < neighbour").collect()
    label = {r.vec_id: r.label for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    members = defaultdict(dict)
    for r in sorted(rows, key=lambda r: (-r.similarity, r.query, r.neighbour)):
        own = members[label[r.query]]
        a, b = own.setdefault(r.query, {r.query}), own.setdefault(r.neighbour, {r.neighbour})
        if a is not b and len(a) + len(b) <= 8:
            a |= b
            for i in b:
                own[i] = a
    got = {(r.block, r.node): r.cluster for r in rows_of(spark, sf, "capped_clusters")}
    assert got == {(block, i): min(s) for block, own in members.items() for i, s in own.items()}


def test_centroid_cluster_query(spark, sf):
    edges, nodes = (x.collect() for x in entity_queries.centroid_parts(spark, sf))
    expected = loop_unions([tuple(r) for r in edges], {(r.block, r.node): (r.family, r.vector) for r in nodes}, 60, 0.6)
    got = {(r.block, r.node): r.cluster for r in rows_of(spark, sf, "centroid_clusters")}
    assert got == expected and len(set(expected.values())) < len(expected)


def test_skill_changes(spark, sf):
    """p-values of the test that fits, corrected by role; the decision by effect and q-value."""
    effects = {(r.role, r.skill_id): r for r in evolution_queries.effects(spark, sf).collect()}
    changes = rows_of(spark, sf, "skill_changes")
    assert changes and {(r.role, r.skill_id) for r in changes} <= set(effects)
    c = evolution_queries.LOOSE
    for r in changes:
        e = effects[r.role, r.skill_id]
        n = e.n1 + e.n2
        least = min((e.x1 + e.x2) * m / n for m in (e.n1, e.n2)), min((n - e.x1 - e.x2) * m / n for m in (e.n1, e.n2))
        if min(least) < 5 and n <= 200:
            k = e.x1 + e.x2
            ways = lambda x: math.comb(e.n1, x) * math.comb(e.n2, k - x)
            p = sum(ways(x) for x in range(max(0, k - e.n2), min(k, e.n1) + 1) if ways(x) <= ways(e.x1) * (1 + 1e-7)) / math.comb(n, k)
        else:
            p = math.erfc(abs(e.z) / math.sqrt(2)) if e.z is not None else 1.0
        p = p if abs(e.delta) >= c.delta else 1.0
        assert abs(r.p_value - p) < 1e-6 or r.p_value == 1.0, (r, p)
    order = defaultdict(list)
    for r in changes:
        order[r.role].append(r.p_value)
    assert all(0 <= r.q_value <= 1 and r.q_value >= r.p_value - 1e-9 for r in changes)
    assert len(rows_of(spark, sf, "review_budget")) <= len(changes)


def test_extraction(spark, sf, documents):
    got = defaultdict(dict)
    for r in rows_of(spark, sf, "rule_extraction"):
        got[r.doc_id][r.skill_id] = r
    for i, d in documents.items():
        for s in text_queries.SKILLS:
            hits = [m for a in s.aliases for m in re.finditer(rf"(?<![A-Za-z0-9+#]){re.escape(a)}(?![A-Za-z0-9+#])", d.text or "", re.I)]
            assert bool(hits) == (s.skill_id in got[i])
            if hits:
                assert got[i][s.skill_id].evidence_quote in d.text and got[i][s.skill_id].raw_term in d.text
    best = {(r.doc_id, r.skill_id): r.status for r in rows_of(spark, sf, "verified_evidence")}
    assert set(best) == {(i, k) for i, x in got.items() for k in x} and set(best.values()) <= {"VERIFIED"}
    found = {r.status: r.n for r in rows_of(spark, sf, "processing_status")}
    empty = sum(not (d.text or "").strip(" ") for d in documents.values())
    assert found.get("COMPLETED", 0) == len({i for i, _ in best}) and found.get("FAILED", 0) == empty and sum(found.values()) == len(documents)


def test_nearest_names_and_titles(spark, sf):
    parts = spark.read.parquet(f"{sf}/part.parquet").collect()
    names = sorted({r.p_name for r in parts})

    def like(x, y):
        x, y = normal(x), normal(y)
        inside = min(len(x), len(y)) / max(len(x), len(y)) if x in y or y in x else 0
        return 1.0 if x == y else max(inside, difflib.SequenceMatcher(None, x, y, autojunk=False).ratio())

    got = defaultdict(dict)
    for r in rows_of(spark, sf, "nearest_skills"):
        got[r.skill][r.rank] = (r.other, r.similarity)
    for a in names:
        expected = sorted(((-like(a, b), b) for b in names if b != a))[:5]
        assert [(o, round(s, 9)) for o, s in (got[a][k] for k in sorted(got[a]))] == [(b, round(-s, 9)) for s, b in expected]
    relevance = {r.p_partkey: r.relevance for r in rows_of(spark, sf, "title_relevance")}
    for r in parts:
        t, role = r.p_name, r.p_type
        x, y = set(t), set(role)
        s = 1.0 if t == role else min(1.0, 0.45 * difflib.SequenceMatcher(None, role, t, autojunk=False).ratio() + 0.75 * (role in t) + 0.2 * len(x & y) / len(x | y))
        assert abs(relevance[r.p_partkey] - s) < 1e-6


def test_nearest_roles(spark, sf):
    """Against all pairs of the same skill vectors."""
    from larkspur.operators import evolution as E

    r, k = evolution_queries.records(spark, sf), evolution_queries.jd_skills(spark, sf)
    vector = defaultdict(dict)
    for x in E.role_vectors(r.withColumn("role", F.col("industry")), k, "current").collect():
        vector["c", x.role][x.skill_id] = x.weight
    for x in E.role_vectors(r, k, "baseline").collect():
        vector["r", x.role][x.skill_id] = x.weight

    def title(a, b):
        x, y = normal(a), normal(b)
        inside = min(len(x), len(y)) / max(len(x), len(y)) if x in y or y in x else 0
        return 1.0 if x == y else max(inside, difflib.SequenceMatcher(None, x, y, autojunk=False).ratio())

    def like(c, o):
        x, y = vector["c", c], vector["r", o]
        common = sum(min(x.get(s, 0), y.get(s, 0)) for s in x)
        return 0.6 * common / sum(max(x.get(s, 0), y.get(s, 0)) for s in x.keys() | y.keys()) + 0.4 * title(c, o)

    got = defaultdict(dict)
    for x in rows_of(spark, sf, "nearest_roles"):
        got[x.candidate][x.rank] = round(x.similarity, 7)
    roles = [o for side, o in vector if side == "r"]
    for c in (o for side, o in vector if side == "c"):
        assert [got[c][n] for n in sorted(got[c])] == [round(s, 7) for s in sorted((like(c, o) for o in roles), reverse=True)[:3]]


def test_templates(spark, sf, documents):
    """Every document once, equal texts of a language in one template, members like their template's first."""
    got = rows_of(spark, sf, "greedy_templates")
    assert sorted(r.doc_id for r in got) == sorted(documents)
    lowest = {}
    for r in sorted(got, key=lambda r: r.doc_id):
        lowest.setdefault((documents[r.doc_id].lang, r.template), r.doc_id)
    of = {r.doc_id: lowest[documents[r.doc_id].lang, r.template] for r in got}
    first = {}
    for i in sorted(documents):
        key = (documents[i].lang, normal(documents[i].text))
        assert of[i] == of[first.setdefault(key, i)]
    for i, t in of.items():
        x, y = normal(documents[i].text), normal(documents[t].text)
        assert i == t or x == y or difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() >= 0.97


def test_synonyms_across_categories(spark):
    rows = [("r", "a", 1, "Python编程能力", 0.9, [1.0, 0.0]), ("r", "b", 2, "编程python能力", 0.8, [0.0, 1.0]), ("r", "b", 3, "python编程能力 ", 0.7, [0.5, 0.5]), ("r", "a", 4, "java web", 0.6, [0.0, 1.0]), ("r", "b", 5, "java server", 0.5, [0.01, 1.0]), ("r", "b", 6, "绘画", 0.4, [0.0, 1.0]), ("q", "a", 7, "绘画", 0.1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "role string, category string, item int, name string, score double, v array<double>")
    got = {r.item: r.category_rank for r in consolidation.without_synonyms(df, "role", "category", "item", "name", "score", "v").collect()}
    assert got == {1: 1, 4: 2, 6: 1, 7: 1}


def test_centroid_clusters(spark):
    v = {1: [1.0, 0.0], 2: [0.95, 0.1], 3: [0.9, 0.3], 4: [0.0, 1.0], 5: [0.1, 1.0]}
    nodes = spark.createDataFrame([("x", i, "f" if i == 5 else None if i != 4 else "g", v[i]) for i in v], "block string, node int, family string, vector array<double>")
    edges = spark.createDataFrame([("x", 1, 2, 0.99), ("x", 2, 3, 0.95), ("x", 3, 4, 0.9), ("x", 4, 5, 0.98)], "block string, a int, b int, score double")
    got = {r.node: r.cluster for r in greedy.centroid_clusters(edges, nodes, "block").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}  # 3 and 4 are far from a common centroid, 4 and 5 of two families
    assert {r.node: r.cluster for r in greedy.centroid_clusters(edges, nodes, "block", most=2).collect()}[3] == 3


def test_blocked_pairs(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "bc"), (3, "xy"), (4, "ab")], "k int, t string")
    pairs = consolidation.blocked_pairs(df, "k", F.split("t", ""), lambda p: p.where("b - a < 3"))
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (2, 4)]


def test_reviewer_is_called_once_and_within_budget(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def model(packet: str) -> str:
        with open(calls, "a") as f:
            f.write(f"{packet}\n")
        return f"<{packet}>"

    packets = spark.createDataFrame([("k1", 1, "a"), ("k1", 2, "a"), ("k2", 3, "b"), ("k3", 4, "c"), ("k4", 0, "d")], "key string, priority int, packet string")
    cache = spark.createDataFrame([("k4", "old")], "key string, answer string")
    got = sorted((r.key, r.answer, r.source) for r in review.reviewed(packets, cache, model, 2).collect())
    assert got == [("k1", "<a>", "REVIEWER"), ("k1", "<a>", "REVIEWER"), ("k2", "<b>", "REVIEWER"), ("k3", None, "PENDING"), ("k4", "old", "CACHE")]
    assert set(open(calls).read().split()) == {"a", "b"}
    assert {r.source for r in review.reviewed(packets, cache, None, 9).collect()} == {"CACHE", "PENDING"}


def test_titles_that_are_known(spark):
    stats = spark.createDataFrame([("java测试", "x"), ("测试", "x"), ("qa", "测试工程师"), ("sre", "zzz"), ("助理", "x"), ("新", "x")], "title string, dominant_role string")
    known = spark.createDataFrame([("测试",)], "title string")
    aliases = spark.createDataFrame([("qa", "测试工程"), ("sre", "运维")], "title string, alias string")
    assert sorted(r.title for r in discovery.unknown_titles(stats, known, aliases, ("助理",)).collect()) == ["sre", "新"]


def test_encodings():
    assert ingest.encoding_of("é".encode("utf-8-sig")) == "utf-8" and ingest.encoding_of("测".encode("utf-16")) == "utf-16"
    assert ingest.encoding_of("测试".encode("gb18030")) == "gb18030" and ingest.encoding_of("测试".encode()[:-1]) == "utf-8"


def test_new_titles_and_their_gates(spark):
    columns = "title string, historical_jds long, baseline_jds long, current_jds long, current_companies long, current_templates long, current_sources long"
    stats = spark.createDataFrame([("old", 1, 0, 9, 9, 9, 9), ("rare", 0, 0, 1, 1, 1, 1), ("fresh", 0, 0, 3, 2, 2, 1), ("sure", 0, 0, 5, 4, 4, 3)], columns)
    runs = spark.createDataFrame([("fresh", 1, 1), ("sure", 3, 2)], "title string, continuous_windows long, growth_windows long")
    got = {r.title: (r.failed, r.passed) for r in discovery.candidates(stats, runs).collect()}
    assert got == {"fresh": (["continuous", "growth", "sources"], False), "sure": ([], True)}


def test_clusters_have_their_best_member_as_concept(spark):
    groups = spark.createDataFrame([(1, 5), (2, 9), (3, 1), (4, 7)], "g int, jds int")
    edges = spark.createDataFrame([(1, 2), (2, 3)], "a int, b int")
    got = {r.g: r.concept for r in consolidation.clusters(groups, edges, "g", [-F.col("jds")]).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 4}
