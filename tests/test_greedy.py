"""Greedy choices in rounds against the loops that they stand for."""

from __future__ import annotations

import difflib
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import blocks, cluster, concepts, dedup, greedy, similarity
from larkspur.plans import entity_queries


def loop_unions(edges, nodes, most=0, near=None):
    """``{(block, node): cluster}``; nodes are ``{(block, node): (family, vector)}``."""
    of = {n: {n} for n in nodes}
    for block, a, b, _ in sorted(edges, key=lambda e: (-e[3], e[1], e[2])):
        if (block, a) not in of or (block, b) not in of:
            continue
        x, y = of[block, a], of[block, b]
        both = x | y
        if x is y or (most and len(both) > most) or len({nodes[n][0] for n in both} - {None}) > 1:
            continue
        if near is not None:
            v = np.array([nodes[n][1] for n in both], float)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            centre = v.mean(axis=0)
            if (v @ centre).min() / np.linalg.norm(centre) < near:
                continue
        for n in both:
            of[n] = both
    return {n: min(s)[1] for n, s in of.items()}


@pytest.mark.parametrize(("seed", "most", "rest"), [(2, 3, 20), (3, 8, 0), (5, 4, 10_000)])
def test_unions_are_those_of_the_loop(spark, seed, most, rest):
    """Random graphs with tied scores, repeated edges, two blocks that share names, and families of which some are unknown."""
    r = random.Random(seed)
    edges = [(r.choice(["p", None]), r.randrange(60), r.randrange(60), round(r.random(), 2)) for _ in range(150)]
    edges += edges[:10] + [("p", i, i + 1, 0.5 + i / 100) for i in range(100, 106)]
    nodes = {(b, n): (r.choice([None, "f", "f", "g"]), None) for b, x, y, _ in edges for n in (x, y)}
    e = spark.createDataFrame(edges, "block string, a int, b int, score double")
    n = spark.createDataFrame([(b, i, f) for (b, i), (f, _) in nodes.items()], "block string, node int, family string")
    got = {(x.block, x.node): x.cluster for x in greedy.unions(e, n, "block", most=most, rest=rest).collect()}
    expected = loop_unions([(b or "", x, y, s) for b, x, y, s in edges], {(b or "", i): v for (b, i), v in nodes.items()}, most)
    assert {(b or "", i): c for (b, i), c in got.items()} == expected


@pytest.mark.parametrize("rest", [25, 10_000])
def test_unions_near_a_centroid(spark, rest):
    r = random.Random(rest)
    nodes = {("x", i): (r.choice([None, "f", "g"]), [r.gauss(0, 0.4) + (i % 5 == k) for k in range(5)]) for i in range(50)}
    edges = [("x", a, b, round(r.random(), 3)) for a, b in ((r.randrange(55), r.randrange(55)) for _ in range(150)) if a != b]
    e = spark.createDataFrame(edges, "block string, a int, b int, score double")
    n = spark.createDataFrame([(b, i, f, v) for (b, i), (f, v) in nodes.items()], "block string, node int, family string, vector array<double>")
    got = {(x.block, x.node): x.cluster for x in greedy.centroid_clusters(e, n, "block", most=6, least=0.75, rest=rest).collect()}
    expected = loop_unions(edges, nodes, 6, 0.75)
    assert got == expected and len(set(expected.values())) < 45


def test_unions_of_nothing(spark):
    e = spark.createDataFrame([], "block string, a int, b int, score double")
    n = spark.createDataFrame([("x", 1), ("y", 1)], "block string, node int")
    assert sorted((r.block, r.cluster) for r in greedy.unions(e, n, "block").collect()) == [("x", 1), ("y", 1)]
    assert greedy.capped(e, "block").count() == 0
    with pytest.raises(ValueError, match="bound"):
        greedy.unions(e, n, "block", near=0.5)


@pytest.mark.parametrize("rest", [0, 5])
def test_redundancy_in_rounds(spark, monkeypatch, rest):
    """Many cells, a group that holds most rows, a third of which are one vector, zero vectors, tied, null and NaN scores."""
    monkeypatch.setattr(similarity, "BLOCK", 40)
    monkeypatch.setattr(similarity, "CELL", 90)
    r = random.Random(7)
    hot = [1.0, 2.0, 3.0]
    rows = [("big" if i % 5 else None, i, r.choice([0.5, r.random(), None, float("nan")]), hot if i % 3 == 0 else [r.gauss(0, 1) for _ in range(3)]) for i in range(500)]
    rows += [("big", 1000 + i, 0.1, [0.0, 0.0, 0.0]) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, id int, score double, v array<double>")
    kept, expected = {"big": [], None: []}, []
    for k, i, _, v in sorted(rows, key=lambda x: (float("inf") if x[2] is None else float("-inf") if x[2] != x[2] else -x[2], x[1])):
        unit = np.array(v) / max(np.linalg.norm(v), 1e-12)
        if all(unit @ w < 0.97 for w in kept[k]):
            kept[k].append(unit)
            expected.append(i)
    got = similarity.without_redundant(df, ["k"], "id", "score", "v", 0.97, rest=rest)
    assert got.columns == ["k", "id", "score"] and sorted(x.id for x in got.collect()) == sorted(expected)
    assert similarity.without_redundant(df.limit(0), ["k"], "id", "score", "v").count() == 0


def test_simhashes_of_a_batch_are_those_of_each_text(monkeypatch):
    r = random.Random(2)
    texts = ["", "ab", "abc", "ää😀x"] + ["".join(r.choice("abcdé中") for _ in range(n)) for n in (4, 5, 90, 300)]
    alone = [dedup._simhashes([t])[0] for t in texts]
    monkeypatch.setattr(dedup, "GRAM_CHUNK", 50)
    assert dedup._simhashes(texts) == alone
    for t, h in zip(texts[1:], alone[1:], strict=True):
        grams = [t[i : i + 3] for i in range(len(t) - 2)] if len(t) > 3 else [t]
        hashes = [int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "big") for g in grams]
        assert h & (1 << 64) - 1 == sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in hashes) >= len(grams))


def variants(r, words, n):
    base = [r.choice(words) for _ in range(150)]
    for _ in range(n):
        changed = list(base)
        for _ in range(r.randrange(4)):
            changed[r.randrange(150)] = r.choice(words)
        yield "".join(changed)


def loop_templates(rows, threshold):
    known, out = {}, {}
    for i, block, t in sorted(rows):
        own = known.setdefault(block, [])
        h, best, at = dedup._simhashes([t])[0] & (1 << 64) - 1 if t else 0, 0, len(own)
        for c, (other, g) in enumerate(own):
            if (h ^ g).bit_count() <= dedup.TEMPLATE_BITS and any((h ^ g) >> p & 0xFF == 0 for p in range(0, 64, 8)) and (x := dedup.ratio(t, other)) >= threshold and x > best:
                best, at = x, c
        if at == len(own):
            own.append((t, h))
        out[i] = block, at
    return out


@pytest.mark.parametrize(("rest", "block"), [(0, 7), (10_000, 1024)])
def test_templates_are_those_of_the_loop(spark, monkeypatch, rest, block):
    """Drifting near copies, so that which text is a template depends on the order, copies far apart, and empty texts."""
    monkeypatch.setattr(dedup, "meet", lambda *a, **k: blocks.meet(*a, **k | {"block": block}))
    r = random.Random(3)
    words = ["负责", "平台", "架构", "设计", "开发", "python", "java", "优化", "系统", "性能"]
    texts = [t for _ in range(6) for t in variants(r, words, 12)] + ["", "", "短"]
    texts += r.sample(texts, 20)
    r.shuffle(texts)
    rows = [(i, r.choice(["a", "a", None]), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, role string, t string")
    got = {x.id: (x.role, x.template) for x in dedup.greedy_templates(df, "role", "id", F.col("t"), threshold=0.985, rest=rest).collect()}
    expected = loop_templates([(i, b or "", t) for i, b, t in rows], 0.985)
    assert {i: (b or "", t) for i, (b, t) in got.items()} == expected
    assert len({x for x in expected.values()}) > 12


def test_texts_count_whole(spark):
    """Two texts of 13,000 characters that differ in the last one are no copies, and two that differ behind 12,000 no near copies."""
    r = random.Random(11)
    long = "".join(r.choice("abcdefgh") for _ in range(13_000))
    other = long[:12_000] + "".join(r.choice("klmnopqr") for _ in range(9_000))
    df = spark.createDataFrame([(1, "r", long), (2, "r", long[:-1] + "z"), (3, "r", other), (4, "r", long)], "id int, role string, t string")
    copies = dedup.hashed_copies(df, "id", "role", F.col("t")).collect()
    assert {x.id: x.first for x in copies} == {1: 1, 2: 2, 3: 3, 4: 1}
    pairs = {(x.a, x.b): x.similarity for x in dedup.near_duplicates(df, "id", "role", F.col("t")).collect()}
    assert set(pairs) == {(1, 2), (1, 4)} and pairs[1, 4] == 1.0 > pairs[1, 2]
    found = {x.id: x.template for x in dedup.greedy_templates(df, "role", "id", F.col("t")).collect()}
    assert found == {1: 0, 2: 0, 3: 1, 4: 0}


@pytest.mark.parametrize("block", [5, 1024])
def test_no_near_duplicate_is_lost(spark, monkeypatch, block):
    """All pairs at the real rule of 0.97, copies by their first; recall is 1, as three bits leave one of four bands equal."""
    monkeypatch.setattr(dedup, "meet", lambda *a, **k: blocks.meet(*a, **k | {"block": block}))
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    texts = [t for _ in range(5) for t in variants(r, words, 9)]
    rows = [(i, "r" if i % 2 else "q", t) for i, t in enumerate([*texts, *texts[:4], *texts[:4]])]
    df = spark.createDataFrame(rows, "id int, role string, t string")
    first, expected = {}, {}
    for i, block_, t in rows:
        if (f := first.setdefault((block_, t), i)) != i:
            expected[f, i] = 1.0
    own = [(i, b, t, dedup._simhashes([t])[0] & (1 << 64) - 1) for (b, t), i in first.items()]
    for i, b, t, h in own:
        for j, c, u, g in own:
            if i < j and b == c and (s := 0.55 * (1 - (h ^ g).bit_count() / 64) + 0.45 * dedup.ratio(t, u)) >= 0.97:
                expected[i, j] = s
    got = {(x.a, x.b): x.similarity for x in dedup.near_duplicates(df, "id", "role", F.col("t")).collect()}
    assert got.keys() == expected.keys() and all(abs(got[p] - s) < 1e-12 for p, s in expected.items()) and len(expected) > 20


def test_pairs_out_of_reach_go_before_their_texts_are_fetched(spark, monkeypatch):
    """Texts of the same trigrams have close hashes whatever their lengths; only pairs that lengths and counts allow are fetched."""
    fetched, real = [], dedup.with_texts

    def counting(pairs, *args):
        fetched.append(pairs.count())
        return real(pairs, *args)

    monkeypatch.setattr(dedup, "with_texts", counting)
    # A word over and over: the same hash at any length.  The last one is like the first.
    texts = ["abcdefghij" * k for k in (20, 25, 30, 40, 50)] + ["abcdefghij" * 20 + "a"]
    df = spark.createDataFrame([(i, "r", t) for i, t in enumerate(texts)], "id int, role string, t string")
    got = {(x.a, x.b) for x in dedup.near_duplicates(df, "id", "role", F.col("t")).collect()}
    assert got == {(0, 5)} and fetched == [1]


@pytest.mark.parametrize("area", [0, 2000])
def test_ratio_of_long_texts_is_that_of_difflib(monkeypatch, area):
    """Over listed blocks: moved and repeated parts, many kinds of characters, grams that repeat too often to be listed."""
    monkeypatch.setattr(dedup, "AREA", area)
    r = random.Random(4)
    for k, alphabet in enumerate(["ab", "abcdefgh", "".join(map(chr, range(0x4E00, 0x4E00 + 400))), "a"] * 6):
        a = "".join(r.choice(alphabet) for _ in range(r.randint(300, 700)))
        b = "".join(r.choice((c,) * (8, 30, 200)[k % 3] + ("", "x")) for c in a)
        a, b = (a, b[99:] + b[:99]) if k % 5 == 0 else (a[:200] * 3, b[:210] * 3) if k % 5 == 1 else (a, b)
        expected = difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
        assert dedup.ratio(a, b) == expected
        for least in (0.5, 0.9, 0.97):
            assert dedup.ratio_from(a, b, least) in ((expected,) if expected >= least else (expected, 0.0))


def test_templates_fetch_only_texts_within_reach(spark, monkeypatch):
    """Long texts of few syllables have nearly the same characters; their trigrams tell them apart before they are fetched."""
    fetched, real = [], dedup.with_texts

    def counting(pairs, *args):
        fetched.append(pairs.count())
        return real(pairs, *args)

    monkeypatch.setattr(dedup, "with_texts", counting)
    r = random.Random(2)
    syllables = ["".join(r.choices("aeinorst", k=r.randint(2, 4))) for _ in range(300)]
    often = [1 / (i + 1) ** 0.8 for i in range(300)]
    rows = [(i, "r", "".join(r.choices(syllables, often, k=1500))) for i in range(8)]
    rows.append((99, "r", rows[0][2] + "x"))
    df = spark.createDataFrame(rows, "id int, role string, t string")
    got = {x.id: x.template for x in dedup.greedy_templates(df, "role", "id", F.col("t")).collect()}
    assert got == {i: i for i in range(8)} | {99: 0} and max(fetched) <= 1


def test_clusters_fetch_only_texts_within_reach(spark, monkeypatch):
    """The clusters of all documents: copies and near copies together, texts of equal hashes and other lengths apart and never fetched."""
    fetched, real = [], dedup.with_texts

    def counting(pairs, *args):
        fetched.append(pairs.count())
        return real(pairs, *args)

    monkeypatch.setattr(dedup, "with_texts", counting)
    texts = ["abcdefghij" * k for k in (20, 25, 30, 40, 50)] + ["abcdefghij" * 20 + "a", "ABCDEFGHIJ" * 30, None]
    df = spark.createDataFrame([(i, t, "en", "src") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(entity_queries, "docs", lambda s, d: df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("lang").alias("role")))
    got = {x.node: x.component for x in entity_queries._near_clusters(spark, "").collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 0, 6: 2, 7: 7} and fetched == [1]


def test_clusters_compare_no_pair_within_a_cluster(spark, monkeypatch):
    """Near copies that are all alike are compared with the nearest earlier one alone, not all with all; a copy and another block stay as they were."""
    fetched, real = [], dedup.with_texts

    def counting(pairs, *args):
        fetched.append(pairs.count())
        return real(pairs, *args)

    monkeypatch.setattr(dedup, "with_texts", counting)
    r = random.Random(8)
    base = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000))
    texts = [base[: 200 * i] + "z" + base[200 * i :] for i in range(12)]
    rows = [*((i, "en", t) for i, t in enumerate(texts)), (20, "en", texts[3].upper()), (21, "de", texts[0]), (22, None, texts[1]), (23, "en", "")]
    df = spark.createDataFrame(rows, "id long, role string, t string")
    got = {x.node: x.component for x in dedup.near_clusters(df, "id", "role", F.col("t")).collect()}
    assert got == {i: 0 for i in (*range(12), 20)} | {21: 21, 22: 22, 23: 23} and fetched[0] == 11 and sum(fetched) < 30


def test_unlike_texts_of_frequent_grams_are_bounded(monkeypatch):
    """Grams that repeat too often to be listed: the longest common subsequence tells such texts apart before they are matched."""
    r = random.Random(6)
    one, other = ("".join(r.choice(("the", "of", "an")) for _ in range(1200)) for _ in range(2))
    monkeypatch.setattr(dedup, "PLACES", 0)
    expected = difflib.SequenceMatcher(None, one, one[:-3] + "xyz", autojunk=False).ratio()
    assert dedup.ratio_from(one, one[:-3] + "xyz", 0.93) == expected
    monkeypatch.setattr(dedup, "_matched_between", lambda a, b: pytest.fail("matched"))
    assert dedup.ratio_from(one, other, 0.93) == 0.0


def test_edges_are_computed_once(spark):
    """Components look at the edges in both directions, and compute them once."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 9), (4, 4)], "a int, b int").mapInPandas(run, "a int, b int")
    assert {x.node: x.component for x in cluster.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 9: 7} and seen.value == 4


def test_role_scores_read_the_mentions_once(spark):
    """The counts of a role's skills are used twice, of other columns each time; the mentions behind them are gone through once."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    kind = "jd_id int, skill_id string, status string, requirement string, confidence double"
    accepted = spark.createDataFrame([(i, "s", "VERIFIED", "required", 1.0) for i in range(4)], kind).mapInPandas(run, kind)
    weighted = spark.createDataFrame([(i, i, "r", 1.0) for i in range(4)], "jd_id int, company_id int, role string, base double")
    got = concepts.role_scores(accepted, weighted).collect()
    assert [(x.role, x.skill_id, x.company_count, x.jd_count, x.verified_jd_count) for x in got] == [("r", "s", 4, 4, 4)] and seen.value == 4


def test_long_texts_of_few_syllables_are_not_fetched(spark, monkeypatch):
    """All their trigrams are alike, so that trigrams leave every pair; grams of six tell them apart, and the near copy stays."""
    fetched, real = [], dedup.with_texts

    def counting(pairs, *args):
        fetched.append(pairs.count())
        return real(pairs, *args)

    monkeypatch.setattr(dedup, "with_texts", counting)
    r = random.Random(3)
    syllables = ["".join(r.choices("aeinorst", k=r.randint(2, 4))) for _ in range(30)]
    texts = ["".join(r.choices(syllables, k=2500)) for _ in range(6)]
    alike = [dedup._common(*(dedup._trigrams(dedup._codes(t)) for t in pair)) for pair in zip(texts, texts[1:], strict=False)]
    assert min(alike) > 0.85 * max(map(len, texts)) - 4
    rows = [*((i, "r", t) for i, t in enumerate(texts)), (99, "r", texts[0] + "x")]
    df = spark.createDataFrame(rows, "id int, role string, t string")
    got = {x.id: x.template for x in dedup.greedy_templates(df, "role", "id", F.col("t")).collect()}
    assert got == {i: i for i in range(6)} | {99: 0} and max(fetched) <= 1


def test_a_text_is_dealt_once_for_many_pairs(spark):
    """A group of near copies has a pair for each two; its texts are sent once a side, not once a pair, and every pair has its ratio."""
    r = random.Random(4)
    base = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400))
    texts = [base[: 9 * i] + "z" * (i % 3) + base[9 * i :] for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "key int, t string")
    pairs = spark.createDataFrame([(i, j, 0.5 + i / 100) for i in range(30) for j in range(i)], "v int, h int, w double")
    assert dedup.with_texts(pairs, df, "v", "h").count() <= 60
    got = dedup.with_ratio(pairs, df, "v", "h", F.lit(0.97)).collect()
    assert sorted((x.v, x.h, x.w, x.ratio) for x in got) == [(i, j, 0.5 + i / 100, dedup.ratio_from(texts[i], texts[j], 0.97)) for i in range(30) for j in range(i)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnop", "一丁七万😀"])
def test_counts_bound_what_texts_have_in_common(alphabet):
    """Short and long texts, of few and of many buckets, counts that a byte can't hold: no pair within reach goes, and unlike texts do."""
    import pandas as pd

    r = random.Random(7)
    texts = ["", "a", alphabet * 150, (alphabet * 9000)[: 9000]]
    for n in (40, 300, 1000, 1030, 5000):
        t = "".join(r.choice(alphabet) for _ in range(n))
        texts += [t, t[: n // 2] + "x" + t[n // 2 :], t[: n - n // 50], "".join(r.choice(alphabet) for _ in range(n))]
    codes = [dedup._codes(t) for t in texts]
    df = pd.DataFrame({"n": list(map(len, texts)), "bag": [dedup._counts(c % dedup.BAG, dedup.BAG, "<u2") for c in codes], "grams": [dedup._gram_counts(c) for c in codes]})
    i, j = (x.ravel() for x in np.indices((len(texts), len(texts))))
    n = df["n"].to_numpy()[i] + df["n"].to_numpy()[j]
    kept = dedup._within(dedup._counted(df), dedup._counted(df), n, i, j, np.full(len(i), 0.97))
    within = {(p, q) for p, q in zip(i[kept].tolist(), j[kept].tolist(), strict=True)}
    near = {(p, q) for p, q in zip(i.tolist(), j.tolist(), strict=True) if p == q or dedup.ratio(texts[p], texts[q]) >= 0.97}
    assert near <= within and len(within) < len(i) and len(near) > len(texts) + 10


def test_refused_edges_hold_up_no_others(spark, monkeypatch):
    """A chain of which each edge waits for the one before: those between two families go at once, and so no round is needed for each."""
    rounds, real = [], greedy.written
    monkeypatch.setattr(greedy, "written", lambda df, name: (rounds.append(name), real(df, name))[1])
    edges = [("r", i, i + 1, 1 - i / 100) for i in range(24)]
    nodes = {("r", i): ("ab"[i % 2] if i % 4 < 2 else "c", None) for i in range(25)}
    e = spark.createDataFrame(edges, "block string, a long, b long, score double")
    n = spark.createDataFrame([(b, i, f) for (b, i), (f, _) in nodes.items()], "block string, node long, family string")
    got = {(x.block, x.node): x.cluster for x in greedy.unions(e, n, "block", most=3, rest=0).collect()}
    assert got == loop_unions(edges, nodes, most=3) and rounds.count("ends") <= 2


def test_capped_computes_its_edges_once(spark):
    """The ends of edges are the nodes; what is behind the edges is gone through once."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    kind = "block string, a long, b long, score double"
    edges = spark.createDataFrame([("r", 1, 2, 0.9), ("r", 2, 3, 0.8), ("r", 3, 4, 0.7)], kind).mapInPandas(run, kind)
    assert {x.node: x.cluster for x in greedy.capped(edges, "block", most=2).collect()} == {1: 1, 2: 1, 3: 3, 4: 3} and seen.value == 3


def test_few_products_of_a_search_are_ordered(monkeypatch):
    """The best of each query are those of a full order, with ties, zero and opposite vectors; only what can be among them is rounded and ordered."""
    sorts, lexsort = [], np.lexsort
    monkeypatch.setattr(similarity.np, "lexsort", lambda keys: (sorts.append(len(keys[0])), lexsort(keys))[1])
    monkeypatch.setattr(similarity, "ROWS", 300)
    r = np.random.default_rng(3)
    for few in (False, True):
        b = r.normal(size=(3000, 16))
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        b[10:40] = b[5]
        if few:
            b[100:] = 0
            b[50:100] = -b[5]
        other, mine = np.arange(3000) * 2, np.arange(100) * 2
        at, to, found = similarity._best(b[:100], b, mine, other, 7)
        s = np.round(np.clip(b[:100] @ b.T, 0, 1), 9)
        s[mine[:, None] == other[None]] = -1
        best = np.argsort(-s, axis=1, kind="stable")[:, :7]
        assert np.array_equal(to.reshape(100, 7), best) and np.array_equal(found.reshape(100, 7), np.take_along_axis(s, best, 1)) and np.array_equal(at, np.repeat(np.arange(100), 7))
        if not few:
            assert sum(sorts) < s.size / 10

