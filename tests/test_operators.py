from __future__ import annotations

import difflib
import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from larkspur.functions import stats, text, titles
from larkspur.operators import cluster, concepts, consolidation, dedup, domain, evidence, greedy, matching, review, serve, similarity, versions
from larkspur.plans import catalog
from larkspur.sources import ingest, sinks
from larkspur.streaming import streams


def test_thresholds():
    """Role sizes with known bounds."""
    assert concepts.thresholds(50, 40, False) == (4, 4) and concepts.thresholds(50, 40, True) == (10, 8)
    assert concepts.thresholds(2688, 1405, False) == (8, 5) and concepts.thresholds(2688, 1405, True) == (15, 8)
    assert concepts.thresholds(31328, 11348, False) == (32, 12) and concepts.thresholds(31328, 11348, True) == (157, 57)


def test_first_seen_and_two_pass(spark):
    df = spark.createDataFrame([(1, "a", "x" * 40), (2, "a", "x" * 40), (3, "b", "x" * 40), (4, "c", None), (5, "c", None)], "id int, k string, t string")
    got = {r.id: r.duplicate_of for r in dedup.first_seen(df, [F.col("k"), F.col("t")], ["id"]).collect()}
    assert got == {1: None, 2: 1, 3: None, 4: None, 5: 4}
    two = {r.id: (r.duplicate_of, r.duplicate_reason) for r in dedup.two_pass(df, [F.col("k"), F.col("t")], [F.col("t")], F.coalesce(F.length("t"), F.lit(0)) >= 30, ["id"]).collect()}
    assert two[2] == (1, "EXACT_DUPLICATE") and two[3] == (1, "EXACT_EXTRACTED_ENTRY_DUPLICATE") and two[4] == (None, None)


def test_components_any_order(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (200, 205), (205, 207)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in cluster.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 200: 200, 205: 200, 207: 200}


def test_capped_union(spark):
    e = spark.createDataFrame([(1, 1, 2, 0.9), (1, 2, 3, 0.8), (1, 3, 4, 0.7)], "block int, a int, b int, score double")
    got = {r.node: r.cluster for r in greedy.capped(e, "block", most=2).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}


def test_near_duplicates(spark):
    base = "负责平台架构设计与开发工作并持续优化系统性能与稳定性" * 6
    df = spark.createDataFrame([(1, "r", base), (2, "r", base + "加"), (3, "r", "完全不同的另一段文字描述内容" * 9), (4, "q", base)], "id int, role string, t string")
    assert [(r.a, r.b) for r in dedup.near_duplicates(df, "id", "role", F.col("t"), threshold=0.9).collect()] == [(1, 2)]
    t = {r.id: r.template for r in dedup.greedy_templates(df, "role", "id", F.col("t"), threshold=0.9).collect()}
    assert t[1] == t[2] != t[3]


def test_near_duplicates_keep_copies_and_equal_hashes(spark):
    """All copies are in pairs, and so are different texts whose simhashes are equal; texts that differ late are not copies."""
    a = "abcdefghij" * 30
    b = a + "abcdefghij"  # the same trigrams, nearly as often: the same hash
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh") for _ in range(12000))
    late = long[:10500] + "ijkl" * 375
    rows = [(1, "r", a), (2, "r", a.upper()), (3, "r", b), (4, "r", b), (5, "q", a), (6, "r", ""), (7, "r", ""), (8, "s", long), (9, "s", late)]
    df = spark.createDataFrame(rows, "id int, role string, t string")
    assert _plain_simhash(a) == _plain_simhash(b) and (_plain_simhash(long) ^ _plain_simhash(late)).bit_count() > 3
    assert sorted((r.a, r.b) for r in dedup.near_duplicates(df, "id", "role", F.col("t")).collect()) == [(1, 2), (1, 3), (3, 4)]
    assert sorted((r.a, r.b) for r in dedup.close_hashes(df, "id", "role", F.col("t")).select("a", "b").collect()) == [(1, 2), (1, 3), (3, 4)]


def test_near_dup_clusters_hold_every_document(spark, sf):
    got = {r.node: r.component for r in catalog.QUERIES["near_dup_clusters"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", text.normalize_text(F.col("text")).alias("t")).orderBy("doc_id").collect()
    first = {}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id] == got[first.setdefault((r.lang, r.t or r.doc_id), r.doc_id)] <= r.doc_id


def _plain_simhash(t):
    grams = [t[i : i + 3] for i in range(len(t) - 2)] if len(t) > 3 else [t]
    hashes = [int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "big") for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) >= len(grams))


def test_greedy_templates_of_all_documents(spark, sf):
    """Every document has a template, the long ones too; in the smaller blocks it is compared with a plain loop's."""
    got = {r.doc_id: (r.role, r.template) for r in catalog.QUERIES["greedy_templates"](spark, sf).collect()}
    heads, expected = {}, {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("role"), text.normalize_text(F.col("text")).alias("t")).where("lang != 'en'").orderBy("doc_id").collect():
        t, known = r.t, heads.setdefault(r.role, [])
        h, best, at = _plain_simhash(t) if t else 0, 0, len(known)
        for c, (other, g) in enumerate(known):
            if (h ^ g).bit_count() <= 14 and any((h ^ g) >> p & 0xFF == 0 for p in range(0, 64, 8)):
                m = difflib.SequenceMatcher(None, t, other, autojunk=False)
                if m.real_quick_ratio() >= 0.97 and m.quick_ratio() >= 0.97 and (x := 1.0 if t == other else m.ratio()) >= 0.97 and x > best:
                    best, at = x, c
        if at == len(known):
            known.append((t, h))
        expected[r.doc_id] = r.role, at
    assert len(got) == 200 and {k: v for k, v in got.items() if v[0] != "en"} == expected


def test_ratio_is_that_of_difflib():
    rng = random.Random(3)
    for k in range(200):
        a = "".join(rng.choice("abc" if k % 2 else "abcdefghijkl") for _ in range(rng.randint(0, 120)))
        b = "".join(rng.choice((c, c, c, c, c, c, "", "x")) for c in a)
        expected = difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
        assert dedup.ratio(a, b) == expected
        for least in (0.5, 0.8, 0.97):
            assert dedup.ratio_from(a, b, least) in ((expected,) if expected >= least else (0.0, expected))


def test_simhash_native_is_set_by_ties(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, "")], "id int, t string")
    got = {r.id: r.simhash for r in dedup.simhash_native(df, "id", F.col("t")).collect()}
    assert got[1] == got[2] and 3 not in got


def test_top_k_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.random() for _ in range(5)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    got = {(r.query, r["rank"]): r.neighbour for r in similarity.top_k(df, df, "id", "v", 3).collect()}

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    for i, v in rows:
        best = sorted(((-round(cos(v, w), 9), j) for j, w in rows if j != i))[:3]
        assert [got[i, k + 1] for k in range(3)] == [j for _, j in best]


def test_mmr_prefers_the_different(spark):
    df = spark.createDataFrame([("r", "a", 0.9, [1.0, 0.0]), ("r", "b", 0.89, [0.99, 0.01]), ("r", "c", 0.8, [0.0, 1.0])], "role string, item string, score double, v array<double>")
    got = [r.item for r in similarity.mmr(df, ["role"], "item", "score", "v", 2).orderBy("mmr_rank").collect()]
    assert got == ["a", "c"]


def test_without_redundant_decides_every_row(spark):
    """A group of more rows than a block, in which redundant rows have kept ones far ahead of them."""
    rng = random.Random(4)
    rows = [("big" if i % 4 else "small", i, rng.random(), [rng.gauss(0, 1) for _ in range(3)]) for i in range(1800)]
    df = spark.createDataFrame(rows, "k string, id int, score double, v array<double>")
    kept = {"big": [], "small": []}
    expected = set()
    for k, i, _, v in sorted(rows, key=lambda r: (-r[2], r[1])):
        unit = [x / sum(y * y for y in v) ** 0.5 for x in v]
        if all(sum(x * y for x, y in zip(unit, w)) < 0.9995 for w in kept[k]):
            kept[k].append(unit)
            expected.add(i)
    got = [r.id for r in similarity.without_redundant(df, ["k"], "id", "score", "v", 0.9995).collect()]
    assert sorted(got) == sorted(expected) and len(kept["big"]) > 200


def test_stream_counts_hold_open_and_late_windows(spark, tmp_path):
    """Files in an order that makes rows late, and a last window that no watermark closes."""
    for name, day in (("a", "2024-03-01"), ("b", "2024-01-01"), ("c", "2024-03-02")):
        spark.createDataFrame([(f"{day} 10:00:00", "x", 1.0)] * 3, "ts string, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / "in" / name))
    rows = streams.file_stream(spark, str(tmp_path / "in" / "*"), files_per_trigger=1)
    streams.write_complete(streams.month_counts(rows, "event_type"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    last = max(int(p.name[1:]) for p in (tmp_path / "out").iterdir() if p.name.startswith("v"))
    assert {r.day: r.n for r in spark.read.parquet(str(tmp_path / "out" / f"v{last}")).collect()} == {"2024-01-01": 3, "2024-03-01": 3, "2024-03-02": 3}


def test_domain(spark):
    rows = [(1, "Java开发工程师", "负责微服务接口开发", "计算机软件"), (2, "保险顾问", "负责保险销售业绩", "保险"), (3, "店员", "负责食品销售", "食品"), (4, "助理", "协助日常工作", "")]
    df = domain.admitted(domain.structured(spark.createDataFrame(rows, "id int, title string, description string, industry string"), domain.TECHNOLOGY), domain.TECHNOLOGY)
    got = {r.id: r.label for r in df.collect()}
    assert got[1] == "IT" and got[2] == got[3] == "NON_IT" and got[4] != "IT"


def test_evidence(spark):
    skills = (evidence.Skill("go", ("Go", "Golang")), evidence.Skill("java", ("Java",)))
    docs = spark.createDataFrame([(1, "熟悉Golang。有Java经验者优先。"), (2, "MongoDB 和 JavaScript"), (3, None)], "doc_id int, text string")
    got = {(r.doc_id, r.skill_id): r for r in evidence.extract(docs, skills).collect()}
    assert set(got) == {(1, "go"), (1, "java")}
    assert got[1, "java"].requirement == "preferred" and got[1, "go"].evidence_quote == "熟悉Golang"
    made_up = spark.createDataFrame([(1, "go", "x", "", "required", "不存在的句子", 0.9), (1, "go", "x", "", "required", "熟悉 GOLANG", 0.9), (1, "", "x", "", "required", "熟悉Golang", 0.9)], "doc_id int, skill_id string, raw_term string, category string, requirement string, evidence_quote string, confidence double")
    assert sorted(r.status for r in evidence.verified(made_up, docs).collect()) == ["LOW_CONFIDENCE", "REJECTED_HALLUCINATION", "REJECTED_UNKNOWN_SKILL"]


def test_ability_terms(spark):
    df = spark.createDataFrame([(1, json.dumps({"知识": ["a", " b ", "a"], "技术": ["c"]})), (2, json.dumps({"技术": "x、y;x"})), (3, "no json"), (4, None)], "id int, j string")
    got = sorted((r.id, r.category, r.term) for r in evidence.ability_terms(df, "id", "j").collect())
    assert got == [(1, "技术", "c"), (1, "知识", "a"), (1, "知识", "b"), (2, "技术", "x"), (2, "技术", "y")]


def test_versions(spark):
    df = spark.createDataFrame([("u", 10, 1, "a"), ("u", 20, 2, "b"), ("u", 15, 3, "c"), ("u", 20, 4, "d")], "k string, observed_epoch long, seq long, v string")
    assert versions.current(df, "k").first().v == "d"
    assert [r.v for r in versions.late(df, "k").collect()] == ["c"]
    assert versions.distinct_versions(df, "k", ["v"]).count() == 4


def test_snapshot_store(spark, tmp_path):
    store = versions.SnapshotStore(spark, str(tmp_path / "s"))
    a, b = spark.range(3), spark.range(5)
    one = store.publish({"t": a})
    assert store.publish({"t": a}) == one and store.read("t").count() == 3
    store.publish({"t": b})
    assert store.read("t").count() == 5
    assert store.rollback() == one and store.read("t").count() == 3
    with pytest.raises(RuntimeError):
        store.rollback()
    seen = store.status()["version"]
    store.publish({"t": b}, seen)
    with pytest.raises(RuntimeError):
        store.publish({"t": a}, seen)  # the pointer has moved since
    store.deactivate()
    with pytest.raises(RuntimeError):
        store.read("t")
    assert versions.fingerprint(a) == versions.fingerprint(spark.range(3).orderBy(F.desc("id"))) != versions.fingerprint(b)


def test_ingest(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("职位ID,职位名称,公司全称,发布日期,别的\n1,测试工程师,甲,2025-05-01,值\n".encode("gb18030"))
    (tmp_path / "b.json").write_text(json.dumps({"data": [{"job_id": "2", "job_name": "Dev", "company": "B"}, {"job_id": "3", "job_name": "N/A", "jd": ""}]}))
    found = {r.path.rsplit("/", 1)[1]: r.encoding for r in ingest.discover(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": "gb18030", "b.json": "utf-8"}
    a = ingest.canonical(ingest.read_csv(spark, [str(tmp_path / "a.csv")], "gb18030")).first()
    assert (a.job_id, a.title, a.company, a.posted_at, json.loads(a.extra_json)) == ("1", "测试工程师", "甲", "2025-05-01", {"别的": "值"})
    b = ingest.usable(ingest.canonical(ingest.read_json(spark, [str(tmp_path / "b.json")])))
    assert [r.job_id for r in b.collect()] == ["2"]
    ids = ingest.with_identity(b).first()
    assert len(ids.raw_uid) == 40 and ids.version_id.startswith(ids.raw_uid) and ids.observed_epoch is not None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "role string, n int")
    sinks.write_reports(df, "role", str(tmp_path / "r"))
    assert (tmp_path / "r" / "role=a").is_dir()
    sinks.write_graph({"Role": df}, {}, str(tmp_path / "g"))
    known = sinks.package(str(tmp_path / "g"), str(tmp_path / "p.zip"))
    assert known and sinks.verify_package(str(tmp_path / "p.zip"))
    with pytest.raises(ValueError):
        sinks.package(str(tmp_path / "g"), str(tmp_path / "q.zip"), forbidden=("n",))
    assert "| a | 1 |" in sinks.markdown(df, "t")
    with pytest.raises(ValueError):
        serve.projection(df.withColumn("text", F.lit("")), ["text"])


def test_precedence(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    got = {r.k: (r.v, r.v_source) for r in concepts.by_precedence(base, [("reviewer", a), ("model", b)], "k", "v").collect()}
    assert got == {1: ("x", "reviewer"), 2: ("z", "model"), 3: (None, None)}


def test_model_answers(spark):
    df = spark.createDataFrame([(1, 'Sure:\n```json\n{"技术": ["Go", "Rust"]}\n```'), (2, "none"), (3, None)], "doc_id int, a string")
    got = {r.doc_id: r.j for r in df.select("doc_id", F.to_json(evidence.salvaged_json(F.col("a"))).alias("j")).collect()}
    assert json.loads(got[1]) == {"技术": ["Go", "Rust"]} and got[2] is None and got[3] is None
    terms = evidence.ability_terms(df.select("doc_id", F.to_json(evidence.salvaged_json(F.col("a"))).alias("j")), "doc_id", "j")
    docs = spark.createDataFrame([(1, "we use go daily")], "doc_id int, text string")
    assert [(r.category, r.term) for r in evidence.supported_terms(terms, docs).collect()] == [("技术", "Go")]


def test_approval_and_status(spark):
    df = spark.createDataFrame([(1, "EXACT", "OK"), (2, "VECTOR", "OK"), (3, "VECTOR", "REVIEWED"), (4, None, "OK")], "k int, match_type string, status string")
    assert [r.k for r in concepts.approved(df, {("EXACT", "OK"), ("VECTOR", "REVIEWED")}).collect()] == [1, 3]
    assert concepts.approved(df, set()).count() == 0
    rows = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("c", False)], "s string, m boolean")
    got = {r.s: r.status for r in concepts.normalization_status(rows, "s", F.col("m")).collect()}
    assert got == {"a": "MIXED_STANDARDIZED_AND_RAW", "b": "STANDARDIZED_CONCEPT", "c": "RAW_SKILL_FALLBACK"}


def test_descend_ends_in_a_cycle_and_takes_any_root(spark):
    edges = [("o'r", "b"), ("b", "c"), ("c", "o'r"), ("o'r", "c"), ("x", "y"), (None, "z"), ("c", None), *((f"n{i}", f"n{i + 1}") for i in range(12)), ("c", "n0")]
    df = spark.createDataFrame(edges, "parent string, child string")
    got = {r.node: r.depth for r in serve.descend(spark, df, "o'r").collect()}
    assert got == {"o'r": 0, "b": 1, "c": 1, **{f"n{i}": i + 2 for i in range(13)}}
    assert {r.node for r in serve.descend(spark, df, "o'r", limit=2).collect()} == {"o'r", "b", "c", "n0"}
    assert [tuple(r) for r in serve.descend(spark, df.limit(0), "a").collect()] == [("a", 0)]


def test_evidence_ids_with_brackets_and_escapes(spark):
    ids = ["a]b", 'q"u', "back\\", "[x", "é", "a]b"]
    texts = [json.dumps({"evidence_jd_ids": ids, "note": '"evidence_jd_ids": ["no"]', "in": [{"evidence_jd_ids": ["z"]}]}), json.dumps({"evidence_jd_ids": []}), None, '{"evidence_jd_ids": ["open"', "no json"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.ids for r in df.select("i", review.evidence_ids(F.col("t")).alias("ids")).collect()}
    assert got == {0: [*ids[:-1], "z"], 1: [], 2: [], 3: [], 4: []}


def test_headers_fold_and_the_version_has_all_business_fields(spark):
    row = spark.createDataFrame([("1", "Dev", "PM", "kw", "10-20", "S")], "`Job-ID` string, `JOB NAME` string, `岗位名称` string, `岗位关键词` string, `Company_Size` string, `skill tags` string")
    got = ingest.canonical(row).first()
    assert (got.job_id, got.title, got.normalized_role, got.declared_role, got.company_size, got.skill_tags, got.keyword, got.extra_json) == ("1", "Dev", "PM", "kw", "10-20", "S", "", "{}")
    both = spark.createDataFrame([("", "later"), ("first", "later")], "`职位名称` string, job_name string")
    assert [r.title for r in ingest.canonical(both).collect()] == ["later", "first"]
    ids = [ingest.with_identity(ingest.canonical(spark.createDataFrame([("1", "Dev", c, k)], "job_id string, title string, company_size string, search_keyword string")), default_platform="p").first().version_id for c, k in (("1", "a"), ("2", "a"), ("2", "b"))]
    assert ids[0] != ids[1] == ids[2]


def test_fisher_counts_equal_tables_as_equal():
    assert stats.fisher_exact(3, 10, 7, 10) == pytest.approx(0.178895, abs=1e-6)
    assert stats.fisher_exact(0, 5, 5, 5) == pytest.approx(2 / math.comb(10, 5)) and stats.fisher_exact(50, 100, 50, 100) == 1.0
    assert stats.fisher_exact(2400, 5000, 2500, 5000) == pytest.approx(0.0476, abs=2e-3)


def test_overlap_of_names_normalizes_each_once(spark):
    """A name was normalized anew for each bigram, and all pairs of one small file were one task's."""
    made = str(matching.meaningful_overlap(F.col("a"), F.col("b")))
    assert made.count("[^0-9a-z") == 2


def test_cluster_edges_spread_their_pairs(spark, sf):
    plan = catalog.QUERIES["cluster_edges"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan


def test_cluster_edges_by_bounds_and_names(spark):
    """Overlap decides only between the bounds; other words or years keep a pair apart."""
    rows = [
        (1, 2, "data model", "data models", 0.97, 0.94, 0.0, False), (1, 3, "data model", "hot bolt", 0.97, 0.94, 0.0, False), (1, 4, "data model", "hot bolt", 0.99, 0.99, 0.0, False),
        (1, 5, "数据模型", "数据建模", 0.97, 0.94, 0.0, False), (1, 6, "数据模型", "财务", 0.97, 0.94, 0.0, False), (1, 7, "数据模型", "财务", 0.99, 0.99, 0.0, False),
        (1, 8, "数据3年", "数据5年", 0.99, 0.99, 0.0, False), (1, 9, "数据3年", "数据3年", 0.99, 0.99, 0.0, False), (1, 10, "a", "b", 0.97, 0.97, 0.97, True), (1, 11, "a", "b", 0.97, None, 0.97, False),
    ]
    df = spark.createDataFrame(rows, "a int, b int, a_name string, b_name string, phrase double, context double, lexical double, by_name boolean")
    assert sorted(r.b for r in consolidation.cluster_edges(df).collect()) == [2, 5, 7, 9, 10]


def test_role_title_normalizes_once(spark):
    """Each rule normalized the title anew, and all titles of one small file were one task's."""
    assert str(titles.role_title(F.col("t"), F.lit("none"))).count("[^0-9a-z") == 1


def test_role_titles_spread_their_rows(spark, sf):
    assert "Repartition" in catalog.QUERIES["role_titles"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()


def test_candidate_groups_without_expanded_rows(spark):
    """One aggregate with four distinct counts held every row four times; nulls are a group, but no value."""
    m = spark.createDataFrame([("s", "c", 1, "VERIFIED"), ("s", "c", 1, "LOW"), ("s", "c", 2, "LOW"), ("s", None, 3, "VERIFIED"), ("s", None, 4, "REJECTED"), ("s", "c", 5, "VERIFIED")], "skill_id string, category string, jd_id int, status string")
    p = spark.createDataFrame([(1, 7, "r"), (2, 7, "q"), (3, None, "r"), (4, 8, "r"), (5, 9, None), (5, 10, "r")], "jd_id int, company_id int, role string")
    out = concepts.candidate_groups(m, p)
    assert sorted((r.category or "", r.jds, r.companies, r.roles, r.verified_jds) for r in out.collect()) == [("", 1, 0, 1, 1), ("c", 3, 3, 2, 2)]
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_rolled_up_without_expanded_rows(spark):
    facts = spark.createDataFrame([("a", "m", 1, 1, True), ("a", "n", 1, 1, False), ("a", "n", 2, 2, False), (None, "m", 1, 1, None)], "concept string, member string, company_id int, jd_id int, verified boolean")
    out = consolidation.rolled_up(facts, F.col("concept") == "a")
    assert sorted((r.concept or "", r.members, r.companies, r.jds, r.verified_rate, r.status) for r in out.collect()) == [("", 1, 1, 1, 0.0, "CANDIDATE"), ("a", 2, 2, 2, 0.5, "STANDARD")]
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
