"""Queries of versions, dedup, clusters, similarity and concepts, with their oracle."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.functions import text as X
from larkspur.operators import cluster as CL
from larkspur.operators import concepts as C
from larkspur.operators import dedup as D
from larkspur.operators import dictionary as DI
from larkspur.operators import editjoin as EJ
from larkspur.operators import greedy as G
from larkspur.operators import similarity as S
from larkspur.operators import versions as V
from larkspur.plans import adapters as A
from larkspur.plans import evolution_queries as EQ
from larkspur.plans import profile_queries as PQ
from larkspur.plans.adapters import CTES

FIELDS = ["event_type", "value"]

CTES |= {
    "phrases": "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' ' || p_type ELSE p_name || p_type END AS phrase FROM part",
    "registry": "SELECT DISTINCT 'N:' || p_name AS name, lower(p_name) AS alias FROM part WHERE p_partkey % 2 = 0 AND p_size % 2 = 0 UNION SELECT 'W:' || regexp_extract(p_name, '(\\w+)$', 1), lower(regexp_extract(p_name, '(\\w+)$', 1)) FROM part UNION SELECT 'T:' || p_type, lower(p_type) FROM part",
    "docs": "SELECT doc_id, coalesce(text, '') AS text, lang AS role, source AS company FROM documents",
    "normal": "SELECT doc_id, role, company, text, regexp_replace(lower(text), '[^0-9a-z一-鿿+#.]', '', 'g') AS t FROM docs",
    "pass1": "SELECT *, nullif(min(doc_id) OVER (PARTITION BY company, role, text), doc_id) AS dup1 FROM normal",
    "rated": """SELECT * FROM (SELECT role, skill_id, company_count, jd_count, verified_jd_count, round(0.30 * (company_count / companies) + 0.20 * (jd_count / jds) + 0.20 * (ln(role_count / roles_with) / ln(role_count)) + 0.10 * (rs / jd_count) + 0.10 * (es / jd_count) + 0.10 * (ts / jd_count) + 1e-10::DOUBLE, 6) AS final_score,
        CASE WHEN jds < 100 THEN greatest(3, ceil(jds * 0.2::DOUBLE)) ELSE greatest(15, ceil(jds * 0.005::DOUBLE)) END AS lj, CASE WHEN jds < 100 THEN greatest(2, ceil(companies * 0.2::DOUBLE)) ELSE greatest(8, ceil(companies * 0.005::DOUBLE)) END AS lc
        FROM (SELECT role, skill_id, count(DISTINCT company_id) AS company_count, count(*) AS jd_count, count(*) FILTER (status = 'VERIFIED') AS verified_jd_count, sum(CASE WHEN requirement = 'required' THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END) AS rs, sum(confidence) AS es, sum(base) AS ts FROM accepted JOIN weighted USING (jd_id) GROUP BY ALL)
        JOIN (SELECT skill_id, count(DISTINCT role) AS roles_with FROM accepted JOIN weighted USING (jd_id) GROUP BY ALL) USING (skill_id) JOIN (SELECT role, count(*) AS jds, count(DISTINCT company_id) AS companies FROM weighted GROUP BY ALL) USING (role), (SELECT count(DISTINCT role) AS role_count FROM weighted))
        WHERE jd_count >= lj AND company_count >= lc AND verified_jd_count >= least(3, lj)""",
    "cos": """SELECT a.vec_id AS query, b.vec_id AS neighbour, round(greatest(0, least(1, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])))), 9) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id""",
    "knn": "SELECT query, neighbour, similarity, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, neighbour) AS k FROM cos) WHERE k <= 10",
}


def docs(s, d):
    return A.table(s, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("lang").alias("role"), F.col("source").alias("company"))


def _two_pass(s, d):
    rows = docs(s, d).withColumn("t", F.regexp_replace(F.lower("text"), "[^0-9a-z一-鿿+#.]", ""))
    out = D.two_pass(rows, [F.col("company"), F.col("role"), F.col("text")], [F.col("role"), F.col("t")], F.length("t") >= 30, ["doc_id"])
    return out.select("doc_id", "duplicate_of", "duplicate_reason")


def neighbours(s, d, k=10):
    e = A.table(s, d, "embeddings")
    return S.top_k(e, e, "vec_id", "embedding", k)


def neighbours_by_cells(s, d, k=10):
    e = A.table(s, d, "embeddings")
    return S.nearest_by_cells(e, e, "vec_id", "embedding", k)


def _rounded_knn(df):
    return df.select("query", "neighbour", F.round("similarity", 6).alias("similarity"))


def _phrases(s, d):
    """Names of parts, alone, with their kind, and run together with it."""
    form = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat_ws(" ", "p_name", "p_type")).otherwise(F.concat("p_name", "p_type"))
    return A.table(s, d, "part").select("p_partkey", form.alias("phrase"))


def _registry(s, d):
    """Names of parts of an even key and size, the last words of all, and the kinds."""
    part, own = A.table(s, d, "part"), "p_partkey % 2 = 0 AND p_size % 2 = 0"
    names = part.where(own).select(F.concat(F.lit("N:"), "p_name").alias("name"), F.lower("p_name").alias("alias"))
    words = part.select(F.regexp_extract("p_name", r"(\w+)$", 1).alias("w")).select(F.concat(F.lit("W:"), "w").alias("name"), F.lower("w").alias("alias"))
    kinds = part.select(F.concat(F.lit("T:"), "p_type").alias("name"), F.lower("p_type").alias("alias"))
    return names.union(words).union(kinds).distinct()


def _scores(s, d):
    return C.role_scores(PQ.accepted(s, d), PQ.weighted(s, d))


def _categories(s, d):
    return C.harmonized(C.candidate_groups(A.mentions(s, d), A.postings(s, d), roles=False))


def _quota(s, d):
    return C.quota_top(_scores(s, d).join(_categories(s, d).select("skill_id", "category"), "skill_id"), "role", "category", "final_score", "skill_id", {"STANDARD": 3, "PROMO": 2}, 1)


def _near(s, d):
    return D.near_duplicates(docs(s, d), "doc_id", "role", F.col("text"))


def _near_clusters(s, d):
    """The cluster of every document; one without a near duplicate is its own."""
    return D.near_clusters(docs(s, d), "doc_id", "role", F.col("text"))


def _titles(s, d):
    """Names and kinds of parts, with a number of two digits: many texts that differ a little."""
    return A.table(s, d, "part").select(F.concat_ws(" ", "p_name", "p_type", F.lpad((F.col("p_partkey") % 97).cast("string"), 2, "0")).alias("title"), F.col("p_brand").alias("brand"))


def _title_clusters(s, d):
    """Clusters of names that are alike."""
    names = A.table(s, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("title"))
    return CL.components(EJ.similar_texts(names, "title", 0.92).select("a", "b"))


def _capped(s, d):
    pairs = _rounded_knn(neighbours(s, d, 5)).where("query < neighbour").join(A.table(s, d, "embeddings").select(F.col("vec_id").alias("query"), F.col("label").alias("block")), "query")
    return G.capped(pairs.select("block", F.col("query").alias("a"), F.col("neighbour").alias("b"), F.col("similarity").alias("score")), "block", most=8)


def centroid_parts(s, d):
    """Edges to the five nearest, and nodes of one block whose families are the labels; a seventh has none."""
    e = A.table(s, d, "embeddings")
    edges = _rounded_knn(neighbours(s, d, 5)).where("query < neighbour").select(F.lit("all").alias("block"), F.col("query").alias("a"), F.col("neighbour").alias("b"), F.col("similarity").alias("score"))
    nodes = e.select(F.lit("all").alias("block"), F.col("vec_id").alias("node"), F.when(F.col("vec_id") % 7 != 0, F.col("label").cast("string")).alias("family"), F.col("embedding").alias("vector"))
    return edges, nodes


def _centroid(s, d):
    return G.centroid_clusters(*centroid_parts(s, d), "block", most=60, least=0.6)


def _mmr(s, d):
    e = A.table(s, d, "embeddings").withColumn("score", F.round(F.col("vec_id") * 37 % 1000 / 1000.0, 6))
    return S.mmr(e, ["label"], "vec_id", "score", "embedding", 5)


def _prototypes(s, d):
    e = A.table(s, d, "embeddings")
    protos = e.where("vec_id < 6").select((F.col("vec_id") < 3).alias("positive"), F.col("embedding").alias("v"))
    out = S.prototype_score(e.select("vec_id", "embedding"), "embedding", protos)
    return out.select("vec_id", *(F.round(c, 5).alias(c) for c in ("positive_similarity", "negative_similarity", "semantic_score")))


QUERIES = {
    "version_hash": (
        lambda s, d: V.distinct_versions(A.versions(s, d).withColumn("value", F.floor("value")), "raw_uid", FIELDS),
        "SELECT raw_uid, sha256(event_type || chr(31) || floor(value)::BIGINT::VARCHAR) AS version_hash, min(observed_epoch) AS first_seen, max(observed_epoch) AS last_seen, count(*) AS observations FROM versions GROUP BY ALL",
    ),
    "current_version": (
        lambda s, d: V.current(A.versions(s, d), "raw_uid").select("raw_uid", "observed_epoch", "seq", "event_type", "value"),
        "SELECT raw_uid, observed_epoch, seq, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY raw_uid ORDER BY observed_epoch DESC, seq DESC) AS n FROM versions) WHERE n = 1",
    ),
    "late_versions": (
        lambda s, d: V.late(A.versions(s, d).withColumn("seq", F.sha2(F.col("seq").cast("string"), 256)), "raw_uid").agg(F.count("*").alias("late_rows")),
        "SELECT count(*) AS late_rows FROM (SELECT observed_epoch, max(observed_epoch) OVER (PARTITION BY raw_uid ORDER BY sha256(seq::VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM versions) WHERE observed_epoch < before",
    ),
    "unchanged_files_anti": (
        lambda s, d: V.unchanged(A.versions(s, d).select(F.col("raw_uid").alias("path"), F.col("event_type").alias("signature")).distinct(), A.versions(s, d).where("value < 5").select(F.col("raw_uid").alias("path"), F.col("event_type").alias("signature"))),
        "SELECT DISTINCT raw_uid AS path, event_type AS signature FROM versions WHERE (raw_uid, event_type) NOT IN (SELECT raw_uid, event_type FROM versions WHERE value < 5)",
    ),
    "orphan_abilities": (
        lambda s, d: V.orphans(A.table(s, d, "part").select(F.col("p_partkey").alias("part")), A.table(s, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("part")), ["part"]),
        "SELECT p_partkey AS part FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)",
    ),
    "retained_versions": (
        lambda s, d: V.retained(A.versions(s, d), V.current(A.versions(s, d), "raw_uid"), ["raw_uid", "seq"]).select("raw_uid", "seq"),
        "SELECT raw_uid, seq FROM (SELECT *, row_number() OVER (PARTITION BY raw_uid ORDER BY observed_epoch DESC, seq DESC) AS n FROM versions) WHERE n = 1",
    ),
    "merge_upsert": (
        lambda s, d: V.merged(A.versions(s, d).where("seq % 2 = 0").drop("ts", "props"), A.versions(s, d).where("seq % 2 = 1").drop("ts", "props"), "raw_uid", ["observed_epoch", "seq"]),
        "SELECT raw_uid, observed_epoch, seq, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY raw_uid ORDER BY observed_epoch DESC, seq DESC) AS n FROM versions) WHERE n = 1",
    ),
    "exact_dedup": (
        lambda s, d: D.first_seen(docs(s, d), [F.col("company"), F.col("role"), F.col("text")], ["doc_id"]).select("doc_id", "duplicate_of"),
        "SELECT doc_id, dup1 AS duplicate_of FROM pass1",
    ),
    "two_pass_dedup": (
        _two_pass,
        """SELECT doc_id, dup1 AS duplicate_of, 'EXACT_DUPLICATE' AS duplicate_reason FROM pass1 WHERE dup1 IS NOT NULL UNION ALL SELECT doc_id, NULL, NULL FROM pass1 WHERE dup1 IS NULL AND length(t) < 30
           UNION ALL SELECT doc_id, dup2, CASE WHEN dup2 IS NOT NULL THEN 'EXACT_EXTRACTED_ENTRY_DUPLICATE' END FROM (SELECT doc_id, nullif(min(doc_id) OVER (PARTITION BY role, t), doc_id) AS dup2 FROM pass1 WHERE dup1 IS NULL AND length(t) >= 30)""",
    ),
    "template_weight": (
        lambda s, d: PQ.weighted(s, d).groupBy("role").agg(F.round(F.sum("template_weight"), 4).alias("weight"), F.max("template_size").alias("largest")),
        "SELECT role, round(sum(template_weight), 4) AS weight, max(template_size) AS largest FROM weighted GROUP BY role",
    ),
    "text_identity": (
        lambda s, d: docs(s, d).select("doc_id", X.text_hash(F.col("company"), F.col("role"), F.col("text")).alias("exact_hash"), F.sha2(F.regexp_replace(F.regexp_replace(F.lower("text"), r"[ \t\n\r\f\x0b]+", ""), "[0-9]+", "#"), 256).alias("template"), X.stable_id("jd", F.col("doc_id")).alias("graph_id"), X.evolution_id(F.col("role"), F.col("doc_id")).alias("evolution_id")),
        """SELECT doc_id, sha256(regexp_replace(lower(company), '[^0-9a-z一-鿿+#.]', '', 'g') || '|' || regexp_replace(lower(role), '[^0-9a-z一-鿿+#.]', '', 'g') || '|' || t) AS exact_hash, sha256(regexp_replace(regexp_replace(lower(text), '[ \\t\\n\\r\\f\\v]+', '', 'g'), '[0-9]+', '#', 'g')) AS template,
           'jd:' || substr(sha1(doc_id::VARCHAR), 1, 16) AS graph_id, substr(sha256(role || chr(31) || doc_id::VARCHAR), 1, 20) AS evolution_id FROM normal""",
    ),
    "simhash_dups": (lambda s, d: D.close_hashes(docs(s, d), "doc_id", "role", F.col("text")).select("a", "b"), None),
    "near_duplicates": (_near, None),
    "near_dup_clusters": (_near_clusters, None),
    "greedy_templates": (lambda s, d: D.greedy_templates(docs(s, d), "role", "doc_id", F.col("text")), None),
    "title_clusters": (_title_clusters, None),
    "similar_titles": (lambda s, d: EJ.similar_texts(_titles(s, d), "title", 0.9, "brand").select("brand", "a", "b", F.round("ratio", 6).alias("ratio")), None),
    "capped_clusters": (_capped, None),
    "centroid_clusters": (_centroid, None),
    "cosine_topk": (lambda s, d: neighbours(s, d).select("query", "rank", F.round("similarity", 5).alias("similarity")), "SELECT query, rank, round(similarity, 5) AS similarity FROM knn"),
    "ann_topk": (lambda s, d: neighbours_by_cells(s, d).select("query", "neighbour", "rank", F.round("similarity", 5).alias("similarity")), None),
    "mutual_knn": (lambda s, d: S.mutual(neighbours(s, d)).select("a", "b"), "SELECT x.query AS a, x.neighbour AS b FROM knn x JOIN knn y ON x.query = y.neighbour AND x.neighbour = y.query WHERE x.query < x.neighbour"),
    "prototype_score": (
        _prototypes,
        """SELECT vec_id, round(p, 5) AS positive_similarity, round(n, 5) AS negative_similarity, round(greatest(0, least(1, 0.5 + (p - n) * 2.6)), 5) AS semantic_score FROM (SELECT a.vec_id, max(c) FILTER (b.vec_id < 3) AS p, max(c) FILTER (b.vec_id >= 3) AS n FROM (SELECT a, b, greatest(0, least(1, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))))) AS c FROM embeddings a, embeddings b WHERE b.vec_id < 6) GROUP BY a.vec_id)""",
    ),
    "mmr_select": (_mmr, None),
    "redundancy_filter": (lambda s, d: S.without_redundant(A.table(s, d, "embeddings").withColumn("score", F.round(F.col("vec_id") * 37 % 1000 / 1000.0, 6)), ["label"], "vec_id", "score", "embedding", 0.9), None),
    "adaptive_thresholds": (
        lambda s, d: C.with_thresholds(C.role_totals(A.postings(s, d)), True),
        "SELECT role, jds, companies, CASE WHEN jds < 100 THEN greatest(3, ceil(jds * 0.2::DOUBLE)) ELSE greatest(15, ceil(jds * 0.005::DOUBLE)) END::BIGINT AS least_jds, CASE WHEN jds < 100 THEN greatest(2, ceil(companies * 0.2::DOUBLE)) ELSE greatest(8, ceil(companies * 0.005::DOUBLE)) END::BIGINT AS least_companies FROM (SELECT role, count(*) AS jds, count(DISTINCT company_id) AS companies FROM postings GROUP BY role)",
    ),
    "candidate_groups": (
        lambda s, d: C.candidate_groups(A.mentions(s, d), A.postings(s, d)),
        "SELECT skill_id, category, count(DISTINCT jd_id) AS jds, count(DISTINCT company_id) AS companies, count(DISTINCT role) AS roles, count(DISTINCT jd_id) FILTER (status = 'VERIFIED') AS verified_jds FROM mentions JOIN (SELECT jd_id, company_id, role FROM postings) USING (jd_id) WHERE NOT starts_with(status, 'REJECTED') GROUP BY ALL",
    ),
    "concept_categories": (
        _categories,
        "SELECT skill_id, arg_max(category, (verified_jds, jds, companies, category)) AS category, count(*) AS variants FROM (SELECT skill_id, category, count(DISTINCT jd_id) AS jds, count(DISTINCT company_id) AS companies, count(DISTINCT jd_id) FILTER (status = 'VERIFIED') AS verified_jds FROM mentions JOIN (SELECT jd_id, company_id FROM postings) USING (jd_id) WHERE NOT starts_with(status, 'REJECTED') GROUP BY ALL) GROUP BY skill_id",
    ),
    "concept_rank": (_scores, "SELECT role, skill_id, company_count, jd_count, verified_jd_count, final_score FROM rated"),
    "quota_topk": (
        _quota,
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role, category ORDER BY final_score DESC, skill_id) AS concept_rank FROM (SELECT role, skill_id, company_count, jd_count, verified_jd_count, final_score FROM rated) JOIN (SELECT skill_id, arg_max(category, (verified_jds, jds, companies, category)) AS category FROM (SELECT skill_id, category, count(DISTINCT jd_id) AS jds, count(DISTINCT company_id) AS companies, count(DISTINCT jd_id) FILTER (status = 'VERIFIED') AS verified_jds FROM mentions JOIN (SELECT jd_id, company_id FROM postings) USING (jd_id) WHERE NOT starts_with(status, 'REJECTED') GROUP BY ALL) GROUP BY skill_id) USING (skill_id))
           WHERE concept_rank <= CASE category WHEN 'STANDARD' THEN 3 WHEN 'PROMO' THEN 2 ELSE 1 END""",
    ),
    "concept_quarters": (
        lambda s, d: C.quarter_snapshot(PQ.accepted(s, d), PQ.weighted(s, d)),
        """SELECT a.role, a.time_window, a.skill_id, a.jd_count, a.company_count, a.verified_jd_count, a.final_score, coalesce(round(a.final_score - b.final_score, 6), 0) AS delta, CASE WHEN b.final_score IS NULL THEN 'emerging' WHEN round(a.final_score - b.final_score, 6) >= 0.05 THEN 'rising' WHEN round(a.final_score - b.final_score, 6) <= -0.05 THEN 'falling' ELSE 'stable' END AS trend FROM quarters a LEFT JOIN quarters b ON a.role = b.role AND a.skill_id = b.skill_id AND a.place = b.place + 1""",
    ),
    "contained_alias": (
        lambda s, d: DI.longest_contained(_phrases(s, d), "phrase", _registry(s, d), "alias", "name").select("p_partkey", "phrase", "name"),
        """SELECT p_partkey, p.phrase, l.name FROM phrases p LEFT JOIN (SELECT phrase, arg_max(name, (length(alias), alias)) AS name FROM (SELECT DISTINCT phrase FROM phrases), (SELECT alias, min(name) AS name FROM registry GROUP BY alias) WHERE length(alias) >= 4 AND contains(lower(phrase), alias) GROUP BY phrase) l USING (phrase)""",
    ),
    "phrase_registry": (
        lambda s, d: DI.resolved_phrases(_phrases(s, d), "phrase", _registry(s, d), "name", "alias").select("phrase", "name", F.round("coverage", 6).alias("coverage")),
        """SELECT phrase, coalesce(e.name, b.name) AS name, CASE WHEN e.name IS NOT NULL THEN 1 ELSE round(b.coverage, 6) END::DOUBLE AS coverage FROM (SELECT DISTINCT phrase, regexp_replace(lower(phrase), '[^0-9a-z+#.]', '', 'g') AS n FROM phrases)
           LEFT JOIN (SELECT regexp_replace(alias, '[^0-9a-z+#.]', '', 'g') AS n, min(name) AS name FROM registry GROUP BY ALL) e USING (n)
           LEFT JOIN (SELECT phrase, arg_min(name, (-c, -k, name)) AS name, max(c) AS coverage FROM (SELECT phrase, name, k, k::DOUBLE / length(n) AS c FROM (
               SELECT phrase, name, regexp_replace(lower(phrase), '[^0-9a-z+#.]', '', 'g') AS n, length(regexp_replace(arg_min(alias, (-length(alias), alias)), '[^0-9a-z+#.]', '', 'g')) AS k
               FROM (SELECT DISTINCT phrase FROM phrases), registry WHERE regexp_matches(phrase, '(?i)(^|[^A-Za-z0-9+#])' || alias || '([^A-Za-z0-9+#]|$)') GROUP BY phrase, name)) WHERE c >= 0.5 GROUP BY phrase) b USING (phrase)""",
    ),
    "set_operations": (
        lambda s, d: EQ.records(s, d).where("period = 'baseline'").select("role", "title").distinct().union(EQ.records(s, d).where("period = 'current'").select("role", "title").distinct()).distinct().subtract(EQ.records(s, d).where("period = 'historical'").select("role", "title")),
        "(SELECT role, title FROM records WHERE period = 'baseline' UNION SELECT role, title FROM records WHERE period = 'current') EXCEPT SELECT role, title FROM records WHERE period = 'historical'",
    ),
}
CTES["quarters"] = """SELECT *, round(0.55 * company_count / companies + 0.30 * jd_count / jds + 0.15 * confidence + 1e-10::DOUBLE, 6) AS final_score FROM (SELECT role, time_window, skill_id, count(*) AS jd_count, count(DISTINCT company_id) AS company_count, count(*) FILTER (status = 'VERIFIED') AS verified_jd_count, avg(confidence) AS confidence FROM accepted JOIN weighted USING (jd_id) GROUP BY ALL)
    JOIN (SELECT role, time_window, jds, companies, row_number() OVER (PARTITION BY role ORDER BY window_start) AS place FROM (SELECT role, time_window, window_start, count(*) AS jds, count(DISTINCT company_id) AS companies FROM weighted GROUP BY ALL)) USING (role, time_window)"""

