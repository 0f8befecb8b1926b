"""Queries of ``operators.serve`` with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import profile as P
from larkspur.operators import serve as S
from larkspur.plans import adapters as A
from larkspur.plans import profile_queries as PQ
from larkspur.plans.adapters import CTES
from larkspur.session import written

CTES |= {
    "ranked": """SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY s.role ORDER BY adjusted_support DESC, evidence_count DESC, skill_id) AS skill_rank FROM snapshots s
        JOIN (SELECT role, max(window_start) AS newest FROM snapshots GROUP BY role) n ON s.role = n.role AND s.window_start = n.newest WHERE adjusted_support >= 0.1) WHERE skill_rank <= 30""",
    "relations": "SELECT 'world' AS parent, r_name AS child FROM region UNION ALL SELECT r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey",
}


def ranked(s, d):
    return S.ranked_skills(written(PQ.snapshots(s, d), "snapshots"))


def _panorama(s, d):
    return S.panorama(ranked(s, d), P.skill_dimension(A.mentions(s, d)), P.roles(A.postings(s, d)))


def _relations(s, d):
    region, nation = A.table(s, d, "region"), A.table(s, d, "nation")
    both = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    return region.select(F.lit("world").alias("parent"), F.col("r_name").alias("child")).union(both.select("r_name", "n_name"))


def _decisions(s, d):
    """Events as a decision log: the last event of each user and type stands."""
    return S.latest_decisions(A.versions(s, d).select("raw_uid", "event_type", "observed_epoch", "seq", "value"), ["raw_uid", "event_type"], ["observed_epoch", "seq"])


QUERIES = {
    "health_counts": (
        lambda s, d: S.health({n: A.table(s, d, n) for n in ("orders", "lineitem", "part", "customer", "events")}),
        " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows FROM {n}" for n in ("orders", "lineitem", "part", "customer", "events")),
    ),
    "facets": (
        lambda s, d: S.facets(PQ.weighted(s, d), ["industry", "level", "time_window", "source_family"]),
        "SELECT facet, value, count(*) AS rows FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value FROM weighted" for c in ("industry", "level", "time_window", "source_family")) + ") GROUP BY ALL",
    ),
    "roles_list": (
        lambda s, d: S.role_list(P.roles(A.postings(s, d)), PQ.profiles(s, d), industry="BUILDING"),
        """SELECT r.*, profile_count, latest_window FROM (SELECT role, count(*) AS document_count, count(DISTINCT company_id) AS company_count, string_agg(DISTINCT industry, '|' ORDER BY industry) AS industries, 'role:' || substr(sha1(role), 1, 16) AS role_id FROM postings GROUP BY role) r
           JOIN (SELECT role, count(DISTINCT profile_id) AS profile_count, max(window_start) AS latest_window FROM profiles WHERE industry = 'BUILDING' GROUP BY role) p USING (role)""",
    ),
    "latest_profiles": (
        lambda s, d: S.latest_window(PQ.profiles(s, d), ["role", "industry", "level"]),
        "SELECT p.* FROM profiles p JOIN (SELECT role, industry, level, max(window_start) AS newest FROM profiles GROUP BY ALL) n USING (role, industry, level) WHERE window_start = newest",
    ),
    "panorama_topn": (ranked, "SELECT * FROM ranked"),
    "panorama_graph": (
        _panorama,
        """SELECT 'role' AS kind, role AS id, role AS label, NULL AS source, NULL AS target FROM (SELECT DISTINCT role FROM ranked)
           UNION ALL SELECT DISTINCT 'category', 'category:' || role || ':' || competency_category, competency_category, NULL, NULL FROM ranked JOIN skill_dim USING (skill_id)
           UNION ALL SELECT 'skill', 'skill:' || role || ':' || skill_id, skill_id, NULL, NULL FROM ranked
           UNION ALL SELECT DISTINCT 'HAS_SKILL_GROUP', 'edge:category:' || role || ':' || competency_category, '', role, 'category:' || role || ':' || competency_category FROM ranked JOIN skill_dim USING (skill_id)
           UNION ALL SELECT 'HAS_SKILL', 'edge:skill:' || role || ':' || skill_id, tier, 'category:' || role || ':' || competency_category, 'skill:' || role || ':' || skill_id FROM ranked JOIN skill_dim USING (skill_id)""",
    ),
    "role_timeline": (
        lambda s, d: S.timeline(PQ.snapshots(s, d)),
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role, time_window ORDER BY adjusted_support DESC, skill_id) AS skill_rank FROM snapshots) WHERE skill_rank <= 12",
    ),
    "latest_summary": (
        lambda s, d: S.latest_summary(*PQ.chain(s, d)),
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY summary_support DESC, evidence_count DESC, skill_id) AS summary_rank FROM (
           SELECT s.role, s.skill_id, round(sum(adjusted_support * jd_count) / sum(jd_count) + 1e-10::DOUBLE, 6) AS summary_support, sum(evidence_count)::BIGINT AS evidence_count FROM support s JOIN (SELECT p.* FROM profiles p JOIN (SELECT role, max(window_start) AS newest FROM profiles GROUP BY ALL) n USING (role) WHERE window_start = newest) p USING (role, industry, level, time_window) GROUP BY ALL)) WHERE summary_rank <= 20""",
    ),
    "raw_titles": (
        lambda s, d: S.top_values(A.postings(s, d), ["role"], "location", 8),
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY amount DESC, location) AS value_rank FROM (SELECT role, location, count(*) AS amount FROM postings GROUP BY ALL)) WHERE value_rank <= 8",
    ),
    "skill_evidence": (
        lambda s, d: S.evidence(A.mentions(s, d), PQ.weighted(s, d), "red bolt", role="1-URGENT").select("jd_id", "seq", "skill_id", "status", "confidence", "role", "company_name", "posted_at", "time_window"),
        """SELECT jd_id, seq, skill_id, status, confidence, role, company_name, posted_at, time_window FROM mentions JOIN weighted USING (jd_id) WHERE skill_id = 'red bolt' AND role = '1-URGENT' AND status IN ('VERIFIED', 'LOW_CONFIDENCE', 'ANALYSIS_ONLY')
           ORDER BY CASE status WHEN 'VERIFIED' THEN 1 WHEN 'LOW_CONFIDENCE' THEN 2 ELSE 3 END, confidence DESC, posted_at DESC, jd_id, seq, stack, mentions.category, requirement LIMIT 50""",
    ),
    "review_tasks": (
        lambda s, d: S.review_tasks(A.mentions(s, d), A.postings(s, d)),
        "SELECT t.*, p.role, p.company_name FROM (SELECT * FROM mentions WHERE status <> 'VERIFIED' ORDER BY confidence, jd_id, seq, skill_id, stack, requirement LIMIT 100) t LEFT JOIN postings p USING (jd_id)",
    ),
    "review_decisions": (
        _decisions,
        "SELECT raw_uid, event_type, observed_epoch, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY raw_uid, event_type ORDER BY observed_epoch DESC, seq DESC) AS n FROM versions) WHERE n = 1",
    ),
    "quality_counts": (lambda s, d: S.quality(A.mentions(s, d)), "SELECT status, count(*) AS amount, count(*) FILTER (requirement = 'preferred') AS preferred FROM mentions GROUP BY status"),
    "role_tree": (
        lambda s, d: S.descend(s, _relations(s, d), "world"),
        "SELECT node, min(depth) AS depth FROM tree GROUP BY node",
    ),
    "display_projection": (
        lambda s, d: S.projection(A.postings(s, d), ["jd_id", "role", "industry", "level", "source_family"]),
        "SELECT jd_id, role, industry, level, source_family FROM postings",
    ),
    "keyset_page": (
        lambda s, d: S.page_after(A.postings(s, d).select("jd_id", "role", "company_id"), "jd_id", 1000, 500),
        "SELECT jd_id, role, company_id FROM postings WHERE jd_id > 1000 ORDER BY jd_id LIMIT 500",
    ),
    "validation_report": (
        lambda s, d: S.validation(A.postings(s, d), A.mentions(s, d), P.skill_dimension(A.mentions(s, d))),
        """SELECT 'posting_key_repeated' AS "check", count(*) - count(DISTINCT jd_id) AS failures FROM postings UNION ALL SELECT 'posting_key_missing', count(*) FILTER (jd_id IS NULL) FROM postings
           UNION ALL SELECT 'mention_without_posting', count(*) FROM mentions WHERE jd_id NOT IN (SELECT jd_id FROM postings) UNION ALL SELECT 'mention_without_skill', count(*) FROM mentions WHERE skill_id NOT IN (SELECT skill_id FROM skill_dim)
           UNION ALL SELECT 'posting_without_mention', count(*) FROM postings WHERE jd_id NOT IN (SELECT jd_id FROM mentions) UNION ALL SELECT 'confidence_out_of_range', count(*) FILTER (NOT confidence BETWEEN 0 AND 1) FROM mentions""",
    ),
    "level_counts_ordered": (
        lambda s, d: A.postings(s, d).groupBy("level").agg(F.count("*").alias("n")).withColumn("place", F.when(F.col("level") == "P", 1).when(F.col("level") == "O", 2).otherwise(3)).orderBy("place"),
        "SELECT level, count(*) AS n, CASE level WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS place FROM postings GROUP BY level",
    ),
}
CTES["tree"] = "SELECT 'world' AS node, 0 AS depth UNION ALL SELECT r.child, t.depth + 1 FROM relations r JOIN tree t ON r.parent = t.node"
