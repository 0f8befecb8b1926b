"""Queries of ``operators.profile`` and the read API, with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import incremental as I
from larkspur.operators import profile as P
from larkspur.plans import adapters as A
from larkspur.plans.adapters import CTES
from larkspur.session import written


def template():
    return F.concat_ws("|", "role", F.floor(F.col("salary") / 500).cast("string"))


CTES |= {
    "weighted": """SELECT *, time_weight * template_weight AS base FROM (
        SELECT p.*, t.template_size, CASE WHEN t.template_size < 2 THEN 1.0::DOUBLE ELSE round(greatest(0.35::DOUBLE, 1 / sqrt(t.template_size)), 6) END AS template_weight,
        year(posted_at)::VARCHAR || 'Q' || quarter(posted_at)::VARCHAR AS time_window, strftime(date_trunc('quarter', posted_at), '%Y-%m-%d') AS window_start,
        pow(0.5::DOUBLE, greatest(0::DOUBLE, (epoch((SELECT max(posted_at) FROM postings)) - epoch(posted_at)) / 86400.0::DOUBLE) / 30.4375::DOUBLE / 12.0::DOUBLE) AS time_weight
        FROM postings p JOIN (SELECT role, floor(salary / 500) AS k, count(*) AS template_size FROM postings GROUP BY ALL) t ON p.role = t.role AND floor(p.salary / 500) = t.k)""",
    "accepted": """SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY jd_id, skill_id ORDER BY CASE status WHEN 'VERIFIED' THEN 1 WHEN 'LOW_CONFIDENCE' THEN 2 ELSE 3 END, confidence DESC, seq, stack, category, requirement) AS n
        FROM mentions WHERE status IN ('VERIFIED', 'LOW_CONFIDENCE', 'ANALYSIS_ONLY')) WHERE n = 1""",
    "profiles": """SELECT *, coalesce(lag(profile_id) OVER (PARTITION BY role, industry, level ORDER BY window_start), '') AS previous_profile_id FROM (
        SELECT role, industry, level, time_window, min(window_start) AS window_start, count(*) AS jd_count, count(DISTINCT company_id) AS company_count,
        'profile:' || substr(sha1(role || '|' || industry || '|' || level || '|' || time_window), 1, 16) AS profile_id FROM weighted GROUP BY ALL)""",
    "raw_support": """SELECT s.*, jd_vote / jd_all AS jd_support, company_vote / company_all AS company_support, 0.7::DOUBLE * (company_vote / company_all) + (1 - 0.7::DOUBLE) * (jd_vote / jd_all) AS adjusted FROM (
        SELECT role, industry, level, time_window, skill_id, sum(jd_vote) AS jd_vote, sum(company_vote) AS company_vote, sum(tw) AS effective, count(*) AS company_count, sum(hits)::BIGINT AS evidence_count, sum(preferred)::BIGINT AS preferred_mentions FROM (
            SELECT role, industry, level, time_window, skill_id, company_id, sum(base * confidence) AS jd_vote, max(base * confidence) AS company_vote, max(template_weight) AS tw, count(*) AS hits, count(*) FILTER (requirement = 'preferred') AS preferred
            FROM accepted JOIN weighted USING (jd_id) GROUP BY ALL) GROUP BY ALL) s
        JOIN (SELECT role, industry, level, time_window, sum(jd) AS jd_all, sum(company) AS company_all FROM (SELECT role, industry, level, time_window, company_id, sum(base) AS jd, max(base) AS company FROM weighted GROUP BY ALL) GROUP BY ALL) d USING (role, industry, level, time_window)""",
    "support": """SELECT role, industry, level, time_window, skill_id, CASE WHEN preferred_mentions = evidence_count THEN 'PREFERS_SKILL' ELSE 'REQUIRES_SKILL' END AS relation,
        CASE WHEN preferred_mentions = evidence_count THEN 'bonus' WHEN round(adjusted, 9) >= 0.6 AND round(effective, 9) >= 3 THEN 'required' WHEN round(adjusted, 9) >= 0.3 THEN 'common' ELSE 'emerging' END AS tier,
        round(jd_support, 6) AS jd_support, round(company_support, 6) AS company_support, round(adjusted, 6) AS adjusted_support, company_count, round(effective, 4) AS effective_company_count, evidence_count, preferred_mentions
        FROM raw_support WHERE round(adjusted, 9) >= 0.1 OR preferred_mentions > 0""",
    "snapshots": """SELECT * EXCLUDE (before), coalesce(before, 0) AS previous_support, coalesce(round(adjusted_support - before, 6), 0) AS delta,
        CASE WHEN before IS NULL THEN 'NEW' WHEN round(adjusted_support - before, 6) >= 0.08 THEN 'UP' WHEN round(adjusted_support - before, 6) <= -0.08 THEN 'DOWN' ELSE 'STABLE' END AS trend FROM (
        SELECT *, lag(adjusted_support) OVER (PARTITION BY role, skill_id ORDER BY window_start) AS before FROM (
            SELECT * EXCLUDE (preferred), CASE WHEN preferred >= evidence_count THEN 'bonus' WHEN adjusted_support >= 0.6 THEN 'required' WHEN adjusted_support >= 0.3 THEN 'common' ELSE 'emerging' END AS tier FROM (
                SELECT role, time_window, skill_id, min(window_start) AS window_start, round(sum(adjusted_support * jd_count) / sum(jd_count) + 1e-10::DOUBLE, 6) AS adjusted_support, round(sum(jd_support * jd_count) / sum(jd_count) + 1e-10::DOUBLE, 6) AS jd_support,
                round(sum(company_support * jd_count) / sum(jd_count) + 1e-10::DOUBLE, 6) AS company_support, sum(evidence_count)::BIGINT AS evidence_count, sum(jd_count)::BIGINT AS jd_count, sum(s.company_count)::BIGINT AS company_count, sum(preferred_mentions) AS preferred
                FROM support s JOIN (SELECT role, industry, level, time_window, window_start, jd_count FROM profiles) p USING (role, industry, level, time_window) GROUP BY ALL)))""",
    "skill_dim": """SELECT skill_id, mentions, statuses, competency_category, tech_stack FROM (SELECT skill_id, count(*) AS mentions, string_agg(DISTINCT status, '|' ORDER BY status) AS statuses FROM mentions WHERE NOT starts_with(status, 'REJECTED') GROUP BY ALL)
        JOIN (SELECT skill_id, arg_min(category, (-c, category)) AS competency_category FROM (SELECT skill_id, category, count(*) AS c FROM mentions WHERE NOT starts_with(status, 'REJECTED') GROUP BY ALL) GROUP BY ALL) USING (skill_id)
        JOIN (SELECT skill_id, arg_min(stack, (-c, stack)) AS tech_stack FROM (SELECT skill_id, stack, count(*) AS c FROM mentions WHERE NOT starts_with(status, 'REJECTED') GROUP BY ALL) GROUP BY ALL) USING (skill_id)""",
}


def weighted(spark, d):
    return P.weighted(A.postings(spark, d), template())


def accepted(spark, d):
    return P.accepted(A.mentions(spark, d))


def profiles(spark, d):
    return P.profiles(weighted(spark, d))


def support(spark, d):
    return chain(spark, d)[1]


def chain(spark, d):
    """Profiles and support over postings that are weighted once."""
    rows = written(weighted(spark, d), "weighted")
    return P.profiles(rows), P.support(rows, accepted(spark, d))


def snapshots(spark, d):
    return P.snapshots(*chain(spark, d))


def _time_weight(spark, d):
    return weighted(spark, d).select("jd_id", "time_window", "window_start", F.round("time_weight", 6).alias("time_weight"), "template_size", F.round("template_weight", 6).alias("template_weight"), F.round("base", 6).alias("base"))


def _summary(spark, d):
    p, w = A.postings(spark, d), written(weighted(spark, d), "weighted")
    return P.run_summary(p, w, P.support(w, accepted(spark, d)))


def _refreshed(spark, d, *parts):
    """A state of other postings, updated to these: some are new, some were of another role and time, some are gone."""
    p, m = A.postings(spark, d), A.mentions(spark, d)
    late = F.col("jd_id") % 7 == 0
    moved = F.col("jd_id") % 11 == 0
    stale = p.where(~late).withColumn("role", F.when(moved, "other").otherwise(F.col("role"))).withColumn("posted_at", F.when(moved, F.add_months("posted_at", 14).cast(p.schema["posted_at"].dataType)).otherwise(F.col("posted_at")))
    gone = lambda df: df.where("jd_id % 13 = 0").withColumn("jd_id", -F.col("jd_id") - 1)
    state = I.built(stale.union(gone(p)), m.where(~late).union(gone(m)), template(), parts=parts)
    changed = p.where(late | moved).select("jd_id").union(gone(p).select("jd_id"))
    return I.updated(state, changed, p, m, template())


_COOCCURRENCE = """SELECT * FROM (SELECT source, target, cooccurrence, round(cooccurrence / (a.n + b.n - cooccurrence), 6) AS jaccard_score FROM (SELECT x.skill_id AS source, y.skill_id AS target, count(*) AS cooccurrence FROM accepted x JOIN accepted y ON x.jd_id = y.jd_id AND x.skill_id < y.skill_id GROUP BY ALL HAVING count(*) >= 2)
           JOIN (SELECT skill_id, count(*) AS n FROM accepted GROUP BY ALL) a ON a.skill_id = source JOIN (SELECT skill_id, count(*) AS n FROM accepted GROUP BY ALL) b ON b.skill_id = target) WHERE jaccard_score >= 0.001 ORDER BY jaccard_score DESC, cooccurrence DESC, source, target LIMIT 2000"""

QUERIES = {
    "incremental_support": (lambda s, d: _refreshed(s, d, "support").support, "SELECT * FROM support"),
    "incremental_snapshots": (lambda s, d: I.snapshots(_refreshed(s, d, "support")), "SELECT * FROM snapshots"),
    "incremental_cooccurrence": (lambda s, d: I.cooccurrence(_refreshed(s, d, "pairs"), P.Config(related_score=0.001)), _COOCCURRENCE),
    "role_skill_support": (support, "SELECT * FROM support"),
    "posting_weights": (_time_weight, "SELECT jd_id, time_window, window_start, round(time_weight, 6) AS time_weight, template_size, template_weight, round(base, 6) AS base FROM weighted"),
    "accepted_evidence": (accepted, "SELECT * FROM accepted"),
    "role_dim": (lambda s, d: P.roles(A.postings(s, d)), "SELECT role, count(*) AS document_count, count(DISTINCT company_id) AS company_count, string_agg(DISTINCT industry, '|' ORDER BY industry) AS industries, 'role:' || substr(sha1(role), 1, 16) AS role_id FROM postings GROUP BY role"),
    "role_profiles": (profiles, "SELECT * FROM profiles"),
    "role_skill_snapshots": (snapshots, "SELECT * FROM snapshots"),
    "skill_evolution": (
        lambda s, d: P.evolution(*chain(s, d)),
        """SELECT * FROM (SELECT current_profile_id, previous_profile_id, skill_id, coalesce(a.s, 0) AS current_support, coalesce(b.s, 0) AS previous_support, round(coalesce(a.s, 0) - coalesce(b.s, 0), 6) AS delta,
           CASE WHEN coalesce(a.s, 0) >= 0.2 AND coalesce(b.s, 0) < 0.1 THEN 'ADDED' WHEN coalesce(b.s, 0) >= 0.2 AND coalesce(a.s, 0) < 0.1 THEN 'REMOVED' WHEN round(coalesce(a.s, 0) - coalesce(b.s, 0), 6) >= 0.15 THEN 'STRENGTHENED' WHEN round(coalesce(a.s, 0) - coalesce(b.s, 0), 6) <= -0.15 THEN 'WEAKENED' END AS change_type
           FROM (SELECT p.profile_id AS current_profile_id, p.previous_profile_id, s.skill_id, s.adjusted_support AS s FROM profiles p JOIN support s USING (role, industry, level, time_window) WHERE p.previous_profile_id <> '') a
           FULL JOIN (SELECT p.profile_id AS current_profile_id, p.previous_profile_id, s.skill_id, s.adjusted_support AS s FROM profiles p JOIN profiles q ON p.previous_profile_id = q.profile_id JOIN support s ON q.role = s.role AND q.industry = s.industry AND q.level = s.level AND q.time_window = s.time_window) b
           USING (current_profile_id, previous_profile_id, skill_id)) WHERE change_type IS NOT NULL""",
    ),
    "skill_cooccurrence": (
        lambda s, d: P.cooccurrence(accepted(s, d), P.Config(related_score=0.001)),
        _COOCCURRENCE,
    ),
    "skill_dimension": (lambda s, d: P.skill_dimension(A.mentions(s, d)), "SELECT * FROM skill_dim"),
    "run_summary": (
        _summary,
        """SELECT * FROM (SELECT count(*) AS input_documents, count(DISTINCT role) AS roles, count(DISTINCT company_id) AS companies FROM postings), (SELECT count(*) FILTER (template_size > 1) AS template_documents FROM weighted),
           (SELECT count(*) AS role_skill_edges, count(*) FILTER (tier = 'required') AS tier_required, count(*) FILTER (tier = 'common') AS tier_common, count(*) FILTER (tier = 'emerging') AS tier_emerging, count(*) FILTER (tier = 'bonus') AS tier_bonus FROM support)""",
    ),
}
