"""Queries of ``operators.evolution`` with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import stats
from larkspur.operators import evolution as E
from larkspur.plans import adapters as A
from larkspur.plans.adapters import CTES

CTES |= {
    "records": """SELECT *, location || '/' || level AS title, strftime(posted_at, '%Y-%m') AS month, CASE WHEN posted_at >= (SELECT max(posted_at) FROM postings) - INTERVAL 365 DAY THEN 'current' WHEN posted_at >= (SELECT max(posted_at) FROM postings) - INTERVAL 1095 DAY THEN 'baseline' ELSE 'historical' END AS period FROM postings""",
    "jd_skills": "SELECT DISTINCT jd_id, skill_id FROM mentions WHERE status = 'VERIFIED' OR status = 'LOW_CONFIDENCE'",
    "effects": """SELECT role, skill_id, x1, n1, x2, n2, baseline_jd_count, current_jd_count, x1 / n1 AS baseline_coverage, x2 / n2 AS current_coverage, x2 / n2 - x1 / n1 AS delta,
        greatest(0::DOUBLE, (x1 / n1 + Z2 / (2 * n1)) / (1 + Z2 / n1) - Z1 * sqrt(x1 / n1 * (1 - x1 / n1) / n1 + Z2 / (4::DOUBLE * n1 * n1)) / (1 + Z2 / n1)) AS baseline_low, least(1::DOUBLE, (x1 / n1 + Z2 / (2 * n1)) / (1 + Z2 / n1) + Z1 * sqrt(x1 / n1 * (1 - x1 / n1) / n1 + Z2 / (4::DOUBLE * n1 * n1)) / (1 + Z2 / n1)) AS baseline_high,
        greatest(0::DOUBLE, (x2 / n2 + Z2 / (2 * n2)) / (1 + Z2 / n2) - Z1 * sqrt(x2 / n2 * (1 - x2 / n2) / n2 + Z2 / (4::DOUBLE * n2 * n2)) / (1 + Z2 / n2)) AS current_low, least(1::DOUBLE, (x2 / n2 + Z2 / (2 * n2)) / (1 + Z2 / n2) + Z1 * sqrt(x2 / n2 * (1 - x2 / n2) / n2 + Z2 / (4::DOUBLE * n2 * n2)) / (1 + Z2 / n2)) AS current_high,
        (x2 / n2 - x1 / n1) / sqrt((x1 + x2) / (n1 + n2) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2)) AS z
        FROM (SELECT r.role, skill_id, count(DISTINCT company_id) FILTER (period = 'baseline') AS x1, count(DISTINCT company_id) FILTER (period = 'current') AS x2, count(DISTINCT company_id) AS companies, count(*) FILTER (period = 'baseline') AS baseline_jd_count, count(*) FILTER (period = 'current') AS current_jd_count
            FROM records r JOIN jd_skills USING (jd_id) WHERE period <> 'historical' GROUP BY ALL)
        JOIN (SELECT role, count(DISTINCT company_id) FILTER (period = 'baseline') AS n1, count(DISTINCT company_id) FILTER (period = 'current') AS n2 FROM records GROUP BY role) USING (role) WHERE n1 >= 20 AND n2 >= 20 AND companies >= 3""".replace("Z2", repr(stats.Z95**2) + "::DOUBLE").replace("Z1", repr(stats.Z95) + "::DOUBLE"),
    "vectors": """SELECT period, role, skill_id, c / n AS weight FROM (SELECT *, row_number() OVER (PARTITION BY period, role ORDER BY c DESC, skill_id) AS k FROM (SELECT period, role, skill_id, count(DISTINCT company_id) AS c FROM records JOIN jd_skills USING (jd_id) GROUP BY ALL) JOIN (SELECT period, role, count(DISTINCT company_id) AS n FROM records GROUP BY ALL) USING (period, role)) WHERE k <= 15""",
    "trend": """SELECT title, month, sources, jds, rate, companies FROM (SELECT title, month, count(*) AS sources, sum(jds)::BIGINT AS jds, round(avg(c / market), 9) AS rate FROM (SELECT title, month, source_family, count(DISTINCT company_id) AS c, count(*) AS jds FROM records GROUP BY ALL) JOIN (SELECT month, source_family, count(DISTINCT company_id) AS market FROM records GROUP BY ALL) USING (month, source_family) GROUP BY ALL)
        JOIN (SELECT title, month, count(DISTINCT company_id) AS companies FROM records GROUP BY ALL) USING (title, month)""",
    "title_counts": "SELECT title, "
    + ", ".join(f"count(DISTINCT {c}) FILTER (period = '{p}') AS {p}_{n}" for p in ("historical", "baseline", "current") for c, n in (("jd_id", "jds"), ("company_id", "companies")))
    + ", count(DISTINCT floor(salary / 500)) FILTER (period = 'current') AS current_templates, count(DISTINCT month) FILTER (period = 'current') AS current_months, count(DISTINCT source_family) FILTER (period = 'current') AS current_sources FROM records GROUP BY title",
    "title_roles": "SELECT title, arg_min(role, (-c, role)) AS dominant_role FROM (SELECT title, role, count(*) AS c FROM records GROUP BY ALL) GROUP BY title",
}


def _jsd(keys: str, column: str) -> str:
    """Rounded divergence of ``column`` by ``keys``."""
    return f"""SELECT {keys}, round(coalesce(sum(CASE WHEN p > 0 THEN 0.5 * p * log2(p / m) ELSE 0 END + CASE WHEN q > 0 THEN 0.5 * q * log2(q / m) ELSE 0 END), 0), 6) AS divergence FROM (SELECT *, (p + q) / 2 AS m FROM (
        SELECT {keys}, b / sum(b) OVER (PARTITION BY {keys}) AS p, c / sum(c) OVER (PARTITION BY {keys}) AS q FROM (SELECT {keys}, {column}, count(*) FILTER (period = 'baseline') AS b, count(*) FILTER (period = 'current') AS c FROM records GROUP BY ALL))) GROUP BY {keys}"""


def records(s, d):
    return E.with_period(A.postings(s, d).withColumn("title", F.concat_ws("/", "location", "level")))


def jd_skills(s, d):
    return A.mentions(s, d).where(F.col("status").isin("VERIFIED", "LOW_CONFIDENCE")).select("jd_id", "skill_id").distinct()


def effects(s, d):
    return E.skill_effects(records(s, d), jd_skills(s, d))


def _rounded(df, *columns):
    return df.select(*(F.round(c, 6).alias(c) if c in columns else F.col(c) for c in df.columns))


#: Wide enough that invented data shows changes.
LOOSE = E.Config(q=0.5, delta=0.005)
_REAL = ("baseline_coverage", "current_coverage", "delta", "baseline_low", "baseline_high", "current_low", "current_high", "z")


def _bh(s, d):
    p = F.round(F.exp(-F.col("z") * F.col("z") / 2), 9)
    return _rounded(stats.bh_qvalues(effects(s, d).select("role", "skill_id", p.alias("p_value")), ["role"], "p_value", ["skill_id"]), "q_value")


def _jaccard(s, d):
    r, k = records(s, d), jd_skills(s, d)
    return _rounded(stats.weighted_jaccard(E.role_vectors(r, k, "baseline"), E.role_vectors(r, k, "current"), ["role"], "skill_id", "weight"), "similarity")


def titles(s, d):
    return E.title_stats(records(s, d), F.floor(F.col("salary") / 500))


def _essential(s, d):
    r = records(s, d).where("period = 'current'")
    total = r.groupBy("role").agg(F.countDistinct("company_id").alias("total"))
    c = r.join(jd_skills(s, d), "jd_id").groupBy("role", "skill_id").agg(F.countDistinct("company_id").alias("companies"))
    return E.essential_or_bonus(c.join(total, "role"))


QUERIES = {
    "period_buckets": (lambda s, d: records(s, d).select("jd_id", "period", "month", "title"), "SELECT jd_id, period, month, title FROM records"),
    "period_coverage": (lambda s, d: E.coverage(records(s, d)), "SELECT role, period, count(DISTINCT company_id) AS companies, count(*) AS jds FROM records GROUP BY ALL"),
    "skill_effects": (lambda s, d: _rounded(effects(s, d), *_REAL), "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in _REAL) + ") FROM effects"),
    "skill_changes": (lambda s, d: E.skill_changes(effects(s, d), LOOSE), None),
    "review_budget": (lambda s, d: E.prioritized(E.skill_changes(effects(s, d), LOOSE), 50), None),
    "bh_qvalues": (
        _bh,
        """SELECT role, skill_id, p_value, round(least(1::DOUBLE, min(p_value * n / k) OVER (PARTITION BY role ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS q_value FROM (
           SELECT *, row_number() OVER (PARTITION BY role ORDER BY p_value, skill_id) AS k, count(*) OVER (PARTITION BY role) AS n FROM (SELECT role, skill_id, round(exp(-z * z / 2), 9) AS p_value FROM effects))""",
    ),
    "role_vectors": (lambda s, d: _rounded(E.role_vectors(records(s, d), jd_skills(s, d), "baseline"), "weight"), "SELECT role, skill_id, round(weight, 6) AS weight FROM vectors WHERE period = 'baseline'"),
    "weighted_jaccard": (
        _jaccard,
        """SELECT role, round(sum(least(coalesce(a.weight, 0), coalesce(b.weight, 0))) / sum(greatest(coalesce(a.weight, 0), coalesce(b.weight, 0))), 6) AS similarity FROM (SELECT * FROM vectors WHERE period = 'baseline') a FULL JOIN (SELECT * FROM vectors WHERE period = 'current') b USING (role, skill_id) GROUP BY role""",
    ),
    "js_divergence": (lambda s, d: _rounded(E.drift(records(s, d), ["role"], "source_family"), "divergence"), _jsd("role", "source_family")),
    "source_normalized_trend": (lambda s, d: E.monthly_trend(records(s, d), "title"), "SELECT * FROM trend"),
    "month_runs": (
        lambda s, d: E.longest_runs(E.monthly_trend(records(s, d), "title"), "title"),
        """SELECT * FROM (SELECT title, max(n) AS continuous_windows FROM (SELECT title, island, count(*) AS n FROM (SELECT title, m - row_number() OVER (PARTITION BY title ORDER BY m) AS island FROM (SELECT *, substr(month, 1, 4)::INT * 12 + substr(month, 6, 2)::INT AS m FROM trend WHERE companies >= 2)) GROUP BY ALL) GROUP BY ALL)
           JOIN (SELECT title, max(n) AS growth_windows FROM (SELECT title, g, count(*) AS n FROM (SELECT title, sum(r) OVER (PARTITION BY title ORDER BY m ROWS UNBOUNDED PRECEDING) AS g FROM (
             SELECT title, m, CASE WHEN lag(m) OVER w = m - 1 AND (companies > lag(companies) OVER w OR rate > lag(rate) OVER w + 1e-12::DOUBLE) THEN 0 ELSE 1 END AS r FROM (SELECT *, substr(month, 1, 4)::INT * 12 + substr(month, 6, 2)::INT AS m FROM trend WHERE companies >= 2) WINDOW w AS (PARTITION BY title ORDER BY m))) GROUP BY ALL) GROUP BY ALL) USING (title)""",
    ),
    "title_stats": (titles, "SELECT * FROM title_counts JOIN title_roles USING (title)"),
    "new_titles": (
        lambda s, d: E.new_titles(E.title_stats(records(s, d).withColumn("title", F.concat_ws("/", "location", "company_name")), F.floor(F.col("salary") / 500)), companies=1).select("title", "current_jds", "current_templates", "dominant_role"),
        """SELECT title, current_jds, current_templates, dominant_role FROM (SELECT location || '/' || company_name AS title, count(DISTINCT jd_id) FILTER (period <> 'current') AS before, count(DISTINCT jd_id) FILTER (period = 'current') AS current_jds, count(DISTINCT floor(salary / 500)) FILTER (period = 'current') AS current_templates FROM records GROUP BY 1)
           JOIN (SELECT title, arg_min(role, (-c, role)) AS dominant_role FROM (SELECT location || '/' || company_name AS title, role, count(*) AS c FROM records GROUP BY ALL) GROUP BY title) USING (title) WHERE before = 0 AND current_jds >= 2 AND current_templates >= 2""",
    ),
    "evidence_by_company": (
        lambda s, d: E.first_by_company(records(s, d).where("period = 'current'"), ["role"], ["posted_at", "jd_id"]).select("role", "company_id", "jd_id", "evidence_rank"),
        """SELECT * FROM (SELECT role, company_id, jd_id, row_number() OVER (PARTITION BY role ORDER BY company_id, posted_at, jd_id) AS evidence_rank FROM (SELECT *, row_number() OVER (PARTITION BY role, company_id ORDER BY posted_at, jd_id) AS k FROM records WHERE period = 'current') WHERE k = 1) WHERE evidence_rank <= 5""",
    ),
    "essential_skills": (
        _essential,
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role, kind ORDER BY companies DESC, skill_id) AS kind_rank FROM (SELECT role, skill_id, companies, total, CASE WHEN companies >= greatest(2, ceil(total * 0.5)) THEN 'essential' ELSE 'bonus' END AS kind FROM (SELECT role, skill_id, count(DISTINCT company_id) AS companies FROM records JOIN jd_skills USING (jd_id) WHERE period = 'current' GROUP BY ALL) JOIN (SELECT role, count(DISTINCT company_id) AS total FROM records WHERE period = 'current' GROUP BY role) USING (role))) WHERE kind_rank <= 8""",
    ),
    "stratified_sample": (
        lambda s, d: E.stratified_sample(A.postings(s, d).select("jd_id", "role"), "role", "jd_id", 40, 300),
        "SELECT jd_id, role FROM (SELECT *, sha256(jd_id::VARCHAR) AS h, row_number() OVER (PARTITION BY role ORDER BY sha256(jd_id::VARCHAR), jd_id) AS k FROM postings) ORDER BY CASE WHEN k <= 40 THEN 0 ELSE 1 END, h, jd_id LIMIT 300",
    ),
    "quality_report": (
        lambda s, d: E.quality_report(A.postings(s, d), records(s, d)),
        f"""SELECT a.*, b.*, x.divergence AS source_family_divergence, y.divergence AS industry_divergence, x.divergence > 0.2 OR y.divergence > 0.2 AS drift_warning FROM (SELECT count(*) AS database_jds, count(posted_at) AS valid_date_jds FROM postings) a,
           (SELECT {", ".join(f"count(*) FILTER (period = '{p}') AS {p}_jds, count(DISTINCT company_id) FILTER (period = '{p}') AS {p}_companies" for p in ("historical", "baseline", "current"))} FROM records) b, (SELECT divergence FROM ({_jsd("1 + 0 * length('a')", "source_family").replace("1 + 0 * length('a')", "domain_")})) x, (SELECT divergence FROM ({_jsd("domain_", "industry")})) y""".replace("FROM records GROUP BY ALL", "FROM (SELECT *, 1 AS domain_ FROM records) GROUP BY ALL"),
    ),
}
