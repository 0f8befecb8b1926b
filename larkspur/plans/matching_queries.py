"""Queries of ``operators.matching`` with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import evolution as E
from larkspur.operators import matching as M
from larkspur.operators import serve as S
from larkspur.plans import adapters as A
from larkspur.plans import evolution_queries as EQ


def _skills(s, d):
    return A.table(s, d, "part").select(F.col("p_name").alias("skill")).distinct()


def _named(s, d):
    return _skills(s, d).withColumn("name", F.col("skill"))


def _guard(s, d):
    a, b = _skills(s, d).withColumnRenamed("skill", "a"), _skills(s, d).withColumnRenamed("skill", "b")
    pairs = a.join(F.broadcast(b), F.col("a") < F.col("b"))  # 64 names, whatever the scale
    return pairs.select("a", "b", M.shared_ascii_token(F.col("a"), F.col("b")).alias("shared"), M.meaningful_overlap(F.col("a"), F.col("b")).alias("overlap"), M.merge_allowed(F.col("a"), F.col("b"), F.lit(0.0), 0.5).alias("allowed"))


def _nearest_roles(s, d):
    r, k = EQ.records(s, d), EQ.jd_skills(s, d)
    by_segment = r.withColumn("role", F.col("industry"))
    return M.nearest_roles(E.role_vectors(by_segment, k, "current").withColumnRenamed("role", "candidate"), E.role_vectors(r, k, "baseline"), ("candidate", "role"))


def _representatives(s, d):
    counts = A.postings(s, d).groupBy("industry", "location").agg(F.countDistinct("company_id").alias("companies"), F.count("*").alias("jds"))
    return M.representative(counts, "industry", "location", ["companies", "jds"])


def _gates(s, d):
    rows = A.postings(s, d).groupBy("location").agg(F.count("*").alias("jds"), F.countDistinct("company_id").alias("companies"))
    return M.gates(rows, {"jds": F.col("jds") >= 600, "companies": F.col("companies") >= 60}).select("location", F.array_join("failed", ",").alias("failed"), "passed")


def _suggestions(s, d):
    rows = A.postings(s, d).groupBy("location").agg(F.count("*").alias("jds"), F.round(F.avg("salary") / 400000, 6).alias("score"))
    name = F.col("location")
    return rows.select("location", M.suggestion(name == "CHINA", name == "INDIA", name == "PERU", name.startswith("U"), F.col("score"), F.lit(0.8), F.col("jds") >= 600, 0.66, 0.64).alias("decision"))


QUERIES = {
    "merge_guard": (
        _guard,
        """SELECT a, b, len(list_intersect(x, y)) > 0 AS shared, contains(na, nb) OR contains(nb, na) OR len(list_intersect(list_transform(range(1, length(na)), lambda i: substr(na, i::INT, 2)), list_transform(range(1, length(nb)), lambda i: substr(nb, i::INT, 2)))) > 0 AS overlap, contains(na, nb) OR contains(nb, na) OR len(list_intersect(x, y)) > 0 AS allowed FROM (
           SELECT p.s AS a, q.s AS b, regexp_extract_all(lower(p.s), '[a-z][a-z0-9+#.]+') AS x, regexp_extract_all(lower(q.s), '[a-z][a-z0-9+#.]+') AS y, replace(lower(p.s), ' ', '') AS na, replace(lower(q.s), ' ', '') AS nb FROM (SELECT DISTINCT p_name AS s FROM part) p, (SELECT DISTINCT p_name AS s FROM part) q WHERE p.s < q.s)""",
    ),
    "nearest_skills": (lambda s, d: M.nearest_names(_named(s, d), _named(s, d), "skill", "name", 5), None),
    "nearest_roles": (_nearest_roles, None),
    "title_relevance": (lambda s, d: A.table(s, d, "part").select("p_partkey", F.round(M.title_relevance("p_name", "p_type"), 6).alias("relevance")), None),
    "representatives": (
        _representatives,
        "SELECT industry, arg_max(location, (companies, jds, -length(location))) AS location FROM (SELECT industry, location, count(DISTINCT company_id) AS companies, count(*) AS jds FROM postings GROUP BY ALL ORDER BY location) GROUP BY industry",
    ),
    "support_gates": (
        _gates,
        "SELECT location, concat_ws(',', CASE WHEN jds < 600 THEN 'jds' END, CASE WHEN companies < 60 THEN 'companies' END) AS failed, jds >= 600 AND companies >= 60 AS passed FROM (SELECT location, count(*) AS jds, count(DISTINCT company_id) AS companies FROM postings GROUP BY location)",
    ),
    "concept_suggestions": (
        _suggestions,
        "SELECT location, CASE WHEN location = 'CHINA' THEN 'EXISTING_ROLE' WHEN location = 'INDIA' THEN 'ALIAS' WHEN location = 'PERU' THEN 'INSUFFICIENT_INFO' WHEN starts_with(location, 'U') THEN 'NON_IT' WHEN score >= 0.66 THEN 'ALIAS' WHEN score >= 0.64 THEN 'SUBROLE_OF' WHEN jds >= 600 THEN 'NEW_ROLE_CANDIDATE' ELSE 'INSUFFICIENT_INFO' END AS decision FROM (SELECT location, count(*) AS jds, round(avg(salary) / 400000, 6) AS score FROM postings GROUP BY location)",
    ),
    "reason_histogram": (
        lambda s, d: S.top_values(A.mentions(s, d).where("status != 'VERIFIED'"), ["status"], "category", 30),
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY amount DESC, category) AS value_rank FROM (SELECT status, category, count(*) AS amount FROM mentions WHERE status <> 'VERIFIED' GROUP BY ALL)) WHERE value_rank <= 30",
    ),
}
