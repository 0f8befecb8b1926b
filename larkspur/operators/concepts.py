"""Concepts: candidate groups, adaptive thresholds, scores, quota selection, precedence."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.stats import distinctiveness
from larkspur.session import all_tasks, written


@dataclass(frozen=True)
class Config:
    """Support that a concept needs in a role, as a least count and a share of the role; weights of its score."""

    small_role: int = 100
    small_candidate: float = 0.08
    small_core: float = 0.20
    candidate_jds: int = 8
    candidate_companies: int = 5
    candidate_jd_share: float = 0.001
    candidate_company_share: float = 0.001
    core_jds: int = 15
    core_companies: int = 8
    core_jd_share: float = 0.005
    core_company_share: float = 0.005
    verified: int = 3
    weights: tuple[float, ...] = (0.30, 0.20, 0.20, 0.10, 0.10, 0.10)


def thresholds(jds: int, companies: int, final: bool, c: Config = Config()) -> tuple[int, int]:  # noqa: B008
    """Least postings and companies of a candidate, or of a core concept, in a role of that size."""
    if jds < c.small_role:
        share = c.small_core if final else c.small_candidate
        return max(3 if final else 2, math.ceil(jds * share)), max(2, math.ceil(companies * share))
    if final:
        return max(c.core_jds, math.ceil(jds * c.core_jd_share)), max(c.core_companies, math.ceil(companies * c.core_company_share))
    return max(c.candidate_jds, math.ceil(jds * c.candidate_jd_share)), max(c.candidate_companies, math.ceil(companies * c.candidate_company_share))


def with_thresholds(roles: DataFrame, final: bool, c: Config = Config()) -> DataFrame:  # noqa: B008
    """``roles`` (``jds, companies``) with ``least_jds`` and ``least_companies``."""
    share = c.small_core if final else c.small_candidate
    small = F.col("jds") < c.small_role
    up = lambda col, s, least: F.greatest(F.lit(least).cast("long"), F.ceil(F.col(col) * s).cast("long"))
    big = (c.core_jds, c.core_jd_share, c.core_companies, c.core_company_share) if final else (c.candidate_jds, c.candidate_jd_share, c.candidate_companies, c.candidate_company_share)
    return roles.withColumn("least_jds", F.when(small, up("jds", share, 3 if final else 2)).otherwise(up("jds", big[1], big[0]))).withColumn("least_companies", F.when(small, up("companies", share, 2)).otherwise(up("companies", big[3], big[2])))


def distinct_counts(rows: DataFrame, keys: list[str], counts: dict[str, str], flagged: tuple[str, str, Column], many: tuple[str, ...] = ()) -> DataFrame:
    """``keys`` and for each name in ``counts`` the distinct values of its column; ``flagged`` is a further name, one of the columns, and a condition that a row of a value must meet.

    Each column is made distinct by itself: several distinct counts in one aggregate would
    hold every row once for each of them.  A column of ``many`` values is dealt to all tasks
    of a shuffle, as tasks merged by their compressed size would hold millions of values.
    """
    name, of, condition = flagged
    parts = []
    for own, column in counts.items():
        met = F.max(F.coalesce(condition, F.lit(False))) if column == of else F.lit(False)
        dealt = all_tasks(rows.select(*keys, column), *keys, column) if column in many else rows
        one = dealt.groupBy(*keys, column).agg(met.alias("_met")).groupBy(*keys).agg(F.count(column).alias("_n"), F.count(F.when(F.col("_met"), F.col(column))).alias("_m"))
        parts.append(one.select(*keys, *(F.col("_n" if c == own else "_m") if c == own or (c == name and column == of) else F.lit(0).cast("long").alias(c) for c in (*counts, name))).toDF(*keys, *counts, name))
    every = parts[0]
    for more in parts[1:]:
        every = every.union(more)
    return every.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in (*counts, name)))


def candidate_groups(mentions: DataFrame, postings: DataFrame, roles: bool = True) -> DataFrame:
    """Skills by category: distinct postings, companies, roles (if asked for), and postings with verified evidence."""
    rows = all_tasks(mentions.where(~F.col("status").startswith("REJECTED")).select("skill_id", "category", "jd_id", "status"), "jd_id").join(postings.select("jd_id", "company_id", "role"), "jd_id")
    counts = {"jds": "jd_id", "companies": "company_id"} | ({"roles": "role"} if roles else {})
    return distinct_counts(rows, ["skill_id", "category"], counts, ("verified_jds", "jd_id", F.col("status") == "VERIFIED"), ("company_id",))


def harmonized(groups: DataFrame) -> DataFrame:
    """One category for each skill: that with most verified postings, postings, companies, then the first by name."""
    best = F.max_by("category", F.struct("verified_jds", "jds", "companies", F.col("category").alias("c")))
    return groups.groupBy("skill_id").agg(best.alias("category"), F.count("*").alias("variants"))


def role_totals(postings: DataFrame) -> DataFrame:
    return postings.groupBy("role").agg(F.count("*").alias("jds"), F.countDistinct("company_id").alias("companies"))


def role_scores(accepted: DataFrame, weighted: DataFrame, c: Config = Config()) -> DataFrame:  # noqa: B008
    """Score of each skill in each role from coverage by company and posting, distinctiveness, requirement, evidence and recency.

    A posting counts once for a skill, with its most confident mention.  Skills below the
    role's thresholds are left out after the distinctiveness is counted.
    """
    weighted = written(weighted.select("jd_id", "company_id", "role", "base"), "weighted")
    votes = accepted.join(weighted.select("jd_id", "company_id", "role", "base"), "jd_id")
    agg = votes.groupBy("role", "skill_id").agg(
        F.countDistinct("company_id").alias("company_count"), F.count("*").alias("jd_count"), F.count(F.when(F.col("status") == "VERIFIED", 1)).alias("verified_jd_count"),
        F.sum(F.when(F.col("requirement") == "required", 1.0).otherwise(0.4)).alias("rs"), F.sum("confidence").alias("es"), F.sum("base").alias("ts"),
    )
    agg = written(agg, "role-skills")  # read twice, of other columns each time: Spark would go through the mentions twice
    spread = agg.groupBy("skill_id").agg(F.count("*").alias("roles_with"))
    totals = with_thresholds(role_totals(weighted), True, c)
    n = totals.agg(F.count("*").alias("role_count"))  # one row
    rows = agg.join(spread, "skill_id").join(totals, "role").crossJoin(F.broadcast(n))
    rows = rows.where((F.col("jd_count") >= F.col("least_jds")) & (F.col("company_count") >= F.col("least_companies")) & (F.col("verified_jd_count") >= F.least(F.lit(c.verified), F.col("least_jds"))))
    parts = [F.col("company_count") / F.col("companies"), F.col("jd_count") / F.col("jds"), distinctiveness(F.col("role_count"), F.col("roles_with")), F.col("rs") / F.col("jd_count"), F.col("es") / F.col("jd_count"), F.col("ts") / F.col("jd_count")]
    score = sum((p * w for p, w in zip(parts[1:], c.weights[1:], strict=True)), parts[0] * c.weights[0])
    return rows.select("role", "skill_id", "company_count", "jd_count", "verified_jd_count", F.round(score + 1e-10, 6).alias("final_score"))


def quota_top(df: DataFrame, role: str, category: str, score: str, item: str, quotas: dict[str, int], otherwise: int = 0) -> DataFrame:
    """The best items of each role and category, as many as the category's quota."""
    quota = F.lit(otherwise)
    for name, n in quotas.items():
        quota = F.when(F.col(category) == name, n).otherwise(quota)
    w = Window.partitionBy(role, category).orderBy(F.col(score).desc(), item)
    return df.withColumn("concept_rank", F.row_number().over(w).cast("long")).where(F.col("concept_rank") <= quota)


def quarter_snapshot(accepted: DataFrame, weighted: DataFrame) -> DataFrame:
    """Role by quarter by skill: 0.55 company share, 0.30 posting share, 0.15 mean confidence; with the trend against the role's previous quarter."""
    rows = accepted.join(weighted.select("jd_id", "company_id", "role", "time_window", "window_start"), "jd_id")
    total = weighted.groupBy("role", "time_window", "window_start").agg(F.count("*").alias("jds"), F.countDistinct("company_id").alias("companies"))
    total = total.withColumn("place", F.row_number().over(Window.partitionBy("role").orderBy("window_start")).cast("long"))
    own = rows.groupBy("role", "time_window", "skill_id").agg(F.count("*").alias("jd_count"), F.countDistinct("company_id").alias("company_count"), F.count(F.when(F.col("status") == "VERIFIED", 1)).alias("verified_jd_count"), F.avg("confidence").alias("confidence")).join(total, ["role", "time_window"])
    score = F.round(0.55 * F.col("company_count") / F.col("companies") + 0.30 * F.col("jd_count") / F.col("jds") + 0.15 * F.col("confidence") + 1e-10, 6)
    own = own.withColumn("final_score", score)
    before = own.select("role", "skill_id", (F.col("place") + 1).alias("place"), F.col("final_score").alias("previous"))
    out = own.join(before, ["role", "skill_id", "place"], "left")
    delta = F.round(F.col("final_score") - F.col("previous"), 6)
    trend = F.when(F.col("previous").isNull(), "emerging").when(delta >= 0.05, "rising").when(delta <= -0.05, "falling").otherwise("stable")
    return out.select("role", "time_window", "skill_id", "jd_count", "company_count", "verified_jd_count", "final_score", F.coalesce(delta, F.lit(0.0)).alias("delta"), trend.alias("trend"))


def status_of(companies: Column, jds: Column, verified: Column, members: Column, registered: Column) -> Column:
    """STANDARD for registered concepts, STANDARD_CANDIDATE with enough support, else by the number of members."""
    rate = verified / F.greatest(F.lit(1), jds)
    return F.when(registered, "STANDARD").when((companies >= 20) & (jds >= 30) & (rate >= 0.6), "STANDARD_CANDIDATE").when(members > 1, "AUTO_CLUSTER").otherwise("CANDIDATE")


def by_precedence(base: DataFrame, sources: list[tuple[str, DataFrame]], key: str, value: str) -> DataFrame:
    """``value`` from the first source that has it, and which one that is."""
    out, names = base, []
    for name, df in sources:
        out = out.join(df.select(key, F.col(value).alias(f"_{name}")), key, "left")
        names.append(name)
    source = F.lit(None).cast("string")
    for name in reversed(names):
        source = F.when(F.col(f"_{name}").isNotNull(), name).otherwise(source)
    return out.withColumn(value, F.coalesce(*(F.col(f"_{n}") for n in names))).withColumn(f"{value}_source", source).drop(*(f"_{n}" for n in names))


def complete_mapping(rows: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """``problem, keys``: keys without a mapping, and with several."""
    missing = rows.select(key).distinct().join(mapping, key, "left_anti").agg(F.count("*").alias("keys")).select(F.lit("missing").alias("problem"), "keys")
    twice = mapping.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("keys")).select(F.lit("repeated").alias("problem"), "keys")
    return missing.union(twice)


def approved(df: DataFrame, pairs: set[tuple[str, str]], match: str = "match_type", status: str = "status") -> DataFrame:
    """Rows whose match type and status are one of the allowed pairs."""
    if not pairs:
        return df.limit(0)
    allowed = F.lit(False)
    for m, s in sorted(pairs):
        allowed = allowed | ((F.col(match) == m) & (F.col(status) == s))
    return df.where(allowed)


def normalization_status(rows: DataFrame, key: str, mapped: Column) -> DataFrame:
    """``key, status``: all rows mapped to a concept, none, or some."""
    flags = rows.groupBy(key).agg(F.bool_or(mapped).alias("_yes"), F.bool_or(~mapped).alias("_no"))
    status = F.when(F.col("_yes") & F.col("_no"), "MIXED_STANDARDIZED_AND_RAW").when(F.col("_yes"), "STANDARDIZED_CONCEPT").otherwise("RAW_SKILL_FALLBACK")
    return flags.select(key, status.alias("status"))


def with_top_skills(registry: DataFrame, role_skills: DataFrame, role: str, skill: str, score: str, most: int = 20) -> DataFrame:
    """``registry`` with ``skills``, each role's ``most`` best in order; roles without any have an empty list."""
    w = Window.partitionBy(role).orderBy(F.col(score).desc(), skill)
    top = role_skills.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    lists = top.groupBy(role).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", skill))), lambda x: x[skill]).alias("skills"))
    return registry.join(lists, role, "left").withColumn("skills", F.coalesce("skills", F.array().cast("array<string>")))


def corrected(df: DataFrame, column: str, rules: list[tuple[str, Column, str]]) -> DataFrame:
    """``df`` with ``column`` set by the first rule (``reason, applies, value``) that applies, the old value in ``<column>_before`` and ``reason``."""
    value, reason = F.col(column), F.lit(None).cast("string")
    for name, applies, new in reversed(rules):
        yes = F.coalesce(applies, F.lit(False)) & (F.col(column) != new)
        value, reason = F.when(yes, new).otherwise(value), F.when(yes, name).otherwise(reason)
    return df.select("*", F.col(column).alias(f"{column}_before"), value.alias("_new"), reason.alias("reason")).withColumn(column, F.col("_new")).drop("_new")


def registry_of(decisions: DataFrame, name: str, alias: str, approved: Column) -> DataFrame:
    """``name, aliases, decisions`` of the approved decisions: a registry of controlled names, each with its distinct other names."""
    rows = decisions.where(approved)
    other = F.when(F.col(alias) != F.col(name), F.col(alias))
    return rows.groupBy(name).agg(F.array_sort(F.collect_set(other)).alias("aliases"), F.count("*").alias("decisions"))
