"""Evolution mining: periods, skill changes with tests, monthly trends, new titles, data quality.

Records are postings with ``jd_id, role, company_id, posted_at, title, source_family, industry``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import stats
from larkspur.functions.text import month_index, month_label


@dataclass(frozen=True)
class Config:
    current_days: int = 365
    baseline_days: int = 730
    role_companies: int = 20
    review_companies: int = 3
    confirm_companies: int = 5
    coverage: float = 0.02
    confirm_coverage: float = 0.05
    delta: float = 0.02
    q: float = 0.05
    month_companies: int = 2
    drift: float = 0.20


def with_period(postings: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """``period`` current, baseline or historical, counted back from the newest posting; rows without a date, role, company or title go."""
    kept = postings.where("posted_at is not null and coalesce(role, '') != '' and company_id is not null and coalesce(title, '') != ''")
    newest = kept.agg(F.max("posted_at").alias("as_of"))  # one row
    cutoff = F.expr(f"as_of - interval {config.current_days} days")
    start = F.expr(f"as_of - interval {config.current_days + config.baseline_days} days")
    period = F.when(F.col("posted_at") >= cutoff, "current").when(F.col("posted_at") >= start, "baseline").otherwise("historical")
    return kept.crossJoin(F.broadcast(newest)).withColumn("period", period).withColumn("month", month_label(F.col("posted_at"))).drop("as_of")


def coverage(records: DataFrame) -> DataFrame:
    return records.groupBy("role", "period").agg(F.countDistinct("company_id").alias("companies"), F.count("*").alias("jds"))


def skill_effects(records: DataFrame, skills: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Share of a role's companies that name a skill, before and now, with intervals and z score.

    ``skills`` has ``jd_id, skill_id``, each pair once.  A company is one row per role and
    skill after the first aggregation, so all later counts are plain sums.
    """
    window = records.where("period in ('baseline', 'current')")
    flag = lambda p: F.max(F.when(F.col("period") == p, 1).otherwise(0)).alias(p)
    jds = lambda p: F.count(F.when(F.col("period") == p, 1)).alias(f"{p}_jds")
    roles = window.groupBy("role", "company_id").agg(flag("baseline"), flag("current")).groupBy("role").agg(F.sum("baseline").alias("n1"), F.sum("current").alias("n2"))
    hits = window.join(skills, "jd_id").groupBy("role", "skill_id", "company_id").agg(flag("baseline"), flag("current"), jds("baseline"), jds("current"))
    out = hits.groupBy("role", "skill_id").agg(F.sum("baseline").alias("x1"), F.sum("current").alias("x2"), F.count("*").alias("companies"), F.sum("baseline_jds").alias("baseline_jd_count"), F.sum("current_jds").alias("current_jd_count"))
    out = out.join(roles, "role").where((F.col("n1") >= config.role_companies) & (F.col("n2") >= config.role_companies) & (F.col("companies") >= config.review_companies))
    x1, n1, x2, n2 = (F.col(c) for c in ("x1", "n1", "x2", "n2"))
    lo1, hi1 = stats.wilson(x1, n1)
    lo2, hi2 = stats.wilson(x2, n2)
    return out.select("role", "skill_id", "x1", "n1", "x2", "n2", "baseline_jd_count", "current_jd_count", (x1 / n1).alias("baseline_coverage"), (x2 / n2).alias("current_coverage"), (x2 / n2 - x1 / n1).alias("delta"), lo1.alias("baseline_low"), hi1.alias("baseline_high"), lo2.alias("current_low"), hi2.alias("current_high"), stats.z_score(x1, n1, x2, n2).alias("z"))


def skill_changes(effects: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """The decision table over tested effects; q values are by role.

    Small effects stay in the family with p = 1 and never reach the UDF: their rows are
    a branch of their own, since a condition around a UDF doesn't keep it from running.
    """
    large = F.abs("delta") >= config.delta
    tested = effects.where(large).withColumn("t", stats.compare_proportions("x1", "n1", "x2", "n2")).select(*effects.columns, "t.test", "t.p_value")
    rest = effects.where(~large).withColumn("test", F.lit("effect_size_prefilter")).withColumn("p_value", F.lit(1.0))
    rows = stats.bh_qvalues(tested.unionByName(rest), ["role"], "p_value", ["skill_id"])
    x1, x2, d, q = F.col("x1"), F.col("x2"), F.col("delta"), F.col("q_value")
    sure = q <= config.q
    kind = (
        F.when((x1 == 0) & (x2 >= config.review_companies) & (F.col("current_coverage") >= config.coverage) & (d >= config.delta), "ADDED_CANDIDATE")
        .when((x1 > 0) & (x2 > 0) & (d >= config.delta) & sure, "INCREASED")
        .when((x1 > 0) & (x2 > 0) & (d <= -config.delta) & sure, "DECREASED")
        .when((x2 == 0) & (x1 >= config.review_companies) & (F.col("baseline_coverage") >= config.coverage), "MISSING_WATCH")
    )
    state = F.when((F.col("change_type") == "ADDED_CANDIDATE") & ~sure, "WATCH").otherwise("REVIEW")
    added = (F.col("change_type") == "ADDED_CANDIDATE") & (x2 >= config.confirm_companies) & (F.col("current_coverage") >= config.confirm_coverage)
    ready = sure & (added | F.col("change_type").isin("INCREASED", "DECREASED"))
    return rows.withColumn("change_type", kind).where("change_type is not null").withColumn("rule_state", state).withColumn("confirmation_eligible", ready)


def role_vectors(records: DataFrame, skills: DataFrame, period: str, top: int = 15) -> DataFrame:
    """``role, skill_id, weight``: share of the role's companies in a period, the strongest skills."""
    rows = records.where(F.col("period") == period)
    total = rows.groupBy("role").agg(F.countDistinct("company_id").alias("n"))
    hits = rows.join(skills, "jd_id").groupBy("role", "skill_id").agg(F.countDistinct("company_id").alias("c")).join(total, "role")
    w = Window.partitionBy("role").orderBy(F.col("c").desc(), "skill_id")
    return hits.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= top).select("role", "skill_id", (F.col("c") / F.col("n")).alias("weight"))


def drift(records: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Jensen-Shannon divergence of ``column`` between baseline and current, for each of ``keys``."""
    counts = records.groupBy(*keys, column).agg(*(F.count(F.when(F.col("period") == p, 1)).alias(p) for p in ("baseline", "current")))
    return stats.js_divergence(counts, keys, "baseline", "current")


def monthly_trend(records: DataFrame, key: str) -> DataFrame:
    """For each ``key`` and month: companies, postings, and the company rate, normalized within each source and averaged over the sources."""
    market = records.groupBy("month", "source_family").agg(F.countDistinct("company_id").alias("market"))
    own = records.groupBy(key, "month", "source_family").agg(F.countDistinct("company_id").alias("companies"), F.count("*").alias("jds"))
    rate = F.avg(F.col("companies") / F.col("market"))
    by_source = own.join(market, ["month", "source_family"]).groupBy(key, "month").agg(F.count("*").alias("sources"), F.sum("jds").alias("jds"), F.round(rate, 9).alias("rate"))
    companies = records.groupBy(key, "month").agg(F.countDistinct("company_id").alias("companies"))
    return by_source.join(companies, [key, "month"])


def closed_month(month: Column, start: Column, end: Column) -> Column:
    """Whether a whole ``yyyy-MM`` month lies within the window."""
    first = F.to_date(F.concat(month, F.lit("-01")))
    return (first >= F.to_date(start)) & (F.last_day(first) <= F.to_date(end))


def longest_runs(trend: DataFrame, key: str, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Longest runs of consecutive months, and of growth in companies or rate, among months with enough companies.

    A growth run counts the month that it starts from.
    """
    w = Window.partitionBy(key).orderBy("m")
    rows = trend.where(F.col("companies") >= config.month_companies).withColumn("m", month_index(F.col("month")))
    rows = rows.withColumn("island", F.col("m") - F.row_number().over(w))
    follows = F.lag("m").over(w) == F.col("m") - 1
    grows = follows & ((F.col("companies") > F.lag("companies").over(w)) | (F.col("rate") > F.lag("rate").over(w) + 1e-12))
    rows = rows.withColumn("restart", F.when(F.coalesce(grows, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("growth", F.sum("restart").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    islands = rows.groupBy(key, "island").agg(F.count("*").alias("n")).groupBy(key).agg(F.max("n").alias("continuous_windows"))
    growth = rows.groupBy(key, "growth").agg(F.count("*").alias("n")).groupBy(key).agg(F.max("n").alias("growth_windows"))
    return islands.join(growth, key)


def title_stats(records: DataFrame, template: Column) -> DataFrame:
    """Counters of each title by period, and its dominant role."""
    def distinct(c: str, p: str) -> Column:
        return F.countDistinct(F.when(F.col("period") == p, F.col(c)))

    rows = records.withColumn("template", template)
    out = rows.groupBy("title").agg(
        *(distinct(c, p).alias(f"{p}_{n}") for p in ("historical", "baseline", "current") for c, n in (("jd_id", "jds"), ("company_id", "companies"))),
        distinct("template", "current").alias("current_templates"), distinct("month", "current").alias("current_months"), distinct("source_family", "current").alias("current_sources"),
    )
    roles = rows.groupBy("title", "role").agg(F.count("*").alias("c")).groupBy("title").agg(F.min_by("role", F.struct((-F.col("c")).alias("c"), "role")).alias("dominant_role"))
    return out.join(roles, "title")


def new_titles(titles: DataFrame, jds: int = 2, companies: int = 2, templates: int = 2) -> DataFrame:
    """Titles without a posting before the current period that have enough support in it."""
    return titles.where((F.col("historical_jds") + F.col("baseline_jds") == 0) & (F.col("current_jds") >= jds) & (F.col("current_companies") >= companies) & (F.col("current_templates") >= templates))


def first_by_company(records: DataFrame, keys: list[str], order: list[str], most: int = 5) -> DataFrame:
    """The first record of each company, then the first ``most`` for each of ``keys``."""
    one = records.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "company_id").orderBy(*order))).where("_n = 1")
    return one.withColumn("evidence_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("company_id", *order)).cast("long")).where(F.col("evidence_rank") <= most).drop("_n")


def essential_or_bonus(weights: DataFrame, most: int = 8) -> DataFrame:
    """``role, skill_id, companies, total``: essential at half of the companies (two at least), else bonus; the first few of each."""
    kind = F.when(F.col("companies") >= F.greatest(F.lit(2), F.ceil(F.col("total") * 0.5)), "essential").otherwise("bonus")
    w = Window.partitionBy("role", "kind").orderBy(F.col("companies").desc(), "skill_id")
    return weights.withColumn("kind", kind).withColumn("kind_rank", F.row_number().over(w).cast("long")).where(F.col("kind_rank") <= most)


def stratified_sample(df: DataFrame, stratum: str, key: str, per_stratum: int, total: int) -> DataFrame:
    """``per_stratum`` rows of each stratum by the hash of the key, filled up to ``total`` from the rest.

    A sampling operator: its size is what it is for.
    """
    h = F.sha2(F.col(key).cast("string"), 256)
    w = Window.partitionBy(stratum).orderBy("_h", key)
    ranked = df.withColumn("_h", h).withColumn("_n", F.row_number().over(w))
    rank = F.when(F.col("_n") <= per_stratum, 0).otherwise(1)
    return ranked.orderBy(rank, "_h", key).limit(total).drop("_h", "_n")


def quality_report(postings: DataFrame, records: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """One row of counts, completeness and drift of a run's input."""
    def distinct(p: str) -> Column:
        return F.countDistinct(F.when(F.col("period") == p, F.col("company_id")))

    counts = records.agg(*(F.count(F.when(F.col("period") == p, 1)).alias(f"{p}_jds") for p in ("historical", "baseline", "current")), *(distinct(p).alias(f"{p}_companies") for p in ("historical", "baseline", "current")))
    dated = postings.agg(F.count("*").alias("database_jds"), F.count("posted_at").alias("valid_date_jds"))
    one = lambda c: drift(records.withColumn("_all", F.lit(1)), ["_all"], c).select(F.round("divergence", 6).alias(f"{c}_divergence"))
    return dated.crossJoin(counts).crossJoin(one("source_family")).crossJoin(one("industry")).withColumn("drift_warning", (F.col("source_family_divergence") > config.drift) | (F.col("industry_divergence") > config.drift))


def prioritized(changes: DataFrame, budget: int) -> DataFrame:
    """Changes in review order; those in review beyond the budget are only watched."""
    kind = F.when(F.col("change_type") == "ADDED_CANDIDATE", 0).when(F.col("change_type") == "INCREASED", 1).when(F.col("change_type") == "DECREASED", 2).otherwise(3)
    order = [F.when(F.col("rule_state") == "REVIEW", 0).otherwise(1), kind, F.abs("delta").desc(), F.greatest("x1", "x2").desc(), "role", "skill_id"]
    top = changes.orderBy(*order).limit(budget).where("rule_state = 'REVIEW'").select("role", "skill_id", F.lit(True).alias("_in"))
    return changes.join(top, ["role", "skill_id"], "left").withColumn("rule_state", F.when(F.col("_in"), "REVIEW").otherwise("WATCH")).drop("_in")
