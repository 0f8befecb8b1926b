"""Evidence-weighted role profiles: support, tiers, snapshots, trends, evolution, co-occurrence.

Postings have ``jd_id, company_id, role, industry, level, posted_at``; mentions have
``jd_id, seq, skill_id, category, stack, requirement, status, confidence``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.text import quarter_label, quarter_start, stable_id, time_decay

#: Evidence that counts, best first.
ACCEPTED = ("VERIFIED", "LOW_CONFIDENCE", "ANALYSIS_ONLY")
PROFILE = ["role", "industry", "level", "time_window"]


@dataclass(frozen=True)
class Config:
    half_life_months: float = 12.0
    template_floor: float = 0.35
    company_share: float = 0.7
    required: float = 0.60
    common: float = 0.30
    least: float = 0.10
    required_companies: float = 3.0
    related_pairs: int = 2
    related_score: float = 0.12
    related_rows: int = 2000


def status_rank(status: Column) -> Column:
    out = F.lit(len(ACCEPTED) + 1)
    for i, s in reversed(list(enumerate(ACCEPTED, 1))):
        out = F.when(status == s, i).otherwise(out)
    return out


def weight_of(size: Column, floor: float) -> Column:
    return F.when(size < 2, 1.0).otherwise(F.round(F.greatest(F.lit(floor), 1 / F.sqrt(size)), 6))


def template_weights(postings: DataFrame, key: Column, floor: float = 0.35) -> DataFrame:
    """``postings`` with ``template_size`` and ``template_weight``: one over the root of the size, not below ``floor``."""
    keyed = postings.withColumn("template_key", key)
    sizes = keyed.groupBy("template_key").agg(F.count("*").alias("template_size"))
    return keyed.join(sizes, "template_key").withColumn("template_weight", weight_of(F.col("template_size"), floor))


def weighted(postings: DataFrame, key: Column, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Postings with window, ``time_weight``, ``template_weight`` and their product ``base``.

    The reference time is the newest posting; a missing date weighs 1 and falls into its quarter.
    """
    newest = postings.agg(F.max("posted_at").alias("reference"))  # one row
    out = template_weights(postings, key, config.template_floor).crossJoin(F.broadcast(newest))
    at = F.coalesce("posted_at", "reference")
    out = out.withColumn("time_window", quarter_label(at)).withColumn("window_start", quarter_start(at))
    out = out.withColumn("time_weight", time_decay(F.col("posted_at"), F.col("reference"), config.half_life_months))
    return out.withColumn("base", F.col("time_weight") * F.col("template_weight")).drop("reference")


def accepted(mentions: DataFrame) -> DataFrame:
    """The best accepted mention of each skill in a posting: by status, confidence, then first."""
    order = F.struct(status_rank(F.col("status")), -F.coalesce("confidence", F.lit(float("-inf"))), "seq", "stack", "category", "requirement")
    row = F.min_by(F.struct(*(F.col(c) for c in mentions.columns)), order).alias("_row")
    return mentions.where(F.col("status").isin(*ACCEPTED)).groupBy("jd_id", "skill_id").agg(row).select("_row.*")


def roles(postings: DataFrame) -> DataFrame:
    return postings.groupBy("role").agg(
        F.count("*").alias("document_count"),
        F.countDistinct("company_id").alias("company_count"),
        F.array_join(F.sort_array(F.collect_set("industry")), "|").alias("industries"),
    ).withColumn("role_id", stable_id("role", F.col("role")))


def profiles(weighted: DataFrame) -> DataFrame:
    """Role by industry by level by quarter, each linked to the one before it that exists."""
    out = weighted.groupBy(*PROFILE).agg(F.min("window_start").alias("window_start"), F.count("*").alias("jd_count"), F.countDistinct("company_id").alias("company_count"))
    return linked(out)


def linked(out: DataFrame) -> DataFrame:
    """Profiles with their id and that of the one before."""
    out = out.withColumn("profile_id", stable_id("profile", *(F.col(c) for c in PROFILE)))
    w = Window.partitionBy("role", "industry", "level").orderBy("window_start")
    return out.withColumn("previous_profile_id", F.coalesce(F.lag("profile_id").over(w), F.lit("")))


def support(weighted: DataFrame, accepted: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Support of each skill in each profile, with its tier.

    A company votes once, with its strongest posting; the posting vote and the company
    vote are shares of what all postings and companies of the profile could vote.
    """
    by_company = weighted.groupBy(*PROFILE, "company_id").agg(F.sum("base").alias("jd"), F.max("base").alias("company"))
    whole = by_company.groupBy(*PROFILE).agg(F.sum("jd").alias("jd_all"), F.sum("company").alias("company_all"))
    hits = accepted.join(weighted.select("jd_id", *PROFILE, "company_id", "base", "template_weight"), "jd_id")
    vote = F.col("base") * F.col("confidence")
    one = hits.groupBy(*PROFILE, "skill_id", "company_id").agg(
        F.sum(vote).alias("jd_vote"), F.max(vote).alias("company_vote"), F.max("template_weight").alias("company_template"),
        F.count("*").alias("hits"), F.count(F.when(F.col("requirement") == "preferred", 1)).alias("preferred"),
    )
    return tiered(one, whole, config)


def tiered(one: DataFrame, whole: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Support and tier from the votes of each profile, skill and company (``one``) and all that each profile could have (``whole``)."""
    out = one.groupBy(*PROFILE, "skill_id").agg(
        F.sum("jd_vote").alias("jd_vote"), F.sum("company_vote").alias("company_vote"), F.sum("company_template").alias("effective"),
        F.count("*").alias("company_count"), F.sum("hits").alias("evidence_count"), F.sum("preferred").alias("preferred_mentions"),
    ).join(whole, PROFILE)
    jd, company = F.col("jd_vote") / F.col("jd_all"), F.col("company_vote") / F.col("company_all")
    out = out.withColumn("jd_support", jd).withColumn("company_support", company)
    out = out.withColumn("adjusted", config.company_share * F.col("company_support") + (1 - config.company_share) * F.col("jd_support"))
    out = out.where((F.round("adjusted", 9) >= config.least) | (F.col("preferred_mentions") > 0))
    bonus = F.col("preferred_mentions") == F.col("evidence_count")
    a = F.round("adjusted", 9)
    tier = F.when(bonus, "bonus").when((a >= config.required) & (F.round("effective", 9) >= config.required_companies), "required").when(a >= config.common, "common").otherwise("emerging")
    return out.select(
        *PROFILE, "skill_id", F.when(bonus, "PREFERS_SKILL").otherwise("REQUIRES_SKILL").alias("relation"), tier.alias("tier"),
        F.round("jd_support", 6).alias("jd_support"), F.round("company_support", 6).alias("company_support"), F.round("adjusted", 6).alias("adjusted_support"),
        "company_count", F.round("effective", 4).alias("effective_company_count"), "evidence_count", "preferred_mentions",
    )


def snapshots(profiles: DataFrame, support: DataFrame) -> DataFrame:
    """Role by quarter by skill: means over the profiles that have the skill, weighted by postings, with the trend.

    The trend compares with the skill's previous snapshot, whichever quarter that was.
    Means are rounded half up: a tenth of a billionth lifts halves over the edge.
    """
    both = support.drop("company_support_").join(profiles.select(*PROFILE, "window_start", "jd_count"), PROFILE)
    mean = lambda c: F.round(F.sum(F.col(c) * F.col("jd_count")) / F.sum("jd_count") + 1e-10, 6).alias(c)
    out = both.groupBy("role", "time_window", "skill_id").agg(
        F.min("window_start").alias("window_start"), mean("adjusted_support"), mean("jd_support"), mean("company_support"),
        F.sum("evidence_count").alias("evidence_count"), F.sum("jd_count").alias("jd_count"), F.sum("company_count").alias("company_count"), F.sum("preferred_mentions").alias("_preferred"),
    )
    bonus = (F.col("evidence_count") > 0) & (F.col("_preferred") >= F.col("evidence_count"))
    s = F.col("adjusted_support")
    out = out.withColumn("tier", F.when(bonus, "bonus").when(s >= 0.60, "required").when(s >= 0.30, "common").otherwise("emerging")).drop("_preferred")
    w = Window.partitionBy("role", "skill_id").orderBy("window_start")
    before = F.lag("adjusted_support").over(w)
    delta = F.round(s - before, 6)
    trend = F.when(before.isNull(), "NEW").when(delta >= 0.08, "UP").when(delta <= -0.08, "DOWN").otherwise("STABLE")
    return out.select("*", F.coalesce(before, F.lit(0.0)).alias("previous_support"), F.coalesce(delta, F.lit(0.0)).alias("delta"), trend.alias("trend"))


def evolution(profiles: DataFrame, support: DataFrame) -> DataFrame:
    """Skills that a profile gained, lost, strengthened or weakened since its predecessor."""
    w = Window.partitionBy("role", "industry", "level").orderBy("window_start")
    links = profiles.withColumn("next_profile_id", F.lead("profile_id").over(w)).select(*PROFILE, "profile_id", "previous_profile_id", "next_profile_id")
    # A row counts for its own profile, and as the past of the one that follows.
    zero, value = F.lit(0.0), F.col("adjusted_support")
    own = F.struct(F.col("profile_id").alias("c"), F.col("previous_profile_id").alias("p"), value.alias("now"), zero.alias("then"))
    past = F.struct(F.col("next_profile_id").alias("c"), F.col("profile_id").alias("p"), zero.alias("now"), value.alias("then"))
    rows = support.join(links, PROFILE).select("skill_id", F.explode(F.array(own, past)).alias("e")).where("e.c is not null and e.p != ''")
    both = rows.groupBy(F.col("e.c").alias("current_profile_id"), F.col("e.p").alias("previous_profile_id"), "skill_id").agg(F.sum("e.now").alias("current_support"), F.sum("e.then").alias("previous_support"))
    both = both.withColumn("delta", F.round(F.col("current_support") - F.col("previous_support"), 6))
    after, before, delta = F.col("current_support"), F.col("previous_support"), F.col("delta")
    change = F.when((after >= 0.20) & (before < 0.10), "ADDED").when((before >= 0.20) & (after < 0.10), "REMOVED").when(delta >= 0.15, "STRENGTHENED").when(delta <= -0.15, "WEAKENED")
    return both.withColumn("change_type", change).where("change_type is not null")


def cooccurrence(accepted: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Pairs of skills in one posting, with the Jaccard score of their postings; the strongest ones.

    A posting has few skills, so the join within postings grows with the mentions.
    """
    skills = accepted.select("jd_id", "skill_id")
    totals = skills.groupBy("skill_id").agg(F.count("*").alias("n"))
    a, b = skills.withColumnRenamed("skill_id", "source"), skills.withColumnRenamed("skill_id", "target")
    return strongest(a.join(b, "jd_id").where("source < target").groupBy("source", "target").agg(F.count("*").alias("cooccurrence")), totals, config)


def strongest(pairs: DataFrame, totals: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """The pairs (``source, target, cooccurrence``) with the best score, ``totals`` being ``skill_id, n``."""
    pairs = pairs.where(F.col("cooccurrence") >= config.related_pairs)
    out = pairs.join(totals.select(F.col("skill_id").alias("source"), F.col("n").alias("n1")), "source").join(totals.select(F.col("skill_id").alias("target"), F.col("n").alias("n2")), "target")
    score = F.round(F.col("cooccurrence") / (F.col("n1") + F.col("n2") - F.col("cooccurrence")), 6)
    out = out.select("source", "target", "cooccurrence", score.alias("jaccard_score")).where(F.col("jaccard_score") >= config.related_score)
    return out.orderBy(F.col("jaccard_score").desc(), F.col("cooccurrence").desc(), "source", "target").limit(config.related_rows)


def mode_of(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent non-empty ``value`` for each of ``keys``; of equal ones the smallest."""
    counts = df.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*keys, value).agg(F.count("*").alias("_c"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct((-F.col("_c")).alias("c"), F.col(value).alias("v"))).alias(name))


def skill_dimension(mentions: DataFrame) -> DataFrame:
    """Skills with the modes of category and stack, and all statuses under which they occur."""
    kept = mentions.where(~F.col("status").startswith("REJECTED"))
    base = kept.groupBy("skill_id").agg(F.count("*").alias("mentions"), F.array_join(F.sort_array(F.collect_set("status")), "|").alias("statuses"))
    return base.join(mode_of(kept, ["skill_id"], "category", "competency_category"), "skill_id", "left").join(mode_of(kept, ["skill_id"], "stack", "tech_stack"), "skill_id", "left")


def run_summary(postings: DataFrame, weighted: DataFrame, support: DataFrame) -> DataFrame:
    """One row of counts for a run's manifest."""
    a = postings.agg(F.count("*").alias("input_documents"), F.countDistinct("role").alias("roles"), F.countDistinct("company_id").alias("companies"))
    b = weighted.agg(F.count(F.when(F.col("template_size") > 1, 1)).alias("template_documents"))
    c = support.agg(F.count("*").alias("role_skill_edges"), *(F.count(F.when(F.col("tier") == t, 1)).alias(f"tier_{t}") for t in ("required", "common", "emerging", "bonus")))
    return a.crossJoin(b).crossJoin(c)
