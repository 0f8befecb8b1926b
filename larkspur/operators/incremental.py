"""Profiles kept up to date by what changes.

A posting that changes takes the votes of its old state back and casts those of its new one.
So do the others of its template, if the template's weight changes.  Votes are a multiset
with counts, from which a largest one can be taken away again; they hold the date, not the
weight that it has, so that a new reference time moves no row.  Of the support, the profiles
that a vote reaches or leaves are computed again; what a later reference does to all weights
of another profile cancels out.

The rows are those of ``profile`` over the new tables.

Tables of a state are columns that repeat, and their files a small part of what they hold:
joins of such tables are by sort and merge, as Spark would broadcast them by their files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import quarter_label, quarter_start, time_decay
from larkspur.operators import profile as P
from larkspur.session import written

_PLACE = ["role", "industry", "level"]
_VOTE = [*_PLACE, "posted_at", "company_id", "template_weight", "hit", "skill_id", "confidence", "preferred"]


@dataclass(frozen=True)
class State:
    """Tables of one version; none of them is changed, an update gives others."""

    postings: DataFrame  # with template_key
    accepted: DataFrame  # jd_id, skill_id, confidence, requirement
    templates: DataFrame  # template_key, n
    votes: DataFrame | None  # _VOTE and n
    support: DataFrame | None
    skills: DataFrame | None  # skill_id, n
    pairs: DataFrame | None  # source, target, n

    @property
    def parts(self) -> tuple[str, ...]:
        return tuple(p for p in PARTS if getattr(self, p) is not None)


#: What a state can be kept for: the support of profiles, and the pairs of skills.
PARTS = ("support", "pairs")


def _met(a: DataFrame, b: DataFrame, key: str, how: str = "inner") -> DataFrame:
    return a.hint("merge").join(b.hint("merge"), key, how)


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n")).where("n != 0")


def _evidence(mentions: DataFrame) -> DataFrame:
    return P.accepted(mentions).select("jd_id", "skill_id", "confidence", "requirement")


def _votes(postings: DataFrame, accepted: DataFrame, templates: DataFrame, floor: float, sign: int) -> DataFrame:
    """What postings vote, once for themselves and once for each skill, ``sign`` times."""
    rows = _met(postings, templates.withColumnRenamed("n", "_size"), "template_key").withColumn("template_weight", P.weight_of(F.col("_size"), floor))
    own = rows.select("*", F.lit(False).alias("hit"), F.lit(None).cast(accepted.schema["skill_id"].dataType).alias("skill_id"), F.lit(None).cast(accepted.schema["confidence"].dataType).alias("confidence"), F.lit(False).alias("preferred"))
    hits = _met(rows, accepted, "jd_id").withColumn("hit", F.lit(True)).withColumn("preferred", F.coalesce(F.col("requirement") == "preferred", F.lit(False)))
    return own.select(*_VOTE).union(hits.select(*_VOTE)).withColumn("n", F.lit(sign).cast("long"))


def _skills(accepted: DataFrame, sign: int) -> DataFrame:
    return accepted.select("skill_id", F.lit(sign).cast("long").alias("n"))


def _pairs(accepted: DataFrame, sign: int) -> DataFrame:
    a, b = accepted.select("jd_id", F.col("skill_id").alias("source")), accepted.select("jd_id", F.col("skill_id").alias("target"))
    return _met(a, b, "jd_id").where("source < target").select("source", "target", F.lit(sign).cast("long").alias("n"))


def _reference(votes: DataFrame) -> DataFrame:
    """One row: the newest date, or null."""
    return votes.where("not hit").agg(F.max("posted_at").alias("reference"))


def _dated(votes: DataFrame, reference: DataFrame) -> DataFrame:
    """Votes with their quarter: one without a date has that of the reference."""
    both = votes.crossJoin(F.broadcast(reference))  # one row
    at = F.coalesce("posted_at", "reference")
    return both.withColumn("time_window", quarter_label(at)).withColumn("window_start", quarter_start(at))


def _cell() -> Column:
    """One number for each profile; should two have the same, both are computed again."""
    return F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in P.PROFILE)).alias("_cell")


def _support(dated: DataFrame, config: P.Config) -> DataFrame:
    base = time_decay(F.col("posted_at"), F.col("reference"), config.half_life_months) * F.col("template_weight")
    rows = dated.withColumn("_base", base).withColumn("_vote", F.col("_base") * F.col("confidence"))
    by_company = rows.where("not hit").groupBy(*P.PROFILE, "company_id").agg(F.sum(F.col("_base") * F.col("n")).alias("jd"), F.max("_base").alias("company"))
    whole = by_company.groupBy(*P.PROFILE).agg(F.sum("jd").alias("jd_all"), F.sum("company").alias("company_all"))
    one = rows.where("hit").groupBy(*P.PROFILE, "skill_id", "company_id").agg(
        F.sum(F.col("_vote") * F.col("n")).alias("jd_vote"), F.max("_vote").alias("company_vote"), F.max("template_weight").alias("company_template"),
        F.sum("n").alias("hits"), F.sum(F.when(F.col("preferred"), F.col("n")).otherwise(0)).alias("preferred"),
    )
    return P.tiered(one, whole, config)


def built(postings: DataFrame, mentions: DataFrame, key: Column, config: P.Config = P.Config(), parts: tuple[str, ...] = PARTS) -> State:  # noqa: B008
    """The state of whole tables; ``key`` is the template's, over columns of ``postings``; a null key is no posting's.

    Without one of the ``parts`` (``PARTS``) its tables, and their updates, are left out.
    """
    own = ["jd_id", *_PLACE, "posted_at", "company_id"]
    rows = written(postings.withColumn("template_key", key).where("template_key is not null").select(*own, "template_key"), "postings")
    evidence = written(_evidence(mentions), "accepted")
    templates = written(rows.groupBy("template_key").agg(F.count("*").alias("n")), "templates")
    votes = support = skills = pairs = None
    if "support" in parts:
        votes = written(_summed(_votes(rows, evidence, templates, config.template_floor, 1), _VOTE), "votes")
        support = written(_support(_dated(votes, _reference(votes)), config), "support")
    if "pairs" in parts:
        skills = written(_summed(_skills(evidence, 1), ["skill_id"]), "skills")
        pairs = written(_summed(_pairs(evidence, 1), ["source", "target"]), "pairs")
    return State(rows, evidence, templates, votes, support, skills, pairs)


def updated(state: State, changed: DataFrame, postings: DataFrame, mentions: DataFrame, key: Column, config: P.Config = P.Config()) -> State:  # noqa: B008
    """The state after a change of the postings whose ids are ``changed`` (``jd_id``).

    ``postings`` and ``mentions`` hold all rows that these ids have now: none for one that is
    gone.  Rows of other ids are ignored; an id that is null can't change.  ``key`` is the
    one of ``built``.
    """
    ids = written(changed.select("jd_id").where("jd_id is not null").distinct(), "changed")
    of_ids = lambda df, how="left_semi": _met(df, ids, "jd_id", how)
    old, old_evidence = of_ids(state.postings), of_ids(state.accepted)
    mine = postings.withColumn("template_key", key).where("template_key is not null").select(*state.postings.columns)
    new, new_evidence = written(of_ids(mine), "new"), written(_evidence(of_ids(mentions)), "new_accepted")

    of = lambda df, sign: df.select("template_key", F.lit(sign).cast("long").alias("n"))
    moved = _summed(of(old, -1).union(of(new, 1)), ["template_key"])
    templates = written(_summed(state.templates.union(moved), ["template_key"]), "templates")
    staying = of_ids(state.postings, "left_anti")
    votes = support = skills = pairs = None
    if state.votes is not None:
        votes, support = _revoted(state, staying, moved, templates, (old, old_evidence), (new, new_evidence), config)
    if state.pairs is not None:
        skills = written(_summed(state.skills.union(_skills(old_evidence, -1)).union(_skills(new_evidence, 1)), ["skill_id"]), "skills")
        pairs = written(_summed(state.pairs.union(_pairs(old_evidence, -1)).union(_pairs(new_evidence, 1)), ["source", "target"]), "pairs")
    return State(
        written(staying.select(*new.columns).union(new), "postings"), written(of_ids(state.accepted, "left_anti").select(*new_evidence.columns).union(new_evidence), "accepted"), templates,
        votes, support, skills, pairs,
    )


def _revoted(state: State, staying: DataFrame, moved: DataFrame, templates: DataFrame, was: tuple[DataFrame, DataFrame], now: tuple[DataFrame, DataFrame], config: P.Config) -> tuple[DataFrame, DataFrame]:
    """Votes and support after a change of postings and their evidence from ``was`` to ``now``."""
    (old, old_evidence), (new, new_evidence) = was, now
    sizes = _met(moved.withColumnRenamed("n", "_d"), state.templates, "template_key", "left").fillna(0, ["n"])
    weight = lambda size: P.weight_of(size, config.template_floor)
    # Mates: postings that stay as they are in a template that weighs something else now.
    reweighed = written(sizes.where((F.col("n") > 0) & (weight(F.col("n")) != weight(F.col("n") + F.col("_d")))).select("template_key"), "reweighed")
    mates = written(_met(staying, reweighed, "template_key", "left_semi").select(*state.postings.columns), "mates")
    mates_evidence = _met(state.accepted, mates.select("jd_id").distinct(), "jd_id", "left_semi")

    floor = config.template_floor
    before = _votes(old.select(*mates.columns).union(mates), old_evidence.union(mates_evidence), state.templates, floor, -1)
    after = _votes(new.union(mates), new_evidence.union(mates_evidence), templates, floor, 1)
    delta = written(_summed(before.union(after), _VOTE), "delta")

    place = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in _PLACE)).alias("_place")
    places = delta.select(place).distinct()
    held = state.votes.withColumn("_place", place)
    merged = _summed(_met(held, places, "_place", "left_semi").drop("_place").union(delta), _VOTE)
    votes = written(merged.union(_met(held, places, "_place", "left_anti").drop("_place").select(*merged.columns)), "votes")

    then, now_ = _reference(state.votes), _reference(votes)
    undated = state.votes.where("posted_at is null").union(votes.where("posted_at is null"))  # these go with the reference
    reached = _dated(delta, now_).select(_cell()).union(_dated(delta, then).select(_cell())).union(_dated(undated, now_).select(_cell())).union(_dated(undated, then).select(_cell()))
    cells = written(reached.distinct(), "cells")
    again = _support(_met(_dated(votes, now_).withColumn("_cell", _cell()), cells, "_cell", "left_semi"), config)
    kept = _met(state.support.withColumn("_cell", _cell()), cells, "_cell", "left_anti").select(*again.columns)
    return votes, written(kept.union(again), "support")


def profiles(state: State) -> DataFrame:
    """``profile.profiles`` of the state."""
    rows = _dated(state.votes.where("not hit"), _reference(state.votes))
    return P.linked(rows.groupBy(*P.PROFILE).agg(F.min("window_start").alias("window_start"), F.sum("n").alias("jd_count"), F.countDistinct("company_id").alias("company_count")))


def snapshots(state: State) -> DataFrame:
    return P.snapshots(profiles(state), state.support)


def cooccurrence(state: State, config: P.Config = P.Config()) -> DataFrame:  # noqa: B008
    return P.strongest(state.pairs.withColumnRenamed("n", "cooccurrence"), state.skills, config)
