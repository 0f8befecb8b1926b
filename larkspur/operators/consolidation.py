"""Consolidation of skill concepts: merges into a registry and into clusters, roll-up, selection without redundancy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import bound, normalize_text
from larkspur.operators import matching as M
from larkspur.operators.cluster import components
from larkspur.operators.concepts import distinct_counts, status_of


@dataclass(frozen=True)
class Config:
    """Weights of phrase, context and name, and the thresholds of each kind of merge."""

    weights: tuple[float, float, float] = (0.65, 0.25, 0.10)
    merge: float = 0.94
    phrase: float = 0.88
    name_guard: float = 0.45
    near_weights: tuple[float, float] = (0.72, 0.28)
    near: float = 0.95
    near_phrase: tuple[float, float] = (0.96, 0.98)  # with and without overlap of the names
    near_context: tuple[float, float] = (0.93, 0.95)
    same_vector: float = 0.95


def combined(phrase: Column, context: Column, name: Column, config: Config = Config()) -> Column:  # noqa: B008
    a, b, c = config.weights
    return a * phrase + b * context + c * name


def registry_merges(pairs: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """``group, registry``: the nearest registered concept that each group may merge into.

    ``pairs`` has ``group, registry, rank`` and for both sides ``name`` and ``category``
    (``group_name`` and so on), and the similarities ``phrase, context, lexical``.
    """
    fits = (F.col("group_category") == F.col("registry_category")) & (combined(F.col("phrase"), F.col("context"), F.col("lexical"), config) >= config.merge) & (F.col("phrase") >= config.phrase)
    allowed = M.merge_allowed(F.col("group_name"), F.col("registry_name"), F.col("lexical"), config.name_guard)
    return pairs.where(fits & allowed).groupBy("group").agg(F.min_by("registry", F.struct("rank", "registry")).alias("registry"))


def _apart(a: Column, b: Column) -> Column:
    """Whether both names have ASCII words and none in common, or both have years and not the same."""
    words = lambda p: (F.size(p["x"]) > 0) & (F.size(p["y"]) > 0) & ~F.arrays_overlap(p["x"], p["y"])
    dates = lambda p: (F.size(p["u"]) > 0) & (F.size(p["v"]) > 0) & (p["u"] != p["v"])
    parts = F.struct(M.ascii_tokens(a).alias("x"), M.ascii_tokens(b).alias("y"), M.years(a).alias("u"), M.years(b).alias("v"))
    return bound(parts, lambda p: words(p) | dates(p))


def cluster_edges(pairs: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """``a, b`` of pairs that merge: by names and vectors together, or by vectors alone under stricter bounds.

    ``pairs`` has ``a, b, a_name, b_name``, ``phrase, context, lexical``, and ``by_name``:
    whether the pair was proposed by its names or by its vectors.  Names without an
    overlap, with other ASCII words, or with other years need more or don't merge.
    Names are looked at where the numbers leave it open.
    """
    phrase, context, a, b = (F.col(c) for c in ("phrase", "context", "a_name", "b_name"))
    named = (combined(phrase, context, F.col("lexical"), config) >= config.merge) & (phrase >= config.phrase)
    u, v = config.near_weights
    linked, alone = ((phrase >= p) & (context >= c) for p, c in zip(config.near_phrase, config.near_context, strict=True))
    enough = (u * phrase + v * context >= config.near) & (linked | alone)
    fits = (linked & alone) | F.when(M.meaningful_overlap(a, b), linked).otherwise(alone)
    near = enough & fits & ~_apart(a, b)
    return pairs.where(F.when(F.col("by_name"), named).otherwise(near)).select("a", "b").distinct()


def clusters(groups: DataFrame, edges: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``groups`` with ``concept``: the first by ``order`` of those that edges connect."""
    found = groups.join(components(edges).withColumnRenamed("node", key), key, "left").withColumn("component", F.coalesce("component", key))
    heads = found.groupBy("component").agg(F.min_by(key, F.struct(*order, F.col(key))).alias("concept"))
    return found.join(heads, "component").drop("component")


def rolled_up(facts: DataFrame, registered: Column) -> DataFrame:
    """``concept`` with its members, companies, postings, verified postings and status, from rows ``concept, member, company_id, jd_id, verified``."""
    counts = distinct_counts(facts, ["concept"], {"members": "member", "companies": "company_id", "jds": "jd_id"}, ("verified_jds", "jd_id", F.col("verified")), ("company_id",))
    kinds = facts.groupBy(F.col("concept").alias("_c")).agg(F.bool_or(registered).alias("registered"))
    counts = counts.join(kinds, F.col("concept").eqNullSafe(F.col("_c"))).drop("_c")
    rate = F.round(F.col("verified_jds") / F.greatest(F.lit(1), "jds"), 6).alias("verified_rate")
    return counts.select("concept", "members", "companies", "jds", rate, status_of(F.col("companies"), F.col("jds"), F.col("verified_jds"), F.col("members"), F.col("registered")).alias("status"))


def selection_core(name: Column) -> Column:
    """A normalized name without a leading verb and a trailing word for ability."""
    # Verbs that introduce a skill, and words that close one.
    t = F.regexp_replace(normalize_text(name), "^(?:具备|具有|能够|可以|熟练掌握|熟练使用|熟练应用|熟练操作|熟练运用|掌握|使用|应用|操作|运用|制定|进行|开展|实施|执行)", "")
    t = F.regexp_replace(t, "(?:相关)?(?:能力|技能|经验)$", "")
    return F.when(t.contains("办公"), F.replace(t, F.lit("office"), F.lit(""))).otherwise(t)


def without_synonyms(selected: DataFrame, role: str, category: str, item: str, name: str, score: str, vector: str, config: Config = Config()) -> DataFrame:  # noqa: B008
    """``role, category, item, score, category_rank``: of the items selected for a role, across categories, one of each meaning.

    In order of score an item goes if a kept one has its normalized name, its core, an
    anagram of its core (four characters at least), or a vector as near as
    ``same_vector`` and a word or bigram in common.  A role's items are those that its
    quotas allow, so a group is bounded.
    """
    generic = M.GENERIC
    rows = selected.select(
        role, category, item, score, vector, normalize_text(F.col(name)).alias("_norm"), selection_core(F.col(name)).alias("_core"), M.ascii_tokens(F.col(name)).alias("_words"),
        F.regexp_replace(normalize_text(F.col(name)), generic, "").alias("_rest"),
    )
    kinds = dict(rows.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([score, item], ascending=[False, True]).reset_index(drop=True)
        v = np.stack(pdf[vector].to_list()).astype(float)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        kept: list[int] = []

        def same(i: int, j: int) -> bool:
            a, b = pdf.iloc[i], pdf.iloc[j]
            if a["_norm"] == b["_norm"]:
                return True
            x, y = a["_core"], b["_core"]
            if min(len(x), len(y)) >= 2 and (x == y or (len(x) >= 4 and sorted(x) == sorted(y))):
                return True
            if v[i] @ v[j] < config.same_vector:
                return False
            p, q = a["_rest"], b["_rest"]
            grams = lambda t: {t[k : k + 2] for k in range(len(t) - 1)}
            overlap = bool(p and q) and (p in q or q in p or bool(grams(p) & grams(q)))
            return overlap or bool(set(a["_words"]) & set(b["_words"]))

        for i in range(len(pdf)):
            if not any(same(i, j) for j in kept):
                kept.append(i)
        out = pdf.loc[kept, [role, category, item, score]]
        return out.assign(category_rank=out.groupby(category).cumcount() + 1)

    schema = ", ".join(f"{c} {kinds[c]}" for c in (role, category, item, score)) + ", category_rank long"
    return rows.groupBy(role).applyInPandas(run, schema)


def blocked_pairs(df: DataFrame, key: str, blocks: Column, accept=None) -> DataFrame:
    """``a < b`` that share one of ``blocks`` (an array of keys); ``accept`` takes the pairs and returns those to keep.

    Keys that everybody has pair everybody: choose rare ones.
    """
    keyed = df.select(F.col(key), F.explode(F.array_distinct(blocks)).alias("_block"))
    pairs = keyed.select(F.col(key).alias("a"), "_block").join(keyed.select(F.col(key).alias("b"), "_block"), "_block").where("a < b").select("a", "b").distinct()
    return pairs if accept is None else accept(pairs)
