"""Reviews of candidates: packets under a budget, guards, decisions, and the draft of a patch to the graph.

The reviewer is any function from a packet's text to an answer's text.  It is called
once for each distinct packet that the cache lacks, at most ``budget`` times; without
one, candidates stay pending.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import stable_id

#: Requirements that are no ability; actions by semantic class.
NON_CAPABILITY = "相关专业|专业背景|专业优先|学历|本科(?:及以上)?|硕士(?:及以上)?|博士(?:及以上)?|大专(?:及以上)?|工作经验|从业经验|年龄要求|应届毕业"
ROLE_ACTIONS = {"NEW_ROLE": "CREATE_ROLE", "SPECIALIZATION": "CREATE_ROLE_SPECIALIZATION", "ALIAS": "ADD_ROLE_ALIAS"}
SKILL_ACTIONS = {
    "TRUE_NEW_SKILL": "ADD_ROLE_SKILL", "EXISTING_SKILL_SYNONYM": "MERGE_SKILL", "SKILL_GRANULARITY_CHANGE": "REVIEW_SKILL_HIERARCHY",
    "REQUIREMENT_LEVEL_CHANGE": "CHANGE_REQUIREMENT_TYPE", "ROLE_MISCLASSIFICATION": "RECLASSIFY_JD",
}


def non_capability(skill: Column) -> Column:
    """Whether a requirement is about degrees, subjects or years and not about an ability."""
    return F.coalesce(F.trim(skill).rlike(NON_CAPABILITY), F.lit(False))


def evidence_ids(answer: Column, field: str = "evidence_jd_ids") -> Column:
    """All strings of the arrays named ``field`` anywhere in a JSON text, in order, each once.

    A string may hold brackets and escaped characters; an array that isn't closed is left out.
    """
    string = r'"(?:[^"\\]|\\.)*+"'
    arrays = F.regexp_extract_all(F.coalesce(answer, F.lit("")), F.lit(rf'"{field}"\s*:\s*(\[(?:[^\]"]|{string})*+\])'), F.lit(1))
    strings = F.flatten(F.transform(arrays, lambda a: F.regexp_extract_all(a, F.lit(f"({string})"), F.lit(1))))
    return F.array_distinct(F.transform(strings, lambda x: F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>")[0]))


def compacted(items: Column, budget: int, steps: tuple[tuple[int, int], ...] = ((12, 500), (10, 350), (6, 250), (3, 250))) -> Column:
    """``items`` (an array of texts) under ``budget`` characters: the first of ``steps`` (items, characters of each) that fits, else the last."""

    def first(items: Column, n: int, characters: int) -> Column:
        return F.transform(F.slice(items, 1, n), lambda t: F.substring(t, 1, characters))

    cut = [first(items, n, m) for n, m in steps]
    size = lambda x: F.coalesce(F.aggregate(x, F.lit(0), lambda s, t: s + F.length(t)), F.lit(0))
    out = cut[-1]
    for c in reversed(cut):
        out = F.when(size(c) <= budget, c).otherwise(out)
    return F.when(size(items) <= budget, items).otherwise(out)


def packet_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def reviewed(packets: DataFrame, cache: DataFrame, reviewer: Callable[[str], str] | None, budget: int) -> DataFrame:
    """``packets`` (``key, priority, packet``) with ``answer`` and ``source``: CACHE, REVIEWER or PENDING.

    Equal packets are reviewed once.  The ``budget`` most urgent that the cache
    (``key, answer``) lacks are sent, in the order of priority and key.
    """
    known = packets.join(cache.groupBy("key").agg(F.min("answer").alias("answer")), "key", "left")
    if reviewer is None or budget < 1:
        return known.withColumn("source", F.when(F.col("answer").isNotNull(), "CACHE").otherwise("PENDING"))
    open_packets = known.where("answer is null").groupBy("key").agg(F.min("priority").alias("priority"), F.min("packet").alias("packet"))
    chosen = open_packets.orderBy("priority", "key").limit(budget)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "_answer": pdf["packet"].map(reviewer)})

    answers = chosen.select("key", "packet").mapInPandas(run, "key string, _answer string")
    out = known.join(answers, "key", "left")
    source = F.when(F.col("answer").isNotNull(), "CACHE").when(F.col("_answer").isNotNull(), "REVIEWER").otherwise("PENDING")
    return out.withColumn("source", source).withColumn("answer", F.coalesce("answer", "_answer")).drop("_answer")


def patch_draft(reviews: DataFrame, kind: str, least: float = 0.70) -> DataFrame:
    """``change_id, action, candidate_id, approval_status`` of the completed reviews that are sure enough.

    ``reviews`` has ``candidate_id, status, semantic_class, confidence``; those of roles
    also ``continuous_windows, growth_windows, sources``, of which two each are needed.
    """
    actions = {"role": ROLE_ACTIONS, "skill": SKILL_ACTIONS}[kind]
    action = F.lit(None).cast("string")
    for name, value in actions.items():
        action = F.when(F.col("semantic_class") == name, value).otherwise(action)
    sure = (F.col("status") == "COMPLETED") & (F.col("confidence") >= least)
    if kind == "role":
        for c in ("continuous_windows", "growth_windows", "sources"):
            sure = sure & (F.col(c) >= 2)
    rows = reviews.where(sure).withColumn("action", action).where("action is not null")
    return rows.select(stable_id("graph_change", F.col("candidate_id"), F.col("action")).alias("change_id"), "action", "candidate_id", F.lit("PENDING").alias("approval_status"))
