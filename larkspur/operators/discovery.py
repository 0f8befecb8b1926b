"""Discovery of new job titles: clusters of titles, their roll-up, suppression of what is known, and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators import evolution as E
from larkspur.operators.cluster import components
from larkspur.operators.dedup import sequence_ratio
from larkspur.operators.matching import gates

#: A programming language in front of a role makes no role of its own.
TECH_PREFIX = r"(?i)^(?:python|java|c\+\+|go)(?=.+)"
#: Similarity of a translated alias to the dominant role from which a title counts as known.
ALIAS_RATIO = 0.55


def title_concepts(stats: DataFrame, pairs: DataFrame) -> DataFrame:
    """``title, concept``: the best supported, then the shortest, of the titles that ``pairs`` (``a, b``) connect."""
    found = stats.join(components(pairs).withColumnRenamed("node", "title"), "title", "left").withColumn("component", F.coalesce("component", "title"))
    order = F.struct((-F.col("current_jds")).alias("c"), (-(F.col("historical_jds") + F.col("baseline_jds") + F.col("current_jds"))).alias("n"), F.length("title").alias("l"), F.col("title"))
    heads = found.groupBy("component").agg(F.min_by("title", order).alias("concept"))
    return found.join(heads, "component").select("title", "concept")


def rolled_up(records: DataFrame, concepts: DataFrame, template: Column) -> DataFrame:
    """``evolution.title_stats`` of the concepts: counted anew from the records of all members, so that nobody counts twice."""
    members = concepts.groupBy("concept").agg(F.count("*").alias("members")).withColumnRenamed("concept", "title")
    rows = records.join(concepts, "title").drop("title").withColumnRenamed("concept", "title")
    return E.title_stats(rows, template).join(members, "title")


def unknown_titles(stats: DataFrame, known: DataFrame, aliases: DataFrame, generic: tuple[str, ...] = ()) -> DataFrame:
    """``stats`` without titles that are known, also behind a language's name, or by a translated alias, or that are generic.

    ``known`` has ``title``; ``aliases`` has ``title, alias``: controlled lists.  An
    alias counts if it is known, or like the title's dominant role.
    """
    names = known.select(F.col("title").alias("_known")).distinct()
    left = stats.join(names, F.col("title") == F.col("_known"), "left_anti")
    left = left.withColumn("_bare", F.regexp_replace("title", TECH_PREFIX, "")).join(names, F.col("_bare") == F.col("_known"), "left_anti").drop("_bare")
    alias = aliases.join(names.withColumn("_is", F.lit(True)), F.col("alias") == F.col("_known"), "left").groupBy("title").agg(F.min("alias").alias("_alias"), F.bool_or(F.coalesce("_is", F.lit(False))).alias("_is"))
    left = left.join(alias, "title", "left")
    like = F.when(F.col("_alias").isNotNull(), sequence_ratio(F.coalesce("_alias", F.lit("")), F.coalesce("dominant_role", F.lit(""))) >= ALIAS_RATIO)
    return left.where(~F.coalesce(F.col("_is"), F.lit(False)) & ~F.coalesce(like, F.lit(False)) & ~F.col("title").isin(*generic)).drop("_alias", "_is")


def candidates(stats: DataFrame, runs: DataFrame, *, jds: int = 2, companies: int = 2, templates: int = 2, windows: int = 2, sources: int = 2) -> DataFrame:
    """New titles with their runs of months and the gates that they fail.

    ``runs`` is ``evolution.longest_runs`` by ``title``.  A title without a posting
    before the current period and with enough support is a candidate; whether it is
    confirmed is left to the gates on growth and independent sources.
    """
    new = E.new_titles(stats, jds, companies, templates).join(runs, "title", "left").fillna(0, ["continuous_windows", "growth_windows"])
    return gates(new, {"continuous": F.col("continuous_windows") >= windows, "growth": F.col("growth_windows") >= windows, "sources": F.col("current_sources") >= sources})
