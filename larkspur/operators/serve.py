"""Read API over the graph tables: health, facets, panorama, timeline, evidence, reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.operators.profile import ACCEPTED, status_rank
from larkspur.session import written


def health(tables: dict[str, DataFrame]) -> DataFrame:
    """One row ``name, rows`` for each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = one if out is None else out.union(one)
    return out


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """``facet, value, rows`` of the distinct non-empty values of several columns, in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns)))
    return df.select(pairs.alias("p")).where(F.coalesce(F.col("p.value"), F.lit("")) != "").groupBy("p.facet", "p.value").agg(F.count("*").alias("rows"))


def matching(df: DataFrame, **wanted: str) -> DataFrame:
    """Rows that equal the arguments; an empty argument asks for nothing, so filters push down."""
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


def role_list(roles: DataFrame, profiles: DataFrame, industry: str = "", level: str = "") -> DataFrame:
    found = matching(profiles, industry=industry, level=level).groupBy("role").agg(F.countDistinct("profile_id").alias("profile_count"), F.max("window_start").alias("latest_window"))
    return roles.join(found, "role")


def latest_window(df: DataFrame, keys: list[str], start: str = "window_start") -> DataFrame:
    """The rows of the newest window for each of ``keys``."""
    newest = df.groupBy(*keys).agg(F.max(start).alias("_newest"))
    return df.join(newest, keys).where(F.col(start) == F.col("_newest")).drop("_newest")


def ranked_skills(snapshots: DataFrame, *, time_window: str = "", min_support: float = 0.10, limit: int = 30) -> DataFrame:
    """The strongest skills of each role in a window, or else in its latest one."""
    rows = matching(snapshots, time_window=time_window) if time_window else latest_window(snapshots, ["role"])
    w = Window.partitionBy("role").orderBy(F.col("adjusted_support").desc(), F.col("evidence_count").desc(), "skill_id")
    return rows.where(F.col("adjusted_support") >= min_support).withColumn("skill_rank", F.row_number().over(w).cast("long")).where(F.col("skill_rank") <= max(1, min(limit, 50)))


def panorama(ranked: DataFrame, skills: DataFrame, roles: DataFrame) -> DataFrame:
    """Nodes and edges ``kind, id, label, source, target`` of roles, skill groups and skills.

    The ranked skills, a few tens a role, are written once, as five branches read them.
    """
    rows = ranked.join(skills.select("skill_id", "competency_category"), "skill_id").withColumn("grp", F.coalesce(F.nullif("competency_category", F.lit("")), F.lit("other")))
    rows = written(rows.select("role", "skill_id", "tier", "grp"), "ranked")
    none = F.lit(None).cast("string")
    group_id, skill_id = F.concat_ws(":", F.lit("category"), "role", "grp"), F.concat_ws(":", F.lit("skill"), "role", "skill_id")
    used = roles.join(rows.select("role").distinct(), "role", "left_semi")
    groups = rows.select("role", "grp").distinct()
    return (
        used.select(F.lit("role").alias("kind"), F.col("role").alias("id"), F.col("role").alias("label"), none.alias("source"), none.alias("target"))
        .union(groups.select(F.lit("category"), group_id, F.col("grp"), none, none))
        .union(rows.select(F.lit("skill"), skill_id, F.col("skill_id"), none, none))
        .union(groups.select(F.lit("HAS_SKILL_GROUP"), F.concat(F.lit("edge:"), group_id), F.lit(""), F.col("role"), group_id))
        .union(rows.select(F.lit("HAS_SKILL"), F.concat(F.lit("edge:"), skill_id), F.col("tier"), group_id, skill_id))
    )


def timeline(snapshots: DataFrame, role: str = "", per_window: int = 12) -> DataFrame:
    w = Window.partitionBy("role", "time_window").orderBy(F.col("adjusted_support").desc(), "skill_id")
    return matching(snapshots, role=role).withColumn("skill_rank", F.row_number().over(w).cast("long")).where(F.col("skill_rank") <= per_window)


def latest_summary(profiles: DataFrame, support: DataFrame, top: int = 20) -> DataFrame:
    """Support over the profiles of a role's latest window, weighted by their postings."""
    latest = latest_window(profiles, ["role"]).select("role", "industry", "level", "time_window", "jd_count")
    rows = support.join(latest, ["role", "industry", "level", "time_window"])
    out = rows.groupBy("role", "skill_id").agg(F.round(F.sum(F.col("adjusted_support") * F.col("jd_count")) / F.sum("jd_count") + 1e-10, 6).alias("summary_support"), F.sum("evidence_count").alias("evidence_count"))
    w = Window.partitionBy("role").orderBy(F.col("summary_support").desc(), F.col("evidence_count").desc(), "skill_id")
    return out.withColumn("summary_rank", F.row_number().over(w).cast("long")).where(F.col("summary_rank") <= top)


def top_values(df: DataFrame, keys: list[str], value: str, top: int) -> DataFrame:
    """The most frequent values for each of ``keys``; of equal ones the smallest first."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("amount"))
    w = Window.partitionBy(*keys).orderBy(F.col("amount").desc(), value)
    return counts.withColumn("value_rank", F.row_number().over(w).cast("long")).where(F.col("value_rank") <= top)


def evidence(mentions: DataFrame, weighted: DataFrame, skill: str, *, role: str = "", time_window: str = "", limit: int = 50) -> DataFrame:
    """Accepted mentions of a skill, the best evidence first."""
    rows = mentions.where((F.col("skill_id") == skill) & F.col("status").isin(*ACCEPTED)).join(matching(weighted, role=role, time_window=time_window), "jd_id")
    order = [status_rank(F.col("status")), F.col("confidence").desc(), F.col("posted_at").desc(), F.col("jd_id"), F.col("seq"), F.col("stack"), F.col("category"), F.col("requirement")]
    return rows.orderBy(*order).limit(max(1, min(limit, 200)))


def review_tasks(mentions: DataFrame, postings: DataFrame, limit: int = 100) -> DataFrame:
    """Mentions that need a reviewer, the least certain first, with their posting if there is one."""
    tasks = mentions.where(F.col("status") != "VERIFIED").orderBy("confidence", "jd_id", "seq", "skill_id", "stack", "requirement").limit(max(1, min(limit, 500)))
    return tasks.join(postings.select("jd_id", "role", "company_name"), "jd_id", "left")


def latest_decisions(decisions: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """An append-only decision log as it stands: the last row of each of ``keys``."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return decisions.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def quality(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("status").agg(F.count("*").alias("amount"), F.count(F.when(F.col("requirement") == "preferred", 1)).alias("preferred"))


def descend(spark: SparkSession, relations: DataFrame, root: str, limit: int | None = None) -> DataFrame:
    """``node, depth`` of everything below ``root``, itself included (``parent, child``), down to ``limit`` levels (null: all).

    A round a level: the children of the newest nodes that were not met before, so a cycle
    ends.  Each node has its least depth.
    """
    edges = written(relations.select(F.col("parent").cast("string").alias("parent"), F.col("child").cast("string").alias("child")).where("parent is not null and child is not null").distinct(), "relations")
    newest = spark.range(1).select(F.lit(root).cast("string").alias("node"), F.lit(0).alias("depth"))
    met, depth = written(newest, "met"), 0
    newest = met
    while limit is None or depth < limit:
        depth += 1
        below = newest.join(edges, newest["node"] == edges["parent"]).select(F.col("child").alias("node")).distinct()
        newest = written(below.join(met.select("node"), "node", "left_anti").select("node", F.lit(depth).alias("depth")), "level")
        if newest.isEmpty():
            break
        met = written(met.union(newest), "met")
    return met


def projection(df: DataFrame, allowed: list[str], forbidden: tuple[str, ...] = ("description", "raw_text", "text")) -> DataFrame:
    """The allowed columns alone; raises if one of them may hold raw text."""
    if bad := [c for c in allowed if c in forbidden]:
        raise ValueError(f"columns must not leave: {bad}")
    return df.select(*allowed)


def page_after(df: DataFrame, key: str, cursor, size: int) -> DataFrame:
    """The next page by key: no rows before the cursor are read twice."""
    return df.where(F.col(key) > cursor).orderBy(key).limit(size)


def validation(postings: DataFrame, mentions: DataFrame, skills: DataFrame) -> DataFrame:
    """``check, failures``: unique and present keys, references that lead somewhere."""
    def row(name: str, df: DataFrame, count: Column) -> DataFrame:
        return df.agg(count.cast("long").alias("failures")).select(F.lit(name).alias("check"), "failures")

    n = F.count(F.lit(1))
    return (
        row("posting_key_repeated", postings, n - F.countDistinct("jd_id"))
        .union(row("posting_key_missing", postings, F.count(F.when(F.col("jd_id").isNull(), 1))))
        .union(row("mention_without_posting", mentions.join(postings, "jd_id", "left_anti"), n))
        .union(row("mention_without_skill", mentions.join(skills, "skill_id", "left_anti"), n))
        .union(row("posting_without_mention", postings.join(mentions, "jd_id", "left_anti"), n))
        .union(row("confidence_out_of_range", mentions, F.count(F.when(~F.col("confidence").between(0, 1), 1))))
    )


def with_history(decisions: DataFrame, keys: list[str], order: list[str], shown: str, most: int = 20) -> DataFrame:
    """The latest decision of each of ``keys`` and ``history``: ``shown`` of its last ``most``, newest first."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    last = decisions.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    lists = last.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", shown))), lambda x: x[shown]).alias("history"))
    return last.where("_n = 1").drop("_n").join(lists, keys)


def cluster_summary(members: DataFrame, cluster: str, columns: list[str], top: int) -> DataFrame:
    """``cluster``, its size, and for each of ``columns`` the ``top`` most frequent values, joined by a bar."""
    out = members.groupBy(cluster).agg(F.count("*").alias("size"))
    for c in columns:
        best = top_values(members, [cluster], c, top)
        lists = best.groupBy(cluster).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("value_rank", F.col(c).alias("_v")))), lambda x: x["_v"]), "|").alias(f"top_{c}"))
        out = out.join(lists, cluster, "left")
    return out
