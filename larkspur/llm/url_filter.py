"""URL filter by a path-template tree, in DataFrame functions only.

Explicit rules decide first.  For the rest, the paths of a host form a tree.  From the
root down, a segment is generalised to a wildcard if it holds a digit, or if its parent
has many children and it is a rare one.  From the leaves up, sibling branches, that is
templates that differ in one segment alone, are merged where a test of two samples finds
no difference between their labels.  A branch without
labels can't be compared and stays on its own.  A template, or merged group, is rejected
when its purity, that is the share of rejections among its labelled rows, smoothed
towards the share among all labelled rows, reaches a threshold; one without labelled
rows is not rejected.  Labels are the rules' own decisions and, for rows that no rule
fits, a column of the table if one is named.

Counts are aggregated by host and path shape before anything else, so a host with many
pages has few rows, and joins on hosts spread their rows by a salt.  The tree is as deep
as the deepest path; a level costs a few joins of these counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import salted_join, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, for paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Options:
    """``children`` beyond which a parent's rare children are generalised, namely those
    with less than ``share`` of its rows; ``z`` within which branches are alike;
    ``weight`` of the prior in rows; ``purity`` that rejects."""

    children: int = 20
    share: float = 0.05
    z: float = 1.96
    weight: float = 4.0
    purity: float = 0.7


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty where the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(authority) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(authority, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, value(r)).otherwise(out)
    return out


def templates(counts: DataFrame, options: Options) -> DataFrame:
    """``counts`` with each row's ``template``, an array of segments.

    Only a parent with more than ``children`` children names any of them anew, so a row
    goes straight to the first such parent on its path, over chains of whatever length;
    what lies below it is known once its child is named.  A row without one is done, and
    so are all rows of a branch with no more than ``children`` shapes.  The rounds are as
    many as the most such parents on one path, and each reads every open row's segments.
    """
    segments = F.expr("slice(split(shape, '/'), 2, greatest(size(split(shape, '/')) - 1, 0))")
    open_ = counts.select("*", segments.alias("segs"), F.array().cast("array<string>").alias("template"), F.lit(0).alias("level"))
    done, branch, step = [], ["host", "template"], ["host", "template", "at", "above"]
    while True:
        shapes = open_.groupBy(*branch).agg(F.count("*").alias("shapes")).where(F.col("shapes") > options.children)
        parts = F.posexplode(F.slice("segs", F.col("level") + 1, F.greatest(F.size("segs") - F.col("level"), F.lit(0)))).alias("i", "child")
        # The parent of each open segment: how far down, and two hashes of what leads there from the branch.
        path = F.concat_ws("/", F.slice("segs", F.col("level") + 1, F.col("i")))
        below = salted_join(open_, shapes, branch, "left_semi").select("host", "shape", "n", "template", "segs", "level", parts)
        below = below.select("host", "shape", "n", "template", (F.col("level") + F.col("i")).alias("at"), F.struct(F.xxhash64(path), F.xxhash64(F.lit(1), path)).alias("above"), "child")
        children = below.groupBy(*step, "child").agg(F.sum("n").alias("rows"))
        parents = children.groupBy(*step).agg(F.count("*").alias("kids"), F.sum("rows").alias("all_rows")).where(F.col("kids") > options.children)
        rare = F.col("rows") < options.share * F.col("all_rows")
        named = salted_join(children, parents, step).select(*step, "child", F.when(rare, "*").otherwise(F.col("child")).alias("name"))
        first = salted_join(below, named, [*step, "child"]).groupBy("host", "shape").agg(F.min(F.struct("at", "name")).alias("first"))
        tree = written(salted_join(open_, first, ["host", "shape"], "left"), "tree")
        rest = F.slice("segs", F.col("level") + 1, F.greatest(F.size("segs") - F.col("level"), F.lit(0)))
        done.append(tree.where("first is null").withColumn("template", F.concat("template", rest)).select(*counts.columns, "template"))
        open_ = tree.where("first is not null")
        if open_.isEmpty():
            break
        chain = F.slice("segs", F.col("level") + 1, F.col("first.at") - F.col("level"))
        open_ = open_.withColumn("template", F.concat("template", chain, F.array("first.name"))).withColumn("level", F.col("first.at") + 1).drop("first")
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def merged(whole: DataFrame, options: Options) -> DataFrame:
    """``host, template, grp`` and the counts of ``whole``: sibling branches that are alike share a group.

    Siblings are ordered by their share of rejections, and one begins a new group if it
    differs from the one before it.  A parent has no more children than ``options``
    allows, so a family is a few rows.  A group's merged segment is ``+`` and a number.
    Levels go from the leaves up, in each host by itself, and only those at which two
    branches with labels are siblings.
    """
    alone = whole.where("known = 0").withColumn("grp", F.col("template"))
    rows = whole.where("known > 0").withColumn("grp", F.col("template")).withColumn("level", F.lit(1 << 30))

    def with_segment(level: Column, name: Column) -> Column:
        return F.concat(F.slice("grp", F.lit(1), level - 1), F.array(name), F.slice("grp", level + 1, F.size("grp") - level))

    def siblings(level: Column) -> Column:
        kin = F.to_json(with_segment(level, F.lit("*")))
        return F.struct(F.xxhash64(kin), F.xxhash64(F.lit(1), kin))

    while True:
        branches = rows.groupBy("host", "grp", "level").agg(F.sum("bad").alias("x"), F.sum("known").alias("k"))
        highest = F.least(F.size("grp"), F.col("level") - 1)
        each = branches.where(highest > 0).select("host", "grp", F.explode(F.sequence(F.lit(1), highest)).alias("i"))
        levels = each.groupBy("host", "i", siblings(F.col("i")).alias("kin")).agg(F.count("*").alias("n")).where("n > 1").groupBy("host").agg(F.max("i").alias("next"))
        levels = written(levels, "levels")
        if levels.isEmpty():
            return rows.drop("level").unionByName(alone)
        # A host without siblings is finished.
        branches = salted_join(branches.drop("level"), levels, ["host"]).where(F.size("grp") >= F.col("next")).withColumn("family", with_segment(F.col("next"), F.lit("*")))
        order = Window.partitionBy("host", "family").orderBy(F.col("x") / F.col("k"), "grp")
        branches = branches.withColumn("x0", F.lag("x").over(order)).withColumn("k0", F.lag("k").over(order))
        x, k, x0, k0 = map(F.col, ("x", "k", "x0", "k0"))
        p = (x + x0) / (k + k0)
        unlike = F.abs(x / k - x0 / k0) > options.z * F.sqrt(p * (1 - p) * (1 / k + 1 / k0))
        branches = branches.withColumn("cluster", F.sum(F.coalesce(unlike, F.lit(False)).cast("int")).over(order))
        members = F.count("*").over(Window.partitionBy("host", "family", "cluster"))
        same = branches.withColumn("members", members).where("members > 1").select("host", "grp", with_segment(F.col("next"), F.concat(F.lit("+"), "cluster")).alias("to"))
        rows = salted_join(rows.drop("level"), levels, ["host"], "left").withColumn("level", F.coalesce("next", F.lit(0))).drop("next")
        rows = written(salted_join(rows, same, ["host", "grp"], "left").withColumn("grp", F.coalesce("to", "grp")).drop("to"), "merged")


def judge(pages: DataFrame, rules: tuple[Rule, ...], *, key: str = "page_id", url_column: str = "url", label_column: str | None = None, options: Options = Options()) -> DataFrame:  # noqa: B008
    """``key, host, path, rule, verdict, template`` of every row of ``pages``.

    ``label_column`` holds ``block``, ``allow`` or null (or anything else: no label).  A
    null url, or one without ``://``, has an empty host and path, which form a template
    of their own.  Rows that repeat or have a null key each get a row; an empty table
    gives an empty result; other columns are not read.
    """
    host, path = host_and_path(F.col(url_column))
    label = F.lit(None).cast("string") if label_column is None else F.col(label_column)
    rows = pages.select(F.col(key), host.alias("host"), path.alias("path"), label.alias("label"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules, str))
    rows = rows.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules, lambda r: r.verdict))
    rows = rows.withColumn("shape", F.regexp_replace("path", r"/[^/.]*[0-9][^/.]*", "/*"))
    known = F.coalesce("ruled", "label")
    counts = rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count(F.when(known == "block", 1)).alias("bad"), F.count(F.when(known.isin("block", "allow"), 1)).alias("known"))
    counts = written(counts, "counts")

    tree = templates(counts, options)
    whole = written(tree.groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in ("n", "bad", "known"))), "whole")
    base = whole.agg(F.try_divide(F.sum("bad"), F.sum("known")).alias("base"))
    groups = merged(whole, options)
    sums = groups.groupBy("host", "grp").agg(F.sum("bad").alias("x"), F.sum("known").alias("k"))
    purity = (F.col("x") + options.weight * F.col("base")) / (F.col("k") + options.weight)
    judged = sums.crossJoin(F.broadcast(base)).select("host", "grp", F.when((F.col("k") > 0) & (purity >= options.purity), "block").otherwise("allow").alias("learned"))  # one row
    by_template = salted_join(groups.select("host", "template", "grp"), judged, ["host", "grp"]).select("host", "template", "learned")
    by_shape = salted_join(tree.select("host", "shape", "template"), by_template, ["host", "template"])
    template = F.concat_ws("/", F.array(F.lit("")), "template").alias("template")
    return salted_join(rows, by_shape, ["host", "shape"]).select(key, "host", "path", "rule", F.coalesce("ruled", "learned").alias("verdict"), template)


def judge_sql(rules: tuple[Rule, ...], *, table: str = "pages", key: str = "page_id", url_column: str = "url", depth: int = 4, options: Options = Options()) -> str:  # noqa: B008
    """The result of ``judge`` in DuckDB's SQL, for paths of at most ``depth`` segments."""
    o = options

    def case(value) -> str:
        fits = "".join(f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in sorted(rules, key=lambda r: (-len(str(r)), str(r))))
        return f"CASE{fits} END"

    def with_segment(name: str, level: int) -> str:
        return f"list_concat(list_concat(grp[1:{level - 1}], [{name}]), grp[{level + 1}:])"

    levels = ["t0 AS MATERIALIZED (SELECT *, string_split(shape, '/')[2:] AS segs, []::VARCHAR[] AS template FROM counts)"]
    for i in range(1, depth + 1):
        levels += [
            f"c{i} AS MATERIALIZED (SELECT host, template, segs[{i}] AS child, sum(n) AS kid FROM t{i - 1} WHERE len(segs) >= {i} GROUP BY ALL)",
            f"p{i} AS (SELECT host, template, count(*) AS kids, sum(kid) AS total FROM c{i} GROUP BY ALL)",
            f"n{i} AS (SELECT c.host, c.template, c.child, CASE WHEN p.kids > {o.children} AND c.kid < {o.share}::DOUBLE * p.total THEN '*' ELSE c.child END AS name FROM c{i} c JOIN p{i} p USING (host, template))",
            f"t{i} AS MATERIALIZED (SELECT t.host, t.shape, t.n, t.bad, t.known, t.segs, CASE WHEN len(t.segs) >= {i} THEN list_append(t.template, x.name) ELSE t.template END AS template FROM t{i - 1} t LEFT JOIN n{i} x ON t.host = x.host AND t.template = x.template AND t.segs[{i}] = x.child)",
        ]
    merges = [f"m{depth + 1} AS MATERIALIZED (SELECT host, template, template AS grp, sum(bad)::DOUBLE AS bad, sum(known)::DOUBLE AS known FROM t{depth} GROUP BY ALL)"]
    for i in range(depth, 0, -1):
        merges += [
            f"b{i} AS (SELECT host, grp, {with_segment("'*'", i)} AS family, sum(bad) AS x, sum(known) AS k FROM m{i + 1} WHERE len(grp) >= {i} GROUP BY ALL HAVING sum(known) > 0)",
            f"l{i} AS (SELECT *, lag(x) OVER siblings AS x0, lag(k) OVER siblings AS k0 FROM b{i} WINDOW siblings AS (PARTITION BY host, family ORDER BY x / k, grp))",
            f"u{i} AS (SELECT *, sum(coalesce(abs(x / k - x0 / k0) > {o.z}::DOUBLE * sqrt((x + x0) / (k + k0) * (1 - (x + x0) / (k + k0)) * (1 / k + 1 / k0)), false)::INT) OVER (PARTITION BY host, family ORDER BY x / k, grp) AS cluster FROM l{i})",
            f"a{i} AS (SELECT host, grp, {with_segment("'+' || cluster", i)} AS moved FROM u{i} QUALIFY count(*) OVER (PARTITION BY host, family, cluster) > 1)",
            f"m{i} AS MATERIALIZED (SELECT m.host, m.template, coalesce(a.moved, m.grp) AS grp, m.bad, m.known FROM m{i + 1} m LEFT JOIN a{i} a ON m.host = a.host AND m.grp = a.grp)",
        ]
    return f"""
WITH r0 AS (SELECT {key}, CASE WHEN strpos({url_column}, '://') > 0 THEN substr({url_column}, strpos({url_column}, '://') + 3) ELSE '' END AS rest FROM {table}),
r1 AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS authority FROM r0),
r2 AS (SELECT {key}, translate(authority, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(authority) + 1), '^[^?#]*') AS path FROM r1),
r3 AS MATERIALIZED (SELECT *, {case(str)} AS rule, {case(lambda r: r.verdict)} AS ruled, regexp_replace(path, '/[^/.]*[0-9][^/.]*', '/*', 'g') AS shape FROM r2),
counts AS (SELECT host, shape, count(*) AS n, count(*) FILTER (ruled = 'block') AS bad, count(*) FILTER (ruled IS NOT NULL) AS known FROM r3 GROUP BY ALL),
{", ".join(levels)},
{", ".join(merges)},
judged AS (SELECT host, grp, CASE WHEN sum(known) > 0 AND (sum(bad) + {o.weight}::DOUBLE * (SELECT sum(bad) / sum(known) FROM m1)) / (sum(known) + {o.weight}::DOUBLE) >= {o.purity}::DOUBLE THEN 'block' ELSE 'allow' END AS learned FROM m1 GROUP BY ALL)
SELECT r.{key}, r.host, r.path, r.rule, coalesce(r.ruled, j.learned) AS verdict, array_to_string(list_concat([''], t.template), '/') AS template
FROM r3 r JOIN t{depth} t USING (host, shape) JOIN m1 g USING (host, template) JOIN judged j USING (host, grp)
"""
