"""Queries that write the tables in the sources' layouts and read them back, with their oracle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import text as X
from larkspur.operators import versions as V
from larkspur.plans import adapters as A
from larkspur.session import scratch
from larkspur.sources import ingest as I
from larkspur.sources import sinks as K


def _posting_files(s, d) -> str:
    """Two platforms' CSV folders with headers in two languages and two encodings."""
    root = scratch(s, "postings")
    p = A.postings(s, d).withColumn("salary", F.format_string("%.2f", "salary"))
    chinese = p.where("jd_id % 2 = 0").select(F.col("jd_id").alias("职位ID"), F.when(F.col("jd_id") % 3 == 0, "N/A").otherwise(F.col("role")).alias("职位名称"), F.col("company_name").alias("公司全称"), F.date_format("posted_at", "yyyy/M/d").alias("发布日期"), F.col("location").alias("工作地点"), F.col("salary").alias("薪资"), F.col("level").alias("别的"))
    english = p.where("jd_id % 2 = 1").select(F.col("jd_id").alias("job_id"), F.col("role").alias("job_name"), F.col("company_name").alias("company"), F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss").alias("publish_time"), F.col("location").alias("city"), "salary", F.col("level").alias("other"))
    chinese.write.option("header", True).option("encoding", "UTF-16").csv(f"{root}/liepin/2024")
    english.write.option("header", True).csv(f"{root}/boss")
    return root


def _read_postings(s, d) -> DataFrame:
    files = I.discover(s, _posting_files(s, d), (".csv",)).where("size > 2").select("path", "encoding").collect()
    parts = {}
    for f in files:
        parts.setdefault((f.encoding, "/liepin/" in f.path), []).append(f.path)
    return reduce(DataFrame.unionByName, [I.with_identity(I.usable(I.canonical(I.read_csv(s, paths, encoding)))) for (encoding, _), paths in sorted(parts.items())])


def _csv(s, d):
    return _read_postings(s, d).select("job_id", "title", "company", "location", "salary", "platform", "observed_epoch", "raw_uid", "version_id", F.coalesce(F.get_json_object("extra_json", "$.别的"), F.get_json_object("extra_json", "$.other")).alias("extra"))


def _preflight(s, d):
    found = I.preflight(_read_postings(s, d)).withColumn("platform", F.when(F.col("source_file").contains("/liepin/"), "liepin").otherwise("boss"))
    return found.groupBy("platform").agg(F.sum("rows").alias("rows"), F.sum("unusable").alias("unusable"), F.min("sample_title").alias("sample_title"))


def _ranked(s, d):
    """The three best-paid postings of each platform, in order."""
    rows = _read_postings(s, d).withColumn("id", F.col("job_id").cast("long"))
    return I.ranked_sample(rows, "platform", F.col("salary").cast("double"), "id", 3).select("platform", "job_id", "salary")


def _json(s, d):
    """JSON lines of suppliers, and an envelope for each nation."""
    root = scratch(s, "json")
    A.table(s, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("jobID"), F.col("s_name").alias("title"), F.lit("").alias("jd")).write.json(f"{root}/lines")
    nation = A.table(s, d, "nation")  # 25 rows, whatever the scale
    item = F.struct(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name")).alias("title"), F.col("n_name").alias("company"))
    nation.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("value")).coalesce(1).write.option("lineSep", "\n").text(f"{root}/wrapped")
    lines = I.canonical(I.read_json(s, [f"{root}/lines"], lines=True))
    wrapped = I.canonical(I.read_json(s, [f"{root}/wrapped"], lines=True))
    return I.usable(lines.unionByName(wrapped)).select("job_id", "title", "company")


def _sinks(s, d):
    """What each sink holds when it is read again."""
    root = scratch(s, "sinks")
    p = A.postings(s, d).select("jd_id", "role", "location", "salary")
    K.write_tables({"postings": p}, f"{root}/tables")
    K.write_reports(p, "role", f"{root}/reports")
    K.write_json_lines(p, f"{root}/lines")
    edges = p.select(F.col("jd_id").alias("source"), F.col("role").alias("target"), "salary")
    K.write_graph({"Role": p.select("role").distinct()}, {"HAS_ROLE": edges}, f"{root}/graph")
    K.append_column(p, "level", F.lit("x")).write.parquet(f"{root}/copied")
    total = lambda c="salary": F.round(F.sum(F.col(c).cast("double")), 2).alias("total")
    of = lambda df, name, c="salary": df.agg(F.count("*").alias("rows"), total(c)).select(F.lit(name).alias("sink"), "rows", "total")
    csv = lambda path: s.read.option("header", True).csv(path)
    return reduce(DataFrame.union, [
        of(s.read.parquet(f"{root}/tables/postings"), "tables"), of(csv(f"{root}/reports").where("role is not null"), "reports"), of(s.read.json(f"{root}/lines"), "lines"),
        of(csv(f"{root}/graph/edges/HAS_ROLE"), "edges"), of(csv(f"{root}/graph/nodes/Role").withColumn("one", F.lit(1)), "nodes", "one"), of(s.read.parquet(f"{root}/copied").where("level = 'x'"), "copied"),
    ])


def _replaced(s, d):
    m = A.mentions(s, d).select("jd_id", "seq", "skill_id")
    return V.replaced(m, m.where("jd_id % 7 = 0 and seq = 1").withColumn("skill_id", F.upper("skill_id")), "jd_id")


def _store(s, d):
    """The active table after each of publish, publish, rollback and deactivate."""
    store, p = V.SnapshotStore(s, scratch(s, "store")), A.postings(s, d).select("jd_id", "role")
    one, two = p.where("jd_id % 2 = 0"), p
    steps = []
    for name, act in (("first", lambda: store.publish({"postings": one})), ("second", lambda: store.publish({"postings": two}, expected_version=1)), ("again", lambda: store.publish({"postings": two})), ("rollback", store.rollback)):
        act()
        steps.append(store.read("postings").agg(F.count("*").alias("rows")).select(F.lit(name).alias("step"), F.lit(store.status()["version"]).cast("long").alias("version"), "rows"))
    store.deactivate()
    steps.append(s.range(1).select(F.lit("deactivated").alias("step"), F.lit(store.status()["version"]).cast("long").alias("version"), F.lit(0).cast("long").alias("rows")))
    return reduce(DataFrame.union, steps)


def _problems(s, d):
    p, m = A.postings(s, d), A.mentions(s, d)
    tables = {"postings": p, "mentions": m.withColumn("jd_id", F.when(F.col("seq") == 2, -F.col("jd_id") - 1).otherwise(F.col("jd_id"))), "roles": p.select(F.col("role").alias("name"))}
    return V.problems(tables, {"postings": ["jd_id"], "roles": ["name"]}, [("mentions", "jd_id", "postings", "jd_id")], {"mentions": F.col("confidence") >= 0.95})


def _backfilled(s, d):
    p = A.postings(s, d).select("jd_id", "role", "level")
    return V.backfilled(p, p.where("jd_id % 4 = 0").select("jd_id", F.lower("role").alias("role")), "jd_id", "role", F.col("level") == "F")


def _columns(s, d):
    part = A.table(s, d, "part").select("p_partkey", "p_name")
    return I.has_columns(part, ("p_partkey",), {"p_name": "none", "confidence": 0.5})


QUERIES = {
    "ingest_csv": (
        _csv,
        """SELECT job_id, title, company, location, salary, platform, observed_epoch, uid AS raw_uid, uid || ':' || substr(sha256(concat_ws(chr(31), '', company, '', '', '', '', '', '', '', '', location, posted, '', salary, '', '', '', '', title)), 1, 32) AS version_id, extra FROM (
           SELECT *, substr(sha256('' || chr(31) || platform || chr(31) || job_id), 1, 40) AS uid FROM (SELECT jd_id::VARCHAR AS job_id, CASE WHEN jd_id % 6 = 0 THEN '' ELSE role END AS title, company_name AS company, location, printf('%.2f', salary) AS salary, CASE WHEN jd_id % 2 = 0 THEN 'liepin' ELSE 'boss' END AS platform, epoch(posted_at)::BIGINT AS observed_epoch, CASE WHEN jd_id % 2 = 0 THEN strftime(posted_at, '%Y/%-m/%-d') ELSE strftime(posted_at, '%Y-%m-%d %H:%M:%S') END AS posted, level AS extra FROM postings WHERE jd_id % 6 <> 0))""",
    ),
    "source_preflight": (
        _preflight,
        "SELECT CASE WHEN jd_id % 2 = 0 THEN 'liepin' ELSE 'boss' END AS platform, count(*)::BIGINT AS rows, 0::BIGINT AS unusable, min(role) AS sample_title FROM postings WHERE jd_id % 6 <> 0 GROUP BY ALL",
    ),
    "ranked_sample": (
        _ranked,
        "SELECT platform, jd_id::VARCHAR AS job_id, printf('%.2f', salary) AS salary FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY salary DESC, jd_id) AS k FROM (SELECT *, CASE WHEN jd_id % 2 = 0 THEN 'liepin' ELSE 'boss' END AS platform FROM postings WHERE jd_id % 6 <> 0)) WHERE k <= 3",
    ),
    "ingest_json": (
        _json,
        "SELECT 's' || s_suppkey AS job_id, s_name AS title, '' AS company FROM supplier UNION ALL SELECT 'n' || n_nationkey, n_name, n_name FROM nation WHERE n_nationkey % 5 <> 0",
    ),
    "sink_round_trips": (
        _sinks,
        """SELECT sink, rows, total FROM (SELECT count(*) AS rows, round(sum(salary), 2) AS total FROM postings), (SELECT unnest(['tables', 'reports', 'lines', 'edges', 'copied']) AS sink)
           UNION ALL SELECT 'nodes', count(DISTINCT role), count(DISTINCT role)::DOUBLE FROM postings""",
    ),
    "replaced_mentions": (
        _replaced,
        "SELECT jd_id, seq, CASE WHEN jd_id % 7 = 0 AND seq = 1 THEN upper(skill_id) ELSE skill_id END AS skill_id FROM mentions WHERE jd_id NOT IN (SELECT jd_id FROM mentions WHERE jd_id % 7 = 0 AND seq = 1) OR seq = 1",
    ),
    "snapshot_store": (
        _store,
        "SELECT unnest(['first', 'second', 'again', 'rollback', 'deactivated']) AS step, unnest([1, 2, 2, 3, 4]::BIGINT[]) AS version, unnest([half, n, n, half, 0]) AS rows FROM (SELECT count(*) AS n, count(*) FILTER (jd_id % 2 = 0) AS half FROM postings)",
    ),
    "snapshot_problems": (
        _problems,
        """SELECT 'repeated:postings' AS problem, 0::BIGINT AS n UNION ALL SELECT 'repeated:roles', count(*) FROM (SELECT role FROM postings GROUP BY role HAVING count(*) > 1) UNION ALL SELECT 'unknown:mentions.jd_id', count(*) FROM mentions WHERE seq = 2 UNION ALL SELECT 'floor:mentions', count(*) FROM mentions WHERE confidence < 0.95::DOUBLE""",
    ),
    "backfilled_roles": (
        _backfilled,
        "SELECT jd_id, CASE WHEN jd_id % 4 = 0 AND level <> 'F' THEN lower(role) ELSE role END AS role, level, role AS role_before FROM postings",
    ),
    "optional_columns": (_columns, "SELECT p_partkey, p_name, 0.5::DOUBLE AS confidence FROM part"),
    "changed_fingerprint": (
        lambda s, d: s.range(1).select(F.lit(V.fingerprint(A.table(s, d, "nation")) == V.fingerprint(A.table(s, d, "nation").orderBy(F.desc("n_nationkey")))).alias("same"), F.lit(V.fingerprint(A.table(s, d, "nation")) == V.fingerprint(A.table(s, d, "nation").where("n_nationkey > 0"))).alias("same_after_loss")),
        "SELECT true AS same, false AS same_after_loss",
    ),
    "report_cells": (
        lambda s, d: A.table(s, d, "part").select("p_partkey", F.regexp_replace(F.regexp_replace(F.concat("p_name", F.lit("|"), "p_type"), r"\|", r"\\|"), "\n", "<br>").alias("cell"), X.template_hash(F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"))).alias("template")),
        "SELECT p_partkey, p_name || '\\|' || p_type AS cell, sha256(regexp_replace(regexp_replace(lower(p_name || ' ' || p_size), '\\s+', '', 'g'), '[0-9]+', '#', 'g')) AS template FROM part",
    ),
}
