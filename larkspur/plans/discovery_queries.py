"""Queries of titles, abilities, resolution, consolidation, discovery and review, with their oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import stats
from larkspur.functions import text as X
from larkspur.functions import titles as T
from larkspur.operators import cluster as CL
from larkspur.operators import concepts as C
from larkspur.operators import consolidation as N
from larkspur.operators import discovery as DS
from larkspur.operators import editjoin as EJ
from larkspur.operators import evidence as EV
from larkspur.operators import evolution as E
from larkspur.operators import matching as M
from larkspur.operators import review as R
from larkspur.operators import serve as SV
from larkspur.operators import similarity as S
from larkspur.plans import adapters as A
from larkspur.plans import evolution_queries as EQ
from larkspur.plans.adapters import CTES
from larkspur.session import all_tasks, written

_HEADS = ("高级", "资深 ", "急招", "", "初级", "（北京）", "P6 ", "【校招】")
_CORES = ("Java开发工程师", "大模型应用", "自然语言处理", "数据产品经理", "软件测试", "网络运维", "嵌入式软件工程师", "硬件开发", "go语言开发", "财务主管", "ETL工程师", "前端负责人", "算法研究", "客服")
_TAILS = ("", "（AI方向）", "-后端方向", " 专家", "招聘", "(急聘)", "/运维工程师", "负责人")


def _made_titles(s, d) -> DataFrame:
    """Titles of a head, a core and a tail that follow from a part's key."""
    pick = lambda words, by: F.element_at(F.array(*(F.lit(w) for w in words)), (F.floor(F.col("p_partkey") / by) % len(words) + 1).cast("int"))
    return all_tasks(A.table(s, d, "part").select("p_partkey")).select("p_partkey", F.concat(pick(_HEADS, 1), pick(_CORES, 3), pick(_TAILS, 7)).alias("title"))


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


CTES["made_titles"] = "SELECT p_partkey, " + " || ".join(f"{_list(w)}[(p_partkey // {by}) % {len(w)} + 1]" for w, by in ((_HEADS, 1), (_CORES, 3), (_TAILS, 7))) + " AS title FROM part"


def _role_title_sql() -> str:
    norm = "regexp_replace(lower(title), '[^0-9a-z一-鿿+#.]', '', 'g')"
    rules = " ".join(f"WHEN regexp_matches({norm}, '{p}') THEN '{n}'" for p, n in T.ROLE_RULES)
    rest = "regexp_replace(regexp_replace(regexp_replace(title, '[（(].*?[）)]', '', 'g'), '高级|资深|初级|中级|专家|实习|急聘|诚聘|招聘|\\s+', '', 'g'), '^[-_/·,，。 ]+|[-_/·,，。 ]+$', '', 'g')"
    return f"SELECT p_partkey, CASE {rules} WHEN length({rest}) BETWEEN 2 AND 24 THEN {rest} ELSE 'none' END AS role FROM made_titles"


def _abilities(s, d) -> DataFrame:
    """A model's answer around each part's abilities."""
    j = F.to_json(F.struct(F.array("p_brand", "p_type", "p_brand").alias("知识"), F.concat_ws("、", "p_name", F.lit("nothing"), F.col("p_size").cast("string")).alias("技术")))
    return A.table(s, d, "part").select(F.col("p_partkey").alias("doc_id"), F.concat(F.lit("Here it is:\n```json\n"), j, F.lit("\n``` done")).alias("answer"), F.concat_ws(" ", "p_name", "p_type").alias("text"))


def _terms(s, d):
    rows = _abilities(s, d).select("doc_id", F.to_json(EV.salvaged_json(F.col("answer"))).alias("j"))
    return EV.ability_terms(rows, "doc_id", "j")


CTES["terms"] = """SELECT p_partkey AS doc_id, '知识' AS category, unnest(list_distinct([p_brand, p_type])) AS term FROM part
    UNION ALL SELECT p_partkey, '技术', unnest(list_distinct([p_name, 'nothing', p_size::VARCHAR])) FROM part"""


def _duties(s, d):
    """Two duties of a part between headings, after and before what isn't one."""
    t = F.concat(F.lit("岗位职责：1、负责"), "p_name", F.lit("的开发。\n2. 维护"), "p_type", F.lit("的系统；薪资福利面议很好的\n短句\n3、负责"), "p_name", F.lit("的开发。任职要求：本科以上学历和经验"))
    return A.table(s, d, "part").select("p_partkey", F.concat_ws("|", T.responsibilities(t)).alias("duties"))


def _precedence(s, d):
    p = A.postings(s, d).select("jd_id", "role", "level")
    sources = [("reviewer", p.where("jd_id % 5 = 0").select("jd_id", F.lit("R").alias("name"))), ("model", p.where("jd_id % 3 = 0").select("jd_id", F.lit("M").alias("name"))), ("rule", p.where("jd_id % 2 = 0").select("jd_id", F.col("role").alias("name")))]
    return C.by_precedence(p.select("jd_id"), sources, "jd_id", "name").withColumn("name", F.coalesce("name", F.lit("raw")))


def _mapping(s, d):
    p = A.postings(s, d)
    rows = p.select(F.col("location").alias("key"))
    known = p.select(F.col("location").alias("key"), "level").distinct().where("key < 'P'").select("key")
    return C.complete_mapping(rows, known, "key")


def _approved(s, d):
    rows = A.mentions(s, d).select("jd_id", "seq", F.col("requirement").alias("match_type"), "status")
    return C.approved(rows, {("required", "VERIFIED"), ("preferred", "LOW_CONFIDENCE")})


def _resolution(s, d):
    rows = A.postings(s, d).select("jd_id", (F.col("salary") / 500000).alias("x"), "level", "industry")
    out = S.resolution(rows, F.col("jd_id") % 11 == 0, F.col("jd_id") % 7 == 0, F.col("level") == "P", F.col("x"), 0.5, 0.3)
    return out.select("jd_id", "decision")


def _fallback(s, d):
    m = A.mentions(s, d).select("jd_id", "skill_id")
    return EV.fallback(m.where("jd_id % 3 = 0").withColumn("by", F.lit("analysis")), m.where("jd_id % 2 = 0").withColumn("by", F.lit("rules")), "jd_id").distinct()


def _families(s, d):
    rules = [("steel", "METAL"), ("brass|copper|tin|nickel", "ALLOY"), ("promo", "OFFER")]
    groups = {"build": ("steel", "copper"), "finish": ("polished", "plated")}
    p = A.table(s, d, "part")
    return p.select(
        "p_partkey", X.first_rule(F.lower("p_type"), rules, F.lit("unknown")).alias("family"), M.function_conflict(F.col("p_type"), F.lit("POLISHED TIN"), groups).alias("conflict"),
        X.surface_form(F.concat(F.lit("熟练掌握"), "p_name", F.lit("（任意）能力"))).alias("surface"), R.non_capability(F.concat("p_name", F.when(F.col("p_size") > 25, "工作经验").otherwise(""))).alias("no_ability"),
    )


def _registry_pairs(s, d) -> DataFrame:
    """Every part against ten registered ones, with similarities that follow from the keys."""
    p = A.table(s, d, "part")
    left = all_tasks(p.where("p_partkey > 10")).select(F.col("p_partkey").alias("group"), F.col("p_name").alias("group_name"), F.substring("p_brand", 7, 1).alias("group_category"))
    right = p.where("p_partkey <= 10").select(F.col("p_partkey").alias("registry"), F.col("p_name").alias("registry_name"), F.substring("p_brand", 7, 1).alias("registry_category"))
    pairs = left.join(F.broadcast(right), how="cross")  # ten rows, whatever the scale
    n = F.col("group") * 31 + F.col("registry") * 17
    return pairs.select("*", (n % 10).alias("rank"), (0.86 + (n % 15) / 100).alias("phrase"), (0.9 + (n % 11) / 100).alias("context"), (0.4 + (n % 61) / 100).alias("lexical"))


CTES["registry_pairs"] = """SELECT *, n % 10 AS rank, 0.86::DOUBLE + (n % 15) / 100 AS phrase, 0.9::DOUBLE + (n % 11) / 100 AS context, 0.4::DOUBLE + (n % 61) / 100 AS lexical FROM (
    SELECT a.p_partkey AS grp, a.p_name AS group_name, substr(a.p_brand, 7, 1) AS group_category, b.p_partkey AS registry, b.p_name AS registry_name, substr(b.p_brand, 7, 1) AS registry_category, a.p_partkey * 31 + b.p_partkey * 17 AS n FROM part a, part b WHERE a.p_partkey > 10 AND b.p_partkey <= 10)"""
_WORDS = "regexp_extract_all(lower({}), '[a-z][a-z0-9+#.]+')"
_NORM = "replace(lower({}), ' ', '')"


def _cluster_edges(s, d):
    pairs = _registry_pairs(s, d).withColumnsRenamed({"group": "a", "registry": "b", "group_name": "a_name", "registry_name": "b_name"})
    return N.cluster_edges(pairs.withColumn("by_name", F.col("rank") < 3).withColumn("phrase", F.col("phrase") + 0.02))


def _edges_sql() -> str:
    x, y = _WORDS.format("group_name"), _WORDS.format("registry_name")
    na, nb = _NORM.format("group_name"), _NORM.format("registry_name")
    grams = "list_transform(range(1, length({0})), lambda i: substr({0}, i::INT, 2))"
    overlap = f"(contains({na}, {nb}) OR contains({nb}, {na}) OR len(list_intersect({grams.format(na)}, {grams.format(nb)})) > 0)"
    return f"""SELECT DISTINCT grp AS a, registry AS b FROM (SELECT *, phrase + 0.02::DOUBLE AS p, {overlap} AS o, len(list_intersect({x}, {y})) = 0 AS apart FROM registry_pairs)
        WHERE CASE WHEN rank < 3 THEN 0.65::DOUBLE * p + 0.25::DOUBLE * context + 0.1::DOUBLE * lexical >= 0.94::DOUBLE AND p >= 0.88::DOUBLE
        ELSE p >= CASE WHEN o THEN 0.96::DOUBLE ELSE 0.98::DOUBLE END AND context >= CASE WHEN o THEN 0.93::DOUBLE ELSE 0.95::DOUBLE END AND 0.72::DOUBLE * p + 0.28::DOUBLE * context >= 0.95::DOUBLE AND NOT apart END"""


def _rollup(s, d):
    """Skills by their first word as concepts."""
    m = all_tasks(A.mentions(s, d), "jd_id").join(A.postings(s, d).select("jd_id", "company_id"), "jd_id")
    rows = m.select(F.substring_index("skill_id", " ", 1).alias("concept"), F.col("skill_id").alias("member"), "company_id", "jd_id", (F.col("status") == "VERIFIED").alias("verified"))
    return N.rolled_up(rows, F.col("concept").startswith("a"))


def _title_pairs(titles: DataFrame) -> DataFrame:
    """Titles of one place that are alike."""
    return EJ.similar_texts(titles.withColumn("place", F.substring_index("title", "/", 1)), "title", 0.78, "place").select("a", "b")


def _concept_records(s, d):
    """A title is a place and a company; those of one place are alike."""
    return EQ.records(s, d).withColumn("title", F.concat_ws("/", F.concat_ws("-", "location", "industry"), "level"))


def _discovery(s, d):
    r = written(_concept_records(s, d), "records")
    template = F.floor(F.col("salary") / 500)
    stats_of = written(E.title_stats(r, template), "title_stats")
    concepts = written(DS.title_concepts(stats_of, _title_pairs(stats_of)), "concepts")
    rolled = DS.rolled_up(r, concepts, template)
    known = s.createDataFrame([("FRANCE-BUILDING/F",), ("CHINA-BUILDING/O",)], "title string")
    aliases = s.createDataFrame([("PERU-BUILDING/F", "FRANCE-BUILDING/F"), ("INDIA-BUILDING/F", "ZZ")], "title string, alias string")
    left = DS.unknown_titles(rolled, known, aliases, ("JAPAN-BUILDING/F", "JAPAN-BUILDING/O", "JAPAN-BUILDING/P"))
    runs = E.longest_runs(E.monthly_trend(r.join(concepts, "title").drop("title").withColumnRenamed("concept", "title"), "title"), "title")
    everything = left.join(runs, "title", "left").fillna(0, ["continuous_windows", "growth_windows"])
    found = M.gates(everything, {"new": F.col("historical_jds") + F.col("baseline_jds") == 0, "jds": F.col("current_jds") >= 2, "sources": F.col("current_sources") >= 1})
    return found.select("title", "members", "historical_jds", "baseline_jds", "current_jds", "current_companies", F.array_join("failed", ",").alias("failed"))


CTES["concept_titles"] = "SELECT *, location || '-' || industry || '/' || level AS t2, location || '-' || industry AS place FROM records"
_DISCOVERY = """WITH t AS (SELECT t2 AS title, place, count(*) FILTER (period = 'current') AS c, count(*) AS n FROM concept_titles GROUP BY ALL),
    heads AS (SELECT place, arg_min(title, (-c, -n, length(title), title)) AS title, count(*) AS members FROM t GROUP BY place)
    SELECT title, members, h AS historical_jds, b AS baseline_jds, c AS current_jds, cc AS current_companies, concat_ws(',', CASE WHEN h + b > 0 THEN 'new' END, CASE WHEN c < 2 THEN 'jds' END, CASE WHEN src < 1 THEN 'sources' END) AS failed
    FROM heads JOIN (SELECT place, count(*) FILTER (period = 'historical') AS h, count(*) FILTER (period = 'baseline') AS b, count(*) FILTER (period = 'current') AS c, count(DISTINCT company_id) FILTER (period = 'current') AS cc, count(DISTINCT source_family) FILTER (period = 'current') AS src FROM concept_titles GROUP BY place) USING (place)
    WHERE title NOT IN ('FRANCE-BUILDING/F', 'CHINA-BUILDING/O', 'PERU-BUILDING/F', 'JAPAN-BUILDING/F', 'JAPAN-BUILDING/O', 'JAPAN-BUILDING/P')"""


def _packets(s, d):
    p = A.table(s, d, "part")
    return p.select(F.col("p_partkey").alias("priority"), R.packet_key(F.col("p_brand"), F.col("p_size")).alias("key"), F.concat_ws(" ", "p_brand", F.col("p_size").cast("string")).alias("packet"))


def _reviewed(s, d):
    """Brands of even digits are in the cache; thirty more packets may be sent."""
    packets = _packets(s, d)
    cache = packets.where("cast(substr(packet, 7, 1) as int) % 2 = 0").select("key", F.upper("packet").alias("answer")).distinct()
    return R.reviewed(packets, cache, str.lower, 30).select("priority", "packet", "answer", "source")


_REVIEWED = """WITH p AS (SELECT p_partkey AS priority, p_brand || ' ' || p_size AS packet, sha256(p_brand || chr(31) || p_size) AS key, substr(p_brand, 7, 1)::INT % 2 = 0 AS cached FROM part),
    sent AS (SELECT key FROM p WHERE NOT cached GROUP BY key ORDER BY min(priority), key LIMIT 30)
    SELECT priority, packet, CASE WHEN cached THEN upper(packet) WHEN key IN (SELECT key FROM sent) THEN lower(packet) END AS answer, CASE WHEN cached THEN 'CACHE' WHEN key IN (SELECT key FROM sent) THEN 'REVIEWER' ELSE 'PENDING' END AS source FROM p"""


def _drafts(s, d):
    p = A.table(s, d, "part")
    kind = F.element_at(F.array(*(F.lit(k) for k in (*R.ROLE_ACTIONS, *R.SKILL_ACTIONS, "OTHER"))), (F.col("p_partkey") % 9 + 1).cast("int"))
    rows = p.select(F.col("p_partkey").cast("string").alias("candidate_id"), F.when(F.col("p_size") % 4 == 0, "PENDING").otherwise("COMPLETED").alias("status"), kind.alias("semantic_class"), (F.col("p_size") / 50).alias("confidence"), (F.col("p_partkey") % 4).alias("continuous_windows"), (F.col("p_partkey") % 5).alias("growth_windows"), F.lit(2).alias("sources"))
    return R.patch_draft(rows, "role").union(R.patch_draft(rows, "skill"))


def _drafts_sql() -> str:
    kinds = [*R.ROLE_ACTIONS, *R.SKILL_ACTIONS, "OTHER"]
    both = {**R.ROLE_ACTIONS, **R.SKILL_ACTIONS}
    action = "CASE " + " ".join(f"WHEN k = '{n}' THEN '{a}'" for n, a in both.items()) + " END"
    return f"""SELECT 'graph_change:' || substr(sha1(id || '|' || action), 1, 16) AS change_id, action, id AS candidate_id, 'PENDING' AS approval_status FROM (SELECT *, {action} AS action FROM (SELECT p_partkey::VARCHAR AS id, {_list(kinds)}[p_partkey % 9 + 1] AS k, * FROM part))
        WHERE action IS NOT NULL AND p_size % 4 <> 0 AND p_size / 50 >= 0.7::DOUBLE AND (k NOT IN ({", ".join(f"'{r}'" for r in R.ROLE_ACTIONS)}) OR (p_partkey % 4 >= 2 AND p_partkey % 5 >= 2))"""


def _evidence_ids(s, d):
    p = A.table(s, d, "part")
    inner = F.struct(F.array("p_brand", "p_name").alias("evidence_jd_ids"))
    j = F.to_json(F.struct(F.array("p_type", "p_brand").alias("evidence_jd_ids"), F.array(inner).alias("changes"), F.lit("x").alias("other")))
    texts = F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: F.repeat("p_brand", 10))
    return p.select("p_partkey", F.array_join(R.evidence_ids(j), "|").alias("ids"), F.size(R.compacted(texts, 1500)).alias("kept"), F.length(F.array_join(R.compacted(texts, 1500), "")).alias("characters"))


def _cohesion(s, d):
    pairs = A.mentions(s, d).groupBy(F.col("jd_id").alias("a")).agg((F.max("jd_id") + 1).alias("b"), F.max("confidence").alias("score"))
    members = A.postings(s, d).select(F.col("jd_id").alias("node"), F.floor(F.col("jd_id") / 8).alias("cluster"))
    return CL.cohesion(pairs, members, "score").select("cluster", F.round("cohesion", 6).alias("cohesion"), "pairs")


def _embedded(s, d):
    p = A.table(s, d, "part").select("p_partkey", "p_brand")
    return S.embed_distinct(p, "p_brand").select("p_partkey", F.size("vector").alias("dims"), F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x), 4).alias("length"))


def _closed(s, d):
    r = EQ.records(s, d).select("month").distinct()
    span = A.postings(s, d).agg(F.min("posted_at").alias("lo"), F.max("posted_at").alias("hi"))  # one row
    return r.crossJoin(F.broadcast(span)).select("month", E.closed_month(F.col("month"), F.col("lo"), F.col("hi")).alias("closed"))


def _top_skills(s, d):
    registry = A.postings(s, d).select("role").distinct()
    counts = A.mentions(s, d).join(A.postings(s, d).select("jd_id", "role"), "jd_id").groupBy("role", "skill_id").agg(F.count("*").alias("n"))
    return C.with_top_skills(registry, counts, "role", "skill_id", "n").select("role", F.array_join("skills", "|").alias("skills"))


def _corrected(s, d):
    p = A.postings(s, d).select("jd_id", "role", "level", "industry")
    return C.corrected(p, "role", [("level", F.col("level") == "P", "OPEN"), ("industry", F.col("industry").startswith("B"), "5-LOW")])


def _registry(s, d):
    p = A.postings(s, d)
    return C.registry_of(p, "role", "industry", F.col("level") == "F").select("role", F.array_join("aliases", "|").alias("aliases"), "decisions")


def _history(s, d):
    rows = A.versions(s, d).select("raw_uid", "observed_epoch", "seq", "event_type")
    return SV.with_history(rows, ["raw_uid"], ["observed_epoch", "seq"], "event_type").select("raw_uid", "seq", F.array_join("history", ",").alias("history"))


def _summary(s, d):
    return SV.cluster_summary(A.postings(s, d), "industry", ["location", "role"], 3)


QUERIES = {
    "registry_skills": (
        _top_skills,
        "SELECT role, string_agg(skill_id, '|' ORDER BY k) AS skills FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY n DESC, skill_id) AS k FROM (SELECT role, skill_id, count(*) AS n FROM mentions JOIN (SELECT jd_id, role FROM postings) USING (jd_id) GROUP BY ALL)) WHERE k <= 20 GROUP BY role",
    ),
    "audited_roles": (
        _corrected,
        "SELECT jd_id, role AS role_before, level, industry, CASE WHEN level = 'P' AND role <> 'OPEN' THEN 'OPEN' WHEN starts_with(industry, 'B') AND role <> '5-LOW' THEN '5-LOW' ELSE role END AS role, CASE WHEN level = 'P' AND role <> 'OPEN' THEN 'level' WHEN starts_with(industry, 'B') AND role <> '5-LOW' THEN 'industry' END AS reason FROM postings",
    ),
    "approved_registry": (
        _registry,
        "SELECT role, string_agg(DISTINCT industry, '|' ORDER BY industry) AS aliases, count(*) AS decisions FROM postings WHERE level = 'F' GROUP BY role",
    ),
    "decision_history": (
        _history,
        "SELECT raw_uid, max(seq) FILTER (k = 1) AS seq, string_agg(event_type, ',' ORDER BY k) AS history FROM (SELECT *, row_number() OVER (PARTITION BY raw_uid ORDER BY observed_epoch DESC, seq DESC) AS k FROM versions) WHERE k <= 20 GROUP BY raw_uid",
    ),
    "cluster_summary": (
        _summary,
        """SELECT industry, size, top_location, top_role FROM (SELECT industry, count(*) AS size FROM postings GROUP BY industry) JOIN (SELECT industry, string_agg(location, '|' ORDER BY k) AS top_location FROM (SELECT *, row_number() OVER (PARTITION BY industry ORDER BY n DESC, location) AS k FROM (SELECT industry, location, count(*) AS n FROM postings GROUP BY ALL)) WHERE k <= 3 GROUP BY industry) USING (industry)
           JOIN (SELECT industry, string_agg(role, '|' ORDER BY k) AS top_role FROM (SELECT *, row_number() OVER (PARTITION BY industry ORDER BY n DESC, role) AS k FROM (SELECT industry, role, count(*) AS n FROM postings GROUP BY ALL)) WHERE k <= 3 GROUP BY industry) USING (industry)""",
    ),
    "role_titles": (lambda s, d: _made_titles(s, d).select("p_partkey", T.role_title(F.col("title"), F.lit("none")).alias("role")), _role_title_sql()),
    "display_titles": (
        lambda s, d: A.table(s, d, "part").select("p_partkey", T.display_title(F.concat(F.lit(" java "), "p_name", F.lit(" devops"))).alias("title")),
        "SELECT p_partkey, 'Java ' || p_name || ' DevOps' AS title FROM part",
    ),
    "ability_terms": (_terms, "SELECT doc_id, category, term FROM terms"),
    "supported_terms": (
        lambda s, d: EV.supported_terms(_terms(s, d), _abilities(s, d)),
        "SELECT doc_id, category, term FROM terms JOIN part ON doc_id = p_partkey WHERE contains(lower(p_name || ' ' || p_type), lower(term))",
    ),
    "responsibilities": (_duties, "SELECT p_partkey, '负责' || p_name || '的开发。|维护' || p_type || '的系统；' AS duties FROM part"),
    "name_precedence": (
        _precedence,
        "SELECT jd_id, CASE WHEN jd_id % 5 = 0 THEN 'R' WHEN jd_id % 3 = 0 THEN 'M' WHEN jd_id % 2 = 0 THEN role ELSE 'raw' END AS name, CASE WHEN jd_id % 5 = 0 THEN 'reviewer' WHEN jd_id % 3 = 0 THEN 'model' WHEN jd_id % 2 = 0 THEN 'rule' END AS name_source FROM postings",
    ),
    "mapping_check": (
        _mapping,
        "SELECT 'missing' AS problem, count(DISTINCT location) AS keys FROM postings WHERE location >= 'P' UNION ALL SELECT 'repeated', count(*) FROM (SELECT location FROM (SELECT DISTINCT location, level FROM postings WHERE location < 'P') GROUP BY location HAVING count(*) > 1)",
    ),
    "approved_matches": (
        _approved,
        "SELECT jd_id, seq, requirement AS match_type, status FROM mentions WHERE (requirement = 'required' AND status = 'VERIFIED') OR (requirement = 'preferred' AND status = 'LOW_CONFIDENCE')",
    ),
    "normalization_status": (
        lambda s, d: C.normalization_status(A.mentions(s, d), "skill_id", F.col("status") == "VERIFIED"),
        "SELECT skill_id, CASE WHEN bool_or(status = 'VERIFIED') AND bool_or(status <> 'VERIFIED') THEN 'MIXED_STANDARDIZED_AND_RAW' WHEN bool_or(status = 'VERIFIED') THEN 'STANDARDIZED_CONCEPT' ELSE 'RAW_SKILL_FALLBACK' END AS status FROM mentions GROUP BY skill_id",
    ),
    "role_resolution": (
        _resolution,
        "SELECT jd_id, CASE WHEN jd_id % 11 = 0 THEN 'EXACT' WHEN jd_id % 7 = 0 THEN 'ALIAS' WHEN salary / 500000 >= 0.5::DOUBLE AND level <> 'P' THEN 'VECTOR_MATCH' WHEN salary / 500000 >= 0.3::DOUBLE THEN 'REVIEW' ELSE 'UNMAPPED' END AS decision FROM postings",
    ),
    "extractor_fallback": (
        _fallback,
        "SELECT DISTINCT jd_id, skill_id, CASE WHEN jd_id % 3 = 0 THEN 'analysis' ELSE 'rules' END AS by FROM mentions WHERE jd_id % 3 = 0 OR jd_id % 2 = 0",
    ),
    "families_and_guards": (
        _families,
        "SELECT p_partkey, CASE WHEN contains(lower(p_type), 'steel') THEN 'METAL' WHEN regexp_matches(lower(p_type), 'brass|copper|tin|nickel') THEN 'ALLOY' WHEN contains(lower(p_type), 'promo') THEN 'OFFER' ELSE 'unknown' END AS family, regexp_matches(lower(p_type), 'steel|copper') AND NOT regexp_matches(lower(p_type), 'polished|plated') AS conflict, p_name AS surface, p_size > 25 AS no_ability FROM part",
    ),
    "registry_merges": (
        lambda s, d: N.registry_merges(_registry_pairs(s, d)).select(F.col("group").alias("grp"), "registry"),
        f"""SELECT grp, arg_min(registry, (rank, registry)) AS registry FROM registry_pairs WHERE group_category = registry_category AND 0.65::DOUBLE * phrase + 0.25::DOUBLE * context + 0.1::DOUBLE * lexical >= 0.94::DOUBLE AND phrase >= 0.88::DOUBLE
            AND (lexical >= 0.45::DOUBLE OR contains({_NORM.format("group_name")}, {_NORM.format("registry_name")}) OR contains({_NORM.format("registry_name")}, {_NORM.format("group_name")}) OR len(list_intersect({_WORDS.format("group_name")}, {_WORDS.format("registry_name")})) > 0) GROUP BY grp""",
    ),
    "cluster_edges": (_cluster_edges, _edges_sql()),
    "concept_rollup": (
        _rollup,
        """SELECT concept, members, companies, jds, round(v / greatest(1, jds), 6) AS verified_rate, CASE WHEN starts_with(concept, 'a') THEN 'STANDARD' WHEN companies >= 20 AND jds >= 30 AND v / greatest(1, jds) >= 0.6::DOUBLE THEN 'STANDARD_CANDIDATE' WHEN members > 1 THEN 'AUTO_CLUSTER' ELSE 'CANDIDATE' END AS status FROM (
           SELECT split_part(skill_id, ' ', 1) AS concept, count(DISTINCT skill_id) AS members, count(DISTINCT company_id) AS companies, count(DISTINCT jd_id) AS jds, count(DISTINCT jd_id) FILTER (status = 'VERIFIED') AS v FROM mentions JOIN (SELECT jd_id, company_id FROM postings) USING (jd_id) GROUP BY ALL)""",
    ),
    "title_discovery": (_discovery, "SELECT * FROM (" + _DISCOVERY + ")"),
    "reviewed_packets": (_reviewed, "SELECT * FROM (" + _REVIEWED + ")"),
    "patch_draft": (_drafts, _drafts_sql()),
    "evidence_ids": (
        _evidence_ids,
        "SELECT p_partkey, p_type || '|' || p_brand || '|' || p_name AS ids, CASE WHEN p_size * 10 * length(p_brand) <= 1500 THEN p_size ELSE least(12, p_size) END::INT AS kept, (CASE WHEN p_size * 10 * length(p_brand) <= 1500 THEN p_size ELSE least(12, p_size) END * 10 * length(p_brand))::INT AS characters FROM part",
    ),
    "cluster_cohesion": (
        _cohesion,
        "SELECT cluster, round(avg(score), 6) AS cohesion, count(*) AS pairs FROM (SELECT jd_id AS a, jd_id + 1 AS b, max(confidence) AS score FROM mentions GROUP BY jd_id) JOIN (SELECT jd_id AS a, jd_id // 8 AS cluster FROM postings) USING (a) JOIN (SELECT jd_id AS b, jd_id // 8 AS c2 FROM postings) USING (b) WHERE cluster = c2 GROUP BY cluster",
    ),
    "embedded_names": (_embedded, "SELECT p_partkey, 384 AS dims, 1.0::DOUBLE AS length FROM part"),
    "closed_months": (
        _closed,
        "SELECT DISTINCT month, strptime(month || '-01', '%Y-%m-%d') >= lo AND strptime(month || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH - INTERVAL 1 DAY <= hi AS closed FROM records, (SELECT min(posted_at) AS lo, max(posted_at) AS hi FROM postings)",
    ),
    "weight_shares": (
        lambda s, d: A.table(s, d, "nation").select("n_nationkey", *(F.round(F.lit(v), 6).alias(k) for k, v in stats.validated_weights({"a": 2.0, "b": 1.0, "c": 1.0}).items())),
        "SELECT n_nationkey, 0.5::DOUBLE AS a, 0.25::DOUBLE AS b, 0.25::DOUBLE AS c FROM nation",
    ),
}
