"""Queries of text functions, domain admission, evidence, events and streams, with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import stats
from larkspur.functions import text as X
from larkspur.functions import titles as T
from larkspur.operators import domain as DM
from larkspur.operators import evidence as EV
from larkspur.plans import adapters as A
from larkspur.session import scratch
from larkspur.streaming import streams as ST

#: A policy in the vocabulary of the invented documents.
POLICY = DM.Policy(
    positive_groups={"a": ("thing", "tion"), "b": ("license", "copyright"), "c": ("http", "www")},
    negative_groups={"d": ("der ", "und "), "e": ("éau", "que")},
    technical_titles=("th", "er"), foreign_titles=("ñ", "ß"), positive_industries=("src1",), negative_industries=("src2",),
)

SKILLS = (
    EV.Skill("license", ("GNU General Public License", "Apache License", "MIT License", "license"), "legal"),
    EV.Skill("contact", ("email", "phone", "contact"), "contact"),
    EV.Skill("secret", ("password", "api_key", "token"), "security"),
)


def docs(s, d):
    return A.table(s, d, "documents")


def _functions(s, d):
    t = F.coalesce("text", F.lit(""))
    return docs(s, d).select(
        "doc_id", F.length(X.normalize_text(t)).alias("kept_chars"), F.size(X.shingles(t)).alias("grams"),
        F.size(F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0))).alias("numbers"), X.clean_value(F.lit(" N/A ")).alias("blank"),
    )


def _dates(s, d):
    """Order dates in four notations, parsed back."""
    o = A.table(s, d, "orders")
    forms = [F.date_format("o_orderdate", p) for p in ("yyyy-MM-dd HH:mm:ss", "yyyy/M/d", "yyyy年M月d日", "yyyy-MM")]
    text = F.element_at(F.array(*forms), (F.col("o_orderkey") % 4 + 1).cast("int"))
    at = X.parse_datetime(text)
    return o.select("o_orderkey", X.quarter_label(at).alias("quarter"), X.quarter_start(at).alias("quarter_start"), X.month_label(at).alias("month"), X.month_index(X.month_label(at)).alias("month_index"), X.parse_datetime(F.lit("soon")).isNull().alias("bad_is_null"))


def _json(s, d):
    e = A.table(s, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.page").alias("page"), F.size(F.json_object_keys("props")).cast("long").alias("keys"))


def _domain(s, d):
    rows = docs(s, d).select("doc_id", F.substring(F.coalesce("text", F.lit("")), 1, 20).alias("title"), F.coalesce("text", F.lit("")).alias("description"), F.col("source").alias("industry"))
    out = DM.admitted(DM.structured(rows, POLICY), POLICY)
    return out.select("doc_id", F.array_join("positive_groups", ",").alias("positive"), F.array_join("negative_groups", ",").alias("negative"), "structured_score", "label", "confidence")


def _contains(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, '{t}')" for t in terms) + ")" if terms else "false"


def _domain_sql() -> str:
    ev, p = "ev", POLICY
    groups = lambda g: "concat_ws(',', " + ", ".join(f"CASE WHEN {_contains(ev, t)} THEN '{n}' END" for n, t in g.items()) + ")"
    count = lambda g: " + ".join(f"({_contains(ev, t)})::INT" for t in g.values())
    return f"""SELECT doc_id, positive, negative, structured_score, label, round(greatest(0, least(1, CASE WHEN label <> 'UNCERTAIN' THEN abs(structured_score - 0.5::DOUBLE) * 2 ELSE 1 - abs(structured_score - 0.52::DOUBLE) * 2 END)), 6) AS confidence FROM (
        SELECT *, CASE WHEN foreign_t AND NOT technical AND pos <= 1 THEN 'NON_IT' WHEN bad AND NOT technical AND pos = 0 THEN 'NON_IT' WHEN technical AND (pos > 0 OR good) AND NOT foreign_t THEN 'IT' WHEN pos >= 2 AND good AND NOT foreign_t THEN 'IT' WHEN pos >= 2 AND structured_score >= 0.68 AND NOT foreign_t THEN 'IT'
            WHEN structured_score >= 0.62 AND pos >= 1 THEN 'IT' WHEN structured_score <= 0.42 THEN 'NON_IT' ELSE 'UNCERTAIN' END AS label FROM (
        SELECT *, round(greatest(0, least(1, 0.38::DOUBLE - 0.12::DOUBLE + CASE WHEN technical THEN 0.20::DOUBLE ELSE 0 END + least(pos, 3) * 0.105::DOUBLE + CASE WHEN good THEN 0.08::DOUBLE ELSE 0 END - least(neg, 2) * 0.13::DOUBLE - CASE WHEN bad THEN 0.16::DOUBLE ELSE 0 END - CASE WHEN foreign_t AND NOT technical THEN 0.32::DOUBLE ELSE 0 END)), 6) AS structured_score FROM (
        SELECT doc_id, {groups(p.positive_groups)} AS positive, {groups(p.negative_groups)} AS negative, {count(p.positive_groups)} AS pos, {count(p.negative_groups)} AS neg, {_contains("t", p.technical_titles)} AS technical, {_contains("t", p.foreign_titles)} AS foreign_t, {_contains("ind", p.positive_industries)} AS good, {_contains("ind", p.negative_industries)} AS bad FROM (
        SELECT doc_id, lower(substr(coalesce(text, ''), 1, 20)) AS t, lower(source) AS ind, lower(substr(coalesce(text, ''), 1, 20)) || ';' || substr(lower(coalesce(text, '')), 1, 3000) AS ev FROM documents))))"""


def _evidence(s, d):
    return EV.extract(docs(s, d), SKILLS)


def _verified(s, d):
    return EV.best(EV.verified(_evidence(s, d), docs(s, d).select("doc_id", "text")), ["doc_id", "skill_id"])


def _titles(s, d):
    names = ["高级Java开发工程师（北京）", "产品经理（AI方向，北京，15薪）", "急招 P6 资深 Java工程师", "数据分析师商业方向", "软件开发工程师-后端方向"]
    rows = A.table(s, d, "part").select("p_partkey", F.element_at(F.array(*(F.lit(n) for n in names)), (F.col("p_partkey") % 5 + 1).cast("int")).alias("title"))
    return rows.withColumn("n", T.title_udf()("title")).select("p_partkey", F.col("n.name").alias("name"), F.array_join("n.tags", ",").alias("tags"))


_TITLE_SQL = """SELECT p_partkey, ['Java开发工程师', '产品经理', 'Java开发工程师', '数据分析师', '软件工程师'][p_partkey % 5 + 1] AS name, ['', 'AI方向', '', '商业方向', '后端方向'][p_partkey % 5 + 1] AS tags FROM part"""


def _stream_counts(s, d):
    """Counts by day and kind of event from a stream, open windows included."""
    root = scratch(s, "counts")
    ST.write_complete(ST.month_counts(ST.file_stream(s, d, "events.parquet"), "event_type"), f"{root}/out", f"{root}/check").awaitTermination()
    return ST.latest(s, f"{root}/out", "day string, event_type string, n long")


def _events(s, d):
    return ST.file_stream(s, d, "events.parquet").where("ts is not null")


def _to_table(s, stream, name):
    root = scratch(s, name)
    return ST.run_to_table(stream, f"{root}/table", f"{root}/check")


ORDER = ("observed_epoch", "seq")


def _changes(s, d):
    """The log of what each batch of events changes."""
    rows = ST.file_stream(s, d, "events.parquet").select(F.col("user_id").alias("raw_uid"), F.unix_timestamp("ts").alias("observed_epoch"), F.col("event_id").alias("seq"), "event_type")
    return _to_table(s, ST.version_changes(rows, "raw_uid", ORDER), "changes")


def _stream_current(s, d):
    """The log, compacted."""
    return ST.current_rows(_changes(s, d), "raw_uid", ORDER).select("raw_uid", "observed_epoch", "seq", "event_type")


def _closed(start, end):
    """Windows whose end the watermark has passed, with their times as text."""
    return f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS \"start\", strftime({end}, '%Y-%m-%d %H:%M:%S') AS \"end\""


def _shown(df):
    return df.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss")).withColumn("end", F.date_format("end", "yyyy-MM-dd HH:mm:ss"))


QUERIES = {
    "text_functions": (
        _functions,
        "SELECT doc_id, length(regexp_replace(lower(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')), '[^0-9a-z一-鿿+#.]', '', 'g'))::INT AS kept_chars, CASE WHEN n = 0 THEN 0 WHEN n <= 3 THEN 1 ELSE n - 2 END::INT AS grams, len(regexp_extract_all(coalesce(text, ''), '[0-9]+'))::INT AS numbers, '' AS blank FROM (SELECT *, length(regexp_replace(lower(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')), '[^0-9a-z一-鿿+#.]', '', 'g')) AS n FROM documents)",
    ),
    "date_functions": (
        _dates,
        "SELECT o_orderkey, year(o_orderdate)::VARCHAR || 'Q' || quarter(o_orderdate)::VARCHAR AS quarter, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS quarter_start, strftime(o_orderdate, '%Y-%m') AS month, (year(o_orderdate) * 12 + month(o_orderdate))::BIGINT AS month_index, true AS bad_is_null FROM orders",
    ),
    "json_extract": (_json, "SELECT event_id, props::JSON ->> '$.page' AS page, len(json_keys(props))::BIGINT AS keys FROM events"),
    "domain_admission": (_domain, _domain_sql()),
    "rule_extraction": (_evidence, None),
    "verified_evidence": (_verified, None),
    "processing_status": (lambda s, d: EV.processing_status(docs(s, d).select("doc_id", "text"), _verified(s, d)).groupBy("status").agg(F.count("*").alias("n")), None),
    "title_normalize": (_titles, _TITLE_SQL),
    "level_inference": (
        lambda s, d: A.table(s, d, "part").select("p_partkey", X.infer_level(F.concat(F.lit("工程师"), F.when(F.col("p_partkey") % 3 == 0, "高级").otherwise("")), F.concat(F.col("p_size").cast("string"), F.lit("年")), F.lit("")).alias("level")),
        "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '高级' WHEN p_size >= 5 THEN '高级' WHEN p_size >= 3 THEN '中级' ELSE '初级' END AS level FROM part",
    ),
    "vector_cosine": (
        lambda s, d: A.table(s, d, "embeddings").alias("a").join(A.table(s, d, "embeddings").where("vec_id = 0").select(F.col("embedding").alias("e0")), how="cross").select("vec_id", F.round(stats.cosine(F.col("embedding"), F.col("e0")), 5).alias("similarity")),
        "SELECT a.vec_id, round(greatest(0, least(1, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))))), 5) AS similarity FROM embeddings a, (SELECT * FROM embeddings WHERE vec_id = 0) b",
    ),
    "score_fusion": (
        lambda s, d: A.table(s, d, "part").select("p_partkey", F.round(stats.fused([(F.col("p_size") / 50, 0.5), (F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice") / 10000), 0.3), (F.lit(0.25), 0.2)]), 6).alias("fused"), F.round(stats.geometric_score([F.col("p_size") / 50, F.lit(0.5)]), 4).alias("geometric")),
        "SELECT p_partkey, round((p_size / 50 * 0.5::DOUBLE + CASE WHEN p_partkey % 2 = 0 THEN p_retailprice / 10000 * 0.3::DOUBLE ELSE 0 END + 0.25::DOUBLE * 0.2::DOUBLE) / (0.5::DOUBLE + CASE WHEN p_partkey % 2 = 0 THEN 0.3::DOUBLE ELSE 0 END + 0.2::DOUBLE), 6) AS fused, round(100 * pow(greatest(0.01::DOUBLE, p_size / 50) * 0.5::DOUBLE, 0.5), 4) AS geometric FROM part",
    ),
    "conversation_order": (
        lambda s, d: A.table(s, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.max("turn").alias("last_turn"), F.count(F.when(F.col("role") == "user", 1)).alias("user_turns")),
        "SELECT conv_id, count(*) AS turns, max(turn) AS last_turn, count(*) FILTER (role = 'user') AS user_turns FROM conversations GROUP BY conv_id",
    ),
    "cube_totals": (
        lambda s, d: A.postings(s, d).cube("role", "industry").agg(F.count("*").alias("n"), F.countDistinct("company_id").alias("companies"), F.grouping_id().cast("long").alias("grain")),
        "SELECT role, industry, count(*) AS n, count(DISTINCT company_id) AS companies, grouping(role, industry)::BIGINT AS grain FROM postings GROUP BY CUBE (role, industry)",
    ),
    "stream_day_counts": (_stream_counts, "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL"),
    "stream_current_version": (_stream_current, "SELECT raw_uid, observed_epoch, seq, event_type FROM (SELECT *, row_number() OVER (PARTITION BY raw_uid ORDER BY observed_epoch DESC, seq DESC) AS n FROM versions) WHERE n = 1"),
    "stream_observations": (
        lambda s, d: _changes(s, d).groupBy("raw_uid").agg(F.max("observations").alias("observations")),
        "SELECT raw_uid, count(*) AS observations FROM versions WHERE raw_uid IS NOT NULL GROUP BY raw_uid",
    ),
    "stream_sliding": (
        lambda s, d: _shown(_to_table(s, ST.window_counts(_events(s, d), "event_type", "6 hours", "2 hours", grace="1 day"), "sliding")),
        f"""SELECT {_closed("b", "b + INTERVAL 6 HOUR")}, event_type, count(*) AS n, round(sum(round(value, 2)), 2) AS total
            FROM (SELECT *, time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 2 HOUR * k AS b FROM events, (VALUES (0), (1), (2)) AS o(k) WHERE ts IS NOT NULL)
            WHERE b + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY b, event_type""",
    ),
    "stream_sessions": (
        lambda s, d: _shown(_to_table(s, ST.sessions(_events(s, d), "user_id", "6 hours", grace="1 day"), "sessions")),
        f"""SELECT {_closed("a", "z")}, user_id, n FROM (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 6 HOUR AS z, count(*) AS n FROM (
            SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WHERE ts IS NOT NULL))
            GROUP BY user_id, session) WHERE z <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
    ),
    "stream_distinct": (
        lambda s, d: _to_table(s, ST.deduplicated(_events(s, d), ["user_id", "event_type"]).select("user_id", "event_type"), "distinct"),
        "SELECT DISTINCT user_id, event_type FROM events WHERE ts IS NOT NULL",
    ),
}
