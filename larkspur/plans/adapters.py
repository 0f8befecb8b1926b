"""Logical tables of the engine over the driver's tables, in Spark and, for the oracle, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job postings: an order is a posting, its customer the company, its priority the role."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 and 5 rows, whatever the scale
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("jd_id"),
            F.col("o_custkey").alias("company_id"),
            F.col("c_name").alias("company_name"),
            F.col("o_orderpriority").alias("role"),
            F.col("c_mktsegment").alias("industry"),
            F.col("o_orderstatus").alias("level"),
            F.col("o_orderdate").alias("posted_at"),
            F.col("r_name").alias("source_family"),
            F.col("n_name").alias("location"),
            F.round("o_totalprice", 2).alias("salary"),
        )
    )


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skill mentions with evidence: a line of an order mentions a part."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    status = F.when(F.col("l_linestatus") == "F", "VERIFIED").when(F.col("l_returnflag") == "N", "LOW_CONFIDENCE").when(F.col("l_returnflag") == "A", "ANALYSIS_ONLY").otherwise("REJECTED_HALLUCINATION")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("jd_id"),
        F.col("l_linenumber").alias("seq"),
        F.col("p_name").alias("skill_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("stack"),
        F.when(F.col("l_returnflag") == "R", "preferred").otherwise("required").alias("requirement"),
        status.alias("status"),
        F.round(1 - F.col("l_discount"), 2).alias("confidence"),
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed versions of raw records: an event is an observation of its user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("raw_uid"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("observed_epoch"),
        F.col("event_id").alias("seq"),
        "event_type",
        F.round("value", 2).alias("value"),
        "props",
        "ts",
    )


#: CTEs of the oracle by name; each may use those above it.
CTES: dict[str, str] = {
    "postings": """SELECT o_orderkey AS jd_id, o_custkey AS company_id, c_name AS company_name, o_orderpriority AS role, c_mktsegment AS industry,
        o_orderstatus AS level, o_orderdate AS posted_at, r_name AS source_family, n_name AS location, round(o_totalprice, 2) AS salary
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "mentions": """SELECT l_orderkey AS jd_id, l_linenumber AS seq, p_name AS skill_id, p_type AS category, p_brand AS stack,
        CASE WHEN l_returnflag = 'R' THEN 'preferred' ELSE 'required' END AS requirement,
        CASE WHEN l_linestatus = 'F' THEN 'VERIFIED' WHEN l_returnflag = 'N' THEN 'LOW_CONFIDENCE' WHEN l_returnflag = 'A' THEN 'ANALYSIS_ONLY' ELSE 'REJECTED_HALLUCINATION' END AS status,
        round(1 - l_discount, 2) AS confidence FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "versions": "SELECT user_id AS raw_uid, floor(epoch(ts))::BIGINT AS observed_epoch, event_id AS seq, event_type, round(value, 2) AS value, props, ts FROM events",
}


def with_ctes(sql: str) -> str:
    """``sql`` behind those CTEs that it needs, directly or through others."""
    import re

    need: list[str] = []

    def add(text: str) -> None:
        for name in CTES:
            if name not in need and re.search(rf"\b{name}\b", text):
                add(re.sub(rf"\b{name}\b", "", CTES[name]))  # a recursive one uses itself
                if name not in need:
                    need.append(name)

    add(sql)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in need) + "\n" + sql if need else sql
