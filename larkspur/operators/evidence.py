"""Skill extraction with evidence from the text, and its verification."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.text import normalize_text
from larkspur.operators.dictionary import matcher, simple_lower

#: Words of a preferred rather than required skill.
PREFERRED = re.compile("优先|加分|最好|更佳|preferred|nice to have|a plus", re.I)
_ENDS = re.compile(r"[。；;！!？?\n\r]|\.(?:\s|$)")


@dataclass(frozen=True)
class Skill:
    skill_id: str
    aliases: tuple[str, ...]
    category: str = ""


def find_alias(text: str, aliases: tuple[str, ...]) -> tuple[str, int] | None:
    """The longest alias that occurs, as written in the text, and where; ASCII aliases are whole words."""
    for alias in sorted(aliases, key=lambda a: (-len(a), a)):
        pattern = re.escape(alias)
        if alias.isascii():
            pattern = rf"(?<![A-Za-z0-9+#]){pattern}(?![A-Za-z0-9+#])"
        if m := re.search(pattern, text, re.I):
            return m[0], m.start()
    return None


def quote(text: str, at: int, length: int, most: int = 240) -> str:
    """The sentence around a hit, cut to ``most`` characters."""
    start = max((m.end() for m in _ENDS.finditer(text, 0, at)), default=0)
    end = m.start() if (m := _ENDS.search(text, at + length)) else len(text)
    if end - start > most:
        start = max(start, at - (most - length) // 2)
        end = min(end, start + most)
    return text[start:end].strip()


def requirement(text: str, at: int) -> str:
    return "preferred" if PREFERRED.search(text[max(0, at - 45) : at + 80]) else "required"


def extract(docs: DataFrame, skills: tuple[Skill, ...], *, key: str = "doc_id", text_column: str = "text", confidence: float = 0.96) -> DataFrame:
    """One row for each document and skill whose alias occurs in the text: quote, requirement and confidence.

    As ``find_alias`` has it, of a skill's aliases in a text the longest counts, where it
    first occurs.  All aliases of all skills are found in one pass over a text.
    """
    kind = dict(docs.dtypes)[key]
    of: dict[str, list[int]] = {}
    for i, s in enumerate(skills):
        for alias in {simple_lower(a) for a in s.aliases}:
            of.setdefault(alias, []).append(i)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aliases = matcher(tuple(of))
        for pdf in batches:
            rows = []
            for k, text in zip(pdf["key"], pdf["text"], strict=True):
                hits: dict[int, tuple[str, int]] = {}
                for alias, at in sorted((aliases.first(text) if text else {}).items(), key=lambda h: (-len(h[0]), h[0])):
                    for i in of[alias]:
                        hits.setdefault(i, (text[at : at + len(alias)], at))
                for i, (raw, at) in sorted(hits.items()):
                    rows.append((k, skills[i].skill_id, raw, skills[i].category, requirement(text, at), quote(text, at, len(raw)), confidence))
            yield pd.DataFrame(rows, columns=["key", "skill_id", "raw_term", "category", "requirement", "evidence_quote", "confidence"])

    schema = f"key {kind}, skill_id string, raw_term string, category string, requirement string, evidence_quote string, confidence double"
    return docs.select(F.col(key).alias("key"), F.col(text_column).alias("text")).mapInPandas(run, schema).withColumnRenamed("key", key)


def verified(candidates: DataFrame, docs: DataFrame, *, key: str = "doc_id", text_column: str = "text", analysis_column: str | None = None) -> DataFrame:
    """``candidates`` with ``status``: the quote stands in the text, or does when both are normalized, or only in the analysis, or nowhere.

    Candidates without a known skill are rejected as such.
    """
    columns = [F.col(key), F.coalesce(text_column, F.lit("")).alias("_text"), (F.coalesce(analysis_column, F.lit("")) if analysis_column else F.lit("")).alias("_analysis")]
    rows = candidates.join(docs.select(*columns), key)
    q = F.col("evidence_quote")
    loose = lambda c: (F.length(normalize_text(q)) > 0) & normalize_text(F.col(c)).contains(normalize_text(q))
    status = (
        F.when(F.coalesce(F.col("skill_id"), F.lit("")) == "", "REJECTED_UNKNOWN_SKILL")
        .when((F.length(q) > 0) & F.col("_text").contains(q), "VERIFIED")
        .when(loose("_text"), "LOW_CONFIDENCE")
        .when(loose("_analysis"), "ANALYSIS_ONLY")
        .otherwise("REJECTED_HALLUCINATION")
    )
    return rows.withColumn("status", status).drop("_text", "_analysis")


def best(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """The best evidence of each of ``keys``: by status, confidence, required first, then the quote."""
    rank = F.when(F.col("status") == "VERIFIED", 1).when(F.col("status") == "LOW_CONFIDENCE", 2).when(F.col("status") == "ANALYSIS_ONLY", 3).otherwise(4)
    order = F.struct(rank, -F.coalesce("confidence", F.lit(float("-inf"))), F.when(F.col("requirement") == "required", 0).otherwise(1), "evidence_quote", "raw_term")
    row = F.min_by(F.struct(*(F.col(c) for c in evidence.columns)), order).alias("_row")
    return evidence.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(row).select("_row.*")


def fallback(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of the second extractor for documents in which the first found nothing."""
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti"))


def processing_status(docs: DataFrame, evidence: DataFrame, *, key: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``key, status``: completed, or in need of a model, or without anything to extract from."""
    counts = evidence.groupBy(key).agg(F.count(F.when(F.col("status").isin("VERIFIED", "LOW_CONFIDENCE", "ANALYSIS_ONLY"), 1)).alias("good"), F.count("*").alias("all_found"))
    rows = docs.select(key, F.length(F.trim(F.coalesce(text_column, F.lit("")))).alias("_n")).join(counts, key, "left").fillna(0, ["good", "all_found"])
    status = F.when(F.col("_n") == 0, "FAILED").when(F.col("good") > 0, "COMPLETED").when(F.col("all_found") > 0, "NO_VALID_ABILITIES").otherwise("NEEDS_LLM")
    return rows.select(key, status.alias("status"))


def ability_terms(df: DataFrame, key: str, column: str) -> DataFrame:
    """``key, category, term`` of ability JSON: an object of sections, each a list or a separated string.

    Text that is no JSON object gives no rows; terms are trimmed, empty ones go, repeats
    within a section once.
    """
    sections = F.from_json(F.col(column), "map<string,string>")  # an array is its JSON text here
    rows = df.select(key, F.explode(sections).alias("category", "value"))
    listed = F.when(F.col("value").startswith("["), F.from_json("value", "array<string>"))
    rows = rows.withColumn("terms", F.coalesce(listed, F.split("value", "[,，、;；|/]")))
    clean = F.array_distinct(F.filter(F.transform("terms", lambda t: F.trim(t)), lambda t: t != ""))
    return rows.select(key, F.trim("category").alias("category"), F.explode(clean).alias("term"))


def salvaged_json(answer: Column) -> Column:
    """The JSON object in a model's answer, from the first brace to the last, as a variant; null if there is none."""
    return F.try_parse_json(F.regexp_extract(F.coalesce(answer, F.lit("")), r"(?s)\{.*\}", 0))


def supported_terms(terms: DataFrame, docs: DataFrame, *, key: str = "doc_id", text_column: str = "text", most: int = 12) -> DataFrame:
    """Of ``key, category, term``, those that stand in the document's text, the first ``most`` of each category by name."""
    rows = terms.join(docs.select(key, F.lower(F.coalesce(text_column, F.lit(""))).alias("_t")), key).where(F.col("_t").contains(F.lower("term"))).drop("_t")
    w = Window.partitionBy(key, "category").orderBy("term")
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")
