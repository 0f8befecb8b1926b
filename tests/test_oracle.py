"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from larkspur.plans import catalog


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    mine = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    other = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(other.columns) == columns
    at = [other.columns.index(c) for c in columns]
    assert mine == sorted(repr([plain(r[i]) for i in at]) for r in other.fetchall())


#: Tested by brute force in test_brute_force.py or on small tables in test_operators.py.
OTHERWISE_TESTED = {
    "skill_changes", "review_budget", "simhash_dups", "near_duplicates", "near_dup_clusters", "greedy_templates", "title_clusters", "similar_titles", "capped_clusters", "centroid_clusters", "ann_topk", "mmr_select", "redundancy_filter",
    "rule_extraction", "verified_evidence", "processing_status", "nearest_skills", "nearest_roles", "title_relevance",
}


def test_every_query_is_tested():
    assert set(catalog.QUERIES) - set(catalog.ORACLE_SQL) <= OTHERWISE_TESTED
