"""All queries of the engine's own operators and their oracle."""

from __future__ import annotations

from larkspur.plans import discovery_queries, entity_queries, evolution_queries, matching_queries, profile_queries, serve_queries, source_queries, text_queries
from larkspur.plans.adapters import with_ctes

_ALL = {**profile_queries.QUERIES, **serve_queries.QUERIES, **evolution_queries.QUERIES, **entity_queries.QUERIES, **text_queries.QUERIES, **matching_queries.QUERIES, **source_queries.QUERIES, **discovery_queries.QUERIES}

QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLE_SQL = {name: with_ctes(sql) for name, (_, sql) in _ALL.items() if sql}
