"""All registered queries and the SQL that states what each must return."""

from __future__ import annotations

from . import chunk_queries, file_queries, score_queries, seed_queries, sql_queries, stream_queries

QUERIES = chunk_queries.QUERIES | seed_queries.QUERIES | score_queries.QUERIES | file_queries.QUERIES | stream_queries.QUERIES | sql_queries.QUERIES
ORACLES = chunk_queries.ORACLES | seed_queries.ORACLES | score_queries.ORACLES | file_queries.ORACLES | stream_queries.ORACLES | sql_queries.ORACLES
