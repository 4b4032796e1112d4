"""All queries over the annotation tables, and their SQL."""

from __future__ import annotations

from strandwise.plans import gene_queries, map_queries, read_queries, report_queries


def queries() -> dict:
    return read_queries.QUERIES | gene_queries.QUERIES | map_queries.QUERIES | report_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return read_queries.SQL | gene_queries.SQL | map_queries.SQL | report_queries.SQL
