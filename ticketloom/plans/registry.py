"""All registered queries of the library itself, by name, and their SQL."""

from __future__ import annotations

from ticketloom.plans import queries_flow, queries_join, queries_table, queries_text

FLAGSHIP = "clusters"
QUERIES: dict = queries_table.QUERIES | queries_text.QUERIES | queries_join.QUERIES | queries_flow.QUERIES
ORACLE_SQL: dict = queries_table.ORACLE_SQL | queries_text.ORACLE_SQL | queries_join.ORACLE_SQL | queries_flow.ORACLE_SQL
