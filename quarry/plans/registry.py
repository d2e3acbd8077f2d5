"""Names of all queries of the corpus engine and their SQL twins."""

from __future__ import annotations

from quarry.plans import language_queries, markup_queries, more_queries, relational_queries

MODULES = (relational_queries, language_queries, markup_queries, more_queries)


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
