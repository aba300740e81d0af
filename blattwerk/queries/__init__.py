"""Registered queries of the core."""

from blattwerk.queries import documents, history, joins, layout, lines, parsing, quality, review, tables, text  # noqa: F401
from blattwerk.queries.registry import ORACLE, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["oracle_sql", "queries"]
