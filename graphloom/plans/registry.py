"""All queries of the reference's operators, by name."""

from __future__ import annotations

from . import kg_queries, retrieval_queries, structure_queries, text_queries  # noqa: F401 - each registers its queries
from .base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
