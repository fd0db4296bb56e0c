"""Registered queries: every operator run over the given tables, with the SQL
that must give the same rows where SQL can express it."""

from maskflow.catalog import (  # noqa: F401
    audits,
    cohorts,
    relations,
    stores,
    strategies,
    streams,
    tables,
)
from maskflow.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
