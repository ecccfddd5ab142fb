"""Queries over the given tables, each with the SQL that must give the same rows."""

from . import classify, graph, index, reports, storage, text

_MODULES = (text, reports, index, graph, classify, storage)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}

__all__ = ["ORACLES", "QUERIES"]
