"""All core queries and their SQL."""

from __future__ import annotations

from rollbook.plans import general, reference, scans

_PARTS = (general, reference, scans)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
