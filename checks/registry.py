"""All registered queries by family."""

from __future__ import annotations

from checks import jobs, links, logs, monitoring, pages, streams

_FAMILIES = [monitoring, jobs, links, logs, pages, streams]

QUERIES = {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}
ORACLES = {name: sql for family in _FAMILIES for name, sql in family.ORACLES.items()}
