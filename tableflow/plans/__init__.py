"""The queries this repository registers, each with the SQL it must agree with."""

from tableflow.plans import logs, merges, ndjson, reads, writes

_MODULES = (reads, writes, merges, ndjson, logs)

QUERIES = {key: query for module in _MODULES for key, query in module.QUERIES.items()}
ORACLES = {key: sql for module in _MODULES for key, sql in module.ORACLES.items()}
