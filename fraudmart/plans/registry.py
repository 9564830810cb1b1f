"""All registered queries of the library and their DuckDB twins."""

from __future__ import annotations

from fraudmart.plans import catalog, oracle, streams, tables

QUERIES = catalog.QUERIES | streams.QUERIES | tables.QUERIES
SQL = {k: v for k, v in (oracle.SQL | streams.SQL | tables.SQL).items() if k in QUERIES}
