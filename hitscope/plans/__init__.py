"""Composite jobs, the registered queries, their DuckDB oracles and the SQL surface."""
