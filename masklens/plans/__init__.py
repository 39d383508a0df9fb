"""Registered queries (catalog), their DuckDB oracles and the stand-in inputs."""
